"""Queries of the text problems: name -> (spark, sf_dir) -> DataFrame, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolweave.llm import languages, leaks, lookalike, mixing, pairs, pieces, repetition, sentences, turns
from spoolweave.session import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def tune(spark: SparkSession) -> None:
    """Arrow batches small enough for long texts (only where the session has the default)."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    found = turns.speaker_turns(table(spark, d, "sentence_unit"), table(spark, d, "speaker_roster"))
    return found.select("episode_id", "speaker_id", "first_sentence_id", "last_sentence_id")


def p1_turns(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return turns.speaker_turns(table(spark, d, "sentence_unit"), table(spark, d, "speaker_roster"), text_too=True)


CANDIDATE = ["episode_id", "block_id", "source"]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return repetition.repetitive(table(spark, d, "block_candidate"), "text", CANDIDATE)


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return repetition.repetition_shares(table(spark, d, "block_candidate"), "text", CANDIDATE)


def p2_cascade(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return repetition.cascade(table(spark, d, "block_candidate"), "text", CANDIDATE)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    units, texts = table(spark, d, "sentence_unit"), table(spark, d, "text_artifact")
    prints = None
    for df, column, key in ((units, "text", "sentence_id"), (texts, "raw_text", "source"), (texts, "match_norm_text", "source")):
        part = lookalike.look_prints(df, column, ["episode_id", key]).select(F.lit(column).alias("field"), "episode_id", F.col(key).alias("id"), "form_id", "code_id")
        prints = part if prints is None else prints.unionByName(part)
    return lookalike.look_pairs(prints, ["field", "episode_id"], "id")


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    units, texts = table(spark, d, "sentence_unit"), table(spark, d, "text_artifact")
    out = None
    for df, column, key in ((units, "text", "sentence_id"), (texts, "raw_text", "source"), (texts, "match_norm_text", "source")):
        part = lookalike.consistent_text(df, column, ["episode_id", key]).select(F.lit(column).alias("field"), "episode_id", F.col(key).alias("id"), "form", "change")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    found = sentences.split_sentences(table(spark, d, "sentence_unit"), "boundary_text", ["episode_id", "sentence_id"])
    return found.where("sentence_no > 0").select("episode_id", "sentence_id", "char_pos")


def p4_sentences(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    units = table(spark, d, "sentence_unit")
    out = None
    for column in ("text", "boundary_text", "display_text"):
        part = sentences.split_sentences(units, column, ["episode_id", "sentence_id"]).select(F.lit(column).alias("field"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def p4_documents(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return sentences.split_sentences(table(spark, d, "documents"), "text", ["doc_id"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    found = pieces.block_pieces(table(spark, d, "alignment_block"), table(spark, d, "sentence_unit"))
    return found.select("episode_id", "block_id", "piece_no", "first_sentence_id", "last_sentence_id")


def p5_parts(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return pieces.long_sentence_parts(table(spark, d, "alignment_block"), table(spark, d, "sentence_unit"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return pairs.broken_pairs(table(spark, d, "llm_decision"), table(spark, d, "documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_item")).select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return mixing.mix_sources(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return mixing.mix_shares(table(spark, d, "documents"), table(spark, d, "mix_target"))


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What a mix must hold, by source: caps kept, no text twice, the share within a hundredth of its target."""
    tune(spark)
    documents, targets = table(spark, d, "documents"), table(spark, d, "mix_target")
    mix = cut(mixing.mix_sources(documents, targets))
    caps = targets.select(mixing.source_key(F.col("source")).alias("source"), "target_weight", "max_repeats")
    texts = mix.join(documents.select("doc_id", F.xxhash64("text").alias("t")).distinct(), "doc_id")
    total = mix.agg(F.sum(F.col("tokens") * F.col("repeats")).alias("total"))
    by = texts.groupBy("source").agg(F.max("repeats").alias("most"), F.count("*").alias("n"), F.count_distinct("t").alias("distinct"), F.sum(F.col("tokens") * F.col("repeats")).alias("got"))
    rows = caps.join(by, "source").join(total)  # one row
    return rows.select("source", (F.col("most") <= F.col("max_repeats")).alias("cap_kept"), (F.col("n") == F.col("distinct")).alias("texts_once"), (F.abs(F.col("got") / F.col("total") - F.col("target_weight")) <= 0.01).alias("share_reached"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return languages.mislabelled(table(spark, d, "documents"))


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return languages.language_segments(table(spark, d, "documents")).distinct()


def p9_documents(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return languages.document_languages(languages.language_segments(table(spark, d, "documents")).distinct())


def queries() -> dict[str, Query]:
    every = (p1_found, p1_turns, p2_found, p2_shares, p2_cascade, p3_found, p3_forms, p4_found, p4_sentences, p4_documents, p5_found, p5_parts, p6_found, p7_found, p7_leaks, p8_mix, p8_shares, p8_checks, p9_found, p9_segments, p9_documents)
    return {f.__name__: f for f in every}


P5_SQL = """WITH RECURSIVE u AS (SELECT DISTINCT ON (episode_id, sentence_id) episode_id, sentence_id, start_sec, coalesce(length(text), 0) AS len FROM sentence_unit),
    b AS (SELECT DISTINCT ON (episode_id, block_id) episode_id, block_id, sentence_ids FROM alignment_block WHERE length(text) > 400),
    m AS (SELECT DISTINCT episode_id, block_id, unnest(sentence_ids) AS sentence_id FROM b),
    o AS (SELECT m.*, u.len, row_number() OVER w AS i, count(*) OVER (PARTITION BY m.episode_id, m.block_id) AS n FROM m JOIN u USING (episode_id, sentence_id)
        WINDOW w AS (PARTITION BY m.episode_id, m.block_id ORDER BY u.start_sec, m.sentence_id)),
    p AS (SELECT *, sum(len) OVER (PARTITION BY episode_id, block_id ORDER BY i) AS s FROM o),
    e AS (SELECT a.episode_id, a.block_id, a.i, a.n, coalesce(max(c.i), a.i) AS j FROM p a LEFT JOIN p c ON c.episode_id = a.episode_id AND c.block_id = a.block_id AND c.i >= a.i AND c.s - a.s + a.len <= 400
        GROUP BY a.episode_id, a.block_id, a.i, a.n),
    x AS (SELECT e.*, CASE WHEN e.j = e.n THEN NULL WHEN e.j = e.i OR y.len + z.len > 400 THEN e.j + 1 ELSE e.j END AS nxt FROM e
        JOIN p y ON y.episode_id = e.episode_id AND y.block_id = e.block_id AND y.i = e.j LEFT JOIN p z ON z.episode_id = e.episode_id AND z.block_id = e.block_id AND z.i = e.j + 1),
    r AS (SELECT episode_id, block_id, 1 AS piece_no, i, j, nxt FROM x WHERE i = 1
        UNION ALL SELECT x.episode_id, x.block_id, r.piece_no + 1, x.i, x.j, x.nxt FROM r JOIN x ON x.episode_id = r.episode_id AND x.block_id = r.block_id AND x.i = r.nxt)
    SELECT r.episode_id, r.block_id, CAST(r.piece_no AS INT) AS piece_no, f.sentence_id AS first_sentence_id, l.sentence_id AS last_sentence_id FROM r
    JOIN p f ON f.episode_id = r.episode_id AND f.block_id = r.block_id AND f.i = r.i JOIN p l ON l.episode_id = r.episode_id AND l.block_id = r.block_id AND l.i = r.j"""


P8_SQL = "SELECT DISTINCT replace(replace(lower(trim(source)), ' ', '_'), '-', '_') AS source, true AS cap_kept, true AS texts_once, true AS share_reached FROM mix_target"


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_SQL, "p8_checks": P8_SQL}
