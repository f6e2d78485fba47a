"""Queries of the core operators over the test tables, and their SQL.

Names begin with the group of the operator: t text, g segmentation, m similarity, a
alignment, r risk, f fusion, h counts, k top rows, j joins, w order-dependent, v checks.
Rows that were delivered again count once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spoolweave.functions import numeric as nm
from spoolweave.functions import similarity as sm
from spoolweave.functions import tables as tb
from spoolweave.functions import text as tx
from spoolweave.operators import alignment, arbitration, fusion, joins, reports, risk, segmentation, spans, validation
from spoolweave.operators import ordered as od
from spoolweave.session import scratch_folder, table
from spoolweave.sources import episodes, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
FLAGSHIP = "f_final_blocks"

UNIT, BLOCK, CAND = ["episode_id", "sentence_id"], ["episode_id", "block_id"], ["episode_id", "block_id", "source"]
TERMS = {"map": ("map", "地図", "mapa", "carte", "Karte"), "budget": ("budget", "予算", "presupuesto", "예산", "预算"), "water": ("water level", "水位", "relevé des eaux", "Wasserprotokoll")}
RULES = (*tb.CORRECTIONS, ("harbour", "harbor"), ("harbor keeper", "harbourmaster"), ("だそうです", "という"), ("という。", "とのこと。"), ("nobody had read", "unread"))
HARD, SOFT = (*tb.HARD_PATTERNS, "2.5.1", "Ver."), (*tb.SOFT_PATTERNS, "によると", "と比べると", "the night editor", "の記録")
RESPONSES = (*tb.SHORT_RESPONSES, "Yeah", "I see", "Sure", "Genau", "Oui", "Sí", "たしかに")
WS = "[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def units(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sentence_unit").dropDuplicates(UNIT)


def blocks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alignment_block").dropDuplicates(BLOCK)


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "block_candidate").dropDuplicates(CAND)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


U = "(SELECT DISTINCT ON (episode_id, sentence_id) * FROM sentence_unit)"
B = "(SELECT DISTINCT ON (episode_id, block_id) * FROM alignment_block)"
C = "(SELECT DISTINCT ON (episode_id, block_id, source) * FROM block_candidate)"


U2 = "(SELECT episode_id, sentence_id, min(start_sec) AS start_sec, max(confidence) AS confidence FROM sentence_unit GROUP BY episode_id, sentence_id)"


def confidences(spark: SparkSession, d: str) -> DataFrame:
    """Time and best confidence of each unit (deliveries differ in it)."""
    return table(spark, d, "sentence_unit").groupBy(*UNIT).agg(F.min("start_sec").alias("start_sec"), F.max("confidence").alias("confidence"))


# --- text


@query(
    f"""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^。！？!?.]*[。！？!?.]|[^。！？!?.]+')) AS text,
        generate_subscripts(regexp_extract_all(text, '[^。！？!?.]*[。！？!?.]|[^。！？!?.]+'), 1) AS chunk_no FROM documents),
    o AS (SELECT *, sum(length(text)) OVER (PARTITION BY doc_id ORDER BY chunk_no) AS char_end FROM c)
    SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, text, CAST(char_end - length(text) AS INT) AS char_start, CAST(char_end AS INT) AS char_end
    FROM o WHERE NOT regexp_full_match(text, '{WS}*')"""
)
def g_sentence_chunks(spark, d):
    """G1 over all documents, with the full stop as a further terminator."""
    return segmentation.sentence_chunks(table(spark, d, "documents"), "text", ["doc_id"], tb.TERMINATORS + ".")


def _hint_sql() -> str:
    by_length = sorted(RESPONSES, key=len, reverse=True)
    prefix = "CASE " + " ".join(f"WHEN starts_with(t, {lit(p)}) AND length(t) > {len(p)} THEN {lit(p)}" for p in by_length) + " END"
    return f"""WITH a AS (SELECT episode_id, sentence_id, coalesce(text, '') AS t FROM {U}), p AS (SELECT *, {prefix} AS p FROM a),
    r AS (SELECT *, substr(t, length(p) + 1) AS r0 FROM p), s AS (SELECT *, CASE WHEN substr(r0, 1, 1) IN ('、', '，', ' ', '　') THEN substr(r0, 2) ELSE r0 END AS r FROM r),
    z AS (SELECT *, p IS NOT NULL AND length(r) > 0 AND substr(r, 1, 1) NOT IN ('。', '、', '!', '?', '！', '？') AS put FROM s)
    SELECT episode_id, sentence_id, CASE WHEN put THEN p || '。' || regexp_replace(r, '^{WS}+', '') ELSE t END AS display_text,
    CASE WHEN put THEN p END AS token, CASE WHEN put THEN CAST(length(p) AS INT) END AS char_pos FROM z"""


@query(_hint_sql())
def t_boundary_hints(spark, d):
    """T15 over all units."""
    df = units(spark, d).withColumn("h", tx.boundary_hint(F.col("text"), RESPONSES))
    first = F.get("h.boundary_hints", F.lit(0))
    return df.select(*UNIT, "h.display_text", first["token"].alias("token"), first["char_pos_in_raw"].alias("char_pos"))


@query(
    f"""SELECT episode_id, block_id, source, array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '\\p{{Nd}}+(?:[.,]\\p{{Nd}}+)?'))), '|') AS numbers,
    array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '[0-9０-９]+'))), '|') AS digit_runs,
    array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '[\\x{{30A0}}-\\x{{30FF}}]{{2,}}'))), '|') AS katakana,
    array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{{2,}}'))), '|') AS latin,
    array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '[\\x{{4E00}}-\\x{{9FFF}}]{{2,4}}'))), '|') AS kanji FROM {C}"""
)
def t_tokens(spark, d):
    """T9 and T10 over all candidates."""
    text = F.col("text")
    sets = tx.tokens(text)
    return candidates(spark, d).select(
        *CAND, F.array_join(tx.numbers(text), "|").alias("numbers"), F.array_join(tx.digit_runs(text), "|").alias("digit_runs"), *[F.array_join(sets[n], "|").alias(n) for n in ("katakana", "latin", "kanji")]
    )


def _corrections_sql() -> str:
    steps = ["coalesce(text, '') AS t0"]
    for i, (a, b) in enumerate(RULES):
        steps.append(f"replace(t{i}, {lit(a)}, {lit(b)}) AS t{i + 1}")
    n = "+".join(f"CAST(contains(t{i}, {lit(a)}) AS INT)" for i, (a, _) in enumerate(RULES))
    return f"SELECT episode_id, block_id, t{len(RULES)} AS text, {n} AS rules_applied FROM (SELECT episode_id, block_id, {', '.join(steps)} FROM {B})"


@query(_corrections_sql())
def t_corrections(spark, d):
    """T14 with rules of which later ones meet what earlier ones wrote."""
    df = blocks(spark, d).withColumn("c", tx.corrected(F.col("text"), RULES))
    return df.select(*BLOCK, "c.text", F.size("c.applied").alias("rules_applied"))


def _patterns_sql() -> str:
    one = " UNION ALL ".join(
        f"SELECT episode_id, block_id, {lit(p)} AS pattern_id, {lit(s)} AS severity, substr(text, greatest(instr(text, {lit(p)}) - 28, 1), "
        f"instr(text, {lit(p)}) - 1 + {len(p)} + 28 - greatest(instr(text, {lit(p)}) - 29, 0)) AS context FROM {B} WHERE contains(text, {lit(p)})"
        for s, ps in (("human_required", HARD), ("machine_note", SOFT))
        for p in ps
    )
    return one


@query(_patterns_sql())
def t_pattern_context(spark, d):
    """T19 over all blocks."""
    df = blocks(spark, d).select(*BLOCK, F.explode(tx.pattern_hits(F.col("text"), HARD, SOFT)).alias("h"))
    return df.select(*BLOCK, "h.pattern_id", "h.severity", "h.context")


@query(
    " UNION ALL ".join(
        f"SELECT {lit(t)} AS term, count(*) AS documents FROM documents WHERE {' OR '.join(f'contains(text, {lit(w)})' for w in ws)} HAVING count(*) > 0" for t, ws in TERMS.items()
    )
)
def j_term_hits(spark, d):
    """Documents that hold a term in any spelling."""
    return joins.dictionary_hits(table(spark, d, "documents"), "text", ["doc_id"], TERMS).groupBy("term").agg(F.count("*").alias("documents"))


@query(
    " UNION ALL ".join(
        f"SELECT {lit(w)} AS name, CAST(sum((length(text) - length(replace(text, {lit(w)}, ''))) // {len(w)}) AS BIGINT) AS count FROM documents WHERE contains(text, {lit(w)}) HAVING count(*) > 0"
        for ws in TERMS.values()
        for w in ws
    )
)
def h_phrase_totals(spark, d):
    """Occurrences of each phrase."""
    return reports.phrase_totals(table(spark, d, "documents"), "text", tuple(w for ws in TERMS.values() for w in ws))


_T22 = "CAST(floor(start_sec) AS BIGINT) * 1000 + CAST(round_even((start_sec - floor(start_sec)) * 1000, 0) AS BIGINT)"


@query(
    f"""SELECT episode_id, sentence_id, printf('%02d:%02d:%02d,%03d', ms // 3600000, (ms // 60000) % 60, (ms // 1000) % 60, ms % 1000) AS stamp, round(ms / 1000.0, 3) AS seconds
    FROM (SELECT episode_id, sentence_id, {_T22} AS ms FROM {U})"""
)
def t_time_text(spark, d):
    """T22 there and back."""
    df = units(spark, d).select(*UNIT, nm.format_time(F.col("start_sec")).alias("stamp"))
    return df.withColumn("seconds", F.round(nm.parse_time(F.col("stamp")), 3))


@query(
    f"""SELECT episode_id, block_id, source, CAST(length(regexp_replace(coalesce(text, ''), '({WS}|[、。，．,.!?！？])+', '', 'g')) AS INT) AS anchor_length,
    CAST(length(regexp_replace(coalesce(text, ''), '({WS}|[、。，．,.!?！？「」『』（）()‐‑‒–—…-])+', '', 'g')) AS INT) AS plain_length FROM {C}"""
)
def t_plain_lengths(spark, d):
    """T7 and T8 over all candidates."""
    return candidates(spark, d).select(*CAND, F.length(tx.anchor_norm(F.col("text"))).alias("anchor_length"), F.length(tx.no_punct(F.col("text"))).alias("plain_length"))


@query()
def t_artifacts(spark, d):
    """Composed, display and match text of every artifact with the match-to-raw index."""
    df = table(spark, d, "text_artifact").dropDuplicates(["episode_id", "source"])
    return df.select("episode_id", "source", F.struct(*tx.text_artifact(F.col("raw_text"))).alias("a")).select(
        "episode_id", "source", F.length("a.display_norm_text").alias("display_length"), F.sha2("a.match_norm_text", 256).alias("match_hash"), F.size("a.raw_index").alias("index_size")
    )


# --- segmentation

_G5 = f"""WITH RECURSIVE u AS (
        SELECT episode_id, sentence_id, start_sec, coalesce(end_sec, start_sec) AS e, len(list_filter(coalesce(boundary_hints, []), lambda h: h.type = 'short_response_period')) > 0 AS short,
            row_number() OVER (PARTITION BY episode_id ORDER BY start_sec, sentence_id) AS rn FROM {U}),
    f AS (SELECT episode_id, rn, sentence_id, sentence_id AS head, start_sec AS st, 1 AS size, e AS last_end, short AS hinted FROM u WHERE rn = 1
        UNION ALL
        SELECT episode_id, rn, sentence_id, CASE WHEN g THEN head ELSE sentence_id END, CASE WHEN g THEN st ELSE start_sec END, CASE WHEN g THEN size + 1 ELSE 1 END, e, short FROM (
            SELECT u.episode_id, u.rn, u.sentence_id, u.start_sec, u.e, u.short, f.head, f.st, f.size,
                NOT (f.size >= 2 AND f.last_end - f.st >= 8.0) AND NOT (f.size >= 2 AND (f.hinted OR u.short)) AND f.size < 5 AND (u.e - f.st <= 25.0 OR f.size < 2) AS g
            FROM f JOIN u ON u.episode_id = f.episode_id AND u.rn = f.rn + 1)),
    w AS (SELECT f.*, u.start_sec, u.e, count(*) OVER h AS n, min(u.start_sec) OVER h AS s0, last_value(u.e) OVER (PARTITION BY f.episode_id, f.head ORDER BY f.rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS e1
        FROM f JOIN u USING (episode_id, rn) WINDOW h AS (PARTITION BY f.episode_id, f.head)),
    p AS (SELECT *, n > 1 AND e1 - s0 > 25.0 AS split FROM w),
    b AS (SELECT episode_id, CASE WHEN split THEN sentence_id ELSE head END AS first_id, count(*) AS sentence_count, min_by(start_sec, rn) AS start_sec, max_by(e, rn) AS end_sec, bool_or(split) AS is_sub_block, min(rn) AS rn
        FROM p GROUP BY 1, 2)
    SELECT episode_id, printf('block_%06d', row_number() OVER (PARTITION BY episode_id ORDER BY rn)) AS block_id, first_id, CAST(sentence_count AS INT) AS sentence_count, start_sec, end_sec, is_sub_block FROM b"""


@query(_G5)
def g_merge_blocks(spark, d):
    """Blocks of all units."""
    df = segmentation.merge_blocks(table(spark, d, "sentence_unit"))
    return df.select("episode_id", "block_id", F.get("sentence_ids", F.lit(0)).alias("first_id"), "sentence_count", "start_sec", "end_sec", "is_sub_block")


@query(f"SELECT DISTINCT episode_id, unnest(sentence_ids) AS sentence_id, block_id FROM {B}")
def g_membership(spark, d):
    """Block of each sentence."""
    return segmentation.block_membership(blocks(spark, d)).distinct()


@query()
def g_units_of_texts(spark, d):
    """Units of the anchor texts, with times spread evenly at 0.2 s a character."""
    texts = table(spark, d, "text_artifact").where("source = 'apple'").dropDuplicates(["episode_id"])
    text = tx.nfc(tx.text_or_empty(F.col("raw_text")))
    runs = F.lit(None).cast("array<struct<text:string,audioTimeRange:struct<startSeconds:double,endSeconds:double>,transcriptionConfidence:double>>")
    texts = texts.select("episode_id", text.alias("full_text"), F.lit(0).alias("has_snapshots"), "source_file")
    timed = texts.withColumn("timeline", segmentation.char_timeline(F.col("full_text"), runs, F.lit(0.0), F.length("full_text") * 0.2))
    return segmentation.sentence_units(timed, tb.TERMINATORS + ".").select("episode_id", "sentence_id", "char_start", "char_end", "start_sec", "end_sec", "unit_kind", "stability_score")


@query(
    f"""WITH RECURSIVE u AS (SELECT episode_id, sentence_id, start_sec, coalesce(end_sec, start_sec) AS e, length(coalesce(text, '')) AS n, row_number() OVER (PARTITION BY episode_id ORDER BY start_sec, sentence_id) AS rn FROM {U}),
    f AS (SELECT episode_id, rn, sentence_id AS head, start_sec AS s0, e AS e0, n AS size FROM u WHERE rn = 1
        UNION ALL
        SELECT episode_id, rn, CASE WHEN g THEN head ELSE sentence_id END, CASE WHEN g THEN s0 ELSE start_sec END, e, CASE WHEN g THEN size + n ELSE n END FROM (
            SELECT u.*, f.head, f.s0, f.size, (f.size < {tb.SHORT_CHUNK_CHARS} OR u.n < {tb.SHORT_CHUNK_CHARS} OR f.e0 - f.s0 < {float(tb.SHORT_CHUNK_SECONDS)}::DOUBLE OR u.e - u.start_sec < {float(tb.SHORT_CHUNK_SECONDS)}::DOUBLE)
                AND f.size + u.n <= {tb.MERGED_CHARS} AND u.e - f.s0 <= {float(tb.MERGED_SECONDS)}::DOUBLE AS g FROM f JOIN u ON u.episode_id = f.episode_id AND u.rn = f.rn + 1))
    SELECT f.episode_id, f.head, min_by(u.start_sec, f.rn) AS start_sec, max_by(u.e, f.rn) AS end_sec, CAST(count(*) AS INT) AS chunks, CAST(sum(u.n) AS INT) AS length FROM f JOIN u USING (episode_id, rn) GROUP BY 1, 2"""
)
def g_short_chunks(spark, d):
    """G6 over all units as chunks."""
    u = units(spark, d).select("episode_id", F.col("sentence_id").alias("chunk_id"), "start_sec", F.coalesce("end_sec", "start_sec").alias("end_sec"), F.coalesce("text", F.lit("")).alias("text"))
    return segmentation.merge_short_chunks(u).select("episode_id", "head", "start_sec", "end_sec", "chunks", F.length("text").alias("length"))


@query(
    f"""WITH RECURSIVE b AS (SELECT episode_id, block_id, start_sec, coalesce(end_sec, start_sec) AS end_sec, row_number() OVER (PARTITION BY episode_id ORDER BY start_sec, block_id) AS rn FROM {B}),
    f AS (SELECT episode_id, block_id, rn, start_sec AS s, end_sec AS e FROM b WHERE rn = 1
        UNION ALL
        SELECT b.episode_id, b.block_id, b.rn, greatest(b.start_sec, f.e), CASE WHEN b.end_sec <= greatest(b.start_sec, f.e) THEN greatest(b.start_sec, f.e) + 0.1::DOUBLE ELSE b.end_sec END
        FROM f JOIN b ON b.episode_id = f.episode_id AND b.rn = f.rn + 1)
    SELECT episode_id, block_id, round(s, 6) AS start_clamped, round(e, 6) AS end_clamped FROM f"""
)
def w_clamp_times(spark, d):
    """W3 over all blocks."""
    rows = blocks(spark, d).select("episode_id", "block_id", "start_sec", F.coalesce("end_sec", "start_sec").alias("end_sec"))
    done = segmentation.clamp_times(rows, "episode_id", "block_id", ["start_sec", "block_id"])
    return done.select("episode_id", "block_id", F.round("start_clamped", 6).alias("start_clamped"), F.round("end_clamped", 6).alias("end_clamped"))


@query(
    f"""SELECT episode_id, block_id, lead(block_id) OVER w AS next_block, lag(block_id) OVER w AS block_before, CAST(row_number() OVER w AS BIGINT) AS block_seq
    FROM {B} WINDOW w AS (PARTITION BY episode_id ORDER BY start_sec, block_id)"""
)
def w_neighbours(spark, d):
    """Neighbours and numbers of all blocks, without a task for a whole episode."""
    order = ["start_sec", "block_id"]
    df = od.with_blocks(blocks(spark, d).select("episode_id", *order), "start_sec", segmentation.BLOCK_SECONDS)
    df = od.neighbours(df, ["episode_id"], order, before={"block_before": F.col("block_id")}, after={"next_block": F.col("block_id")}, number="block_seq")
    return df.select("episode_id", "block_id", "next_block", "block_before", "block_seq")


@query(
    f"""SELECT episode_id, sentence_id, last_value(confidence IGNORE NULLS) OVER (PARTITION BY episode_id ORDER BY start_sec, sentence_id ROWS UNBOUNDED PRECEDING) AS last_confidence FROM {U2}"""
)
def j_as_of_confidence(spark, d):
    """The last confidence known at each unit."""
    order = ["start_sec", "sentence_id"]
    df = od.with_blocks(confidences(spark, d), "start_sec", segmentation.BLOCK_SECONDS)
    return joins.as_of(df, ["episode_id"], order, F.col("confidence").isNotNull(), F.col("confidence"), "last_confidence").select("episode_id", "sentence_id", "last_confidence")


@query(
    f"""WITH w AS (SELECT episode_id, sentence_id, start_sec, confidence, CASE WHEN confidence IS NOT NULL THEN start_sec END AS known_at FROM {U2}),
    s AS (SELECT *, last_value(confidence IGNORE NULLS) OVER b AS bv, last_value(known_at IGNORE NULLS) OVER b AS ba, first_value(confidence IGNORE NULLS) OVER a AS av, first_value(known_at IGNORE NULLS) OVER a AS aa FROM w
        WINDOW b AS (PARTITION BY episode_id ORDER BY start_sec, sentence_id ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY episode_id ORDER BY start_sec, sentence_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT episode_id, sentence_id, round(CASE WHEN bv IS NULL THEN av WHEN av IS NULL OR aa = ba THEN bv ELSE bv + (av - bv) * ((start_sec - ba) / (aa - ba)) END, 6) AS confidence FROM s"""
)
def a_interpolated_confidence(spark, d):
    """A2 as a window: unknown confidences between known ones."""
    df = od.with_blocks(confidences(spark, d), "start_sec", segmentation.BLOCK_SECONDS)
    done = joins.interpolated(df, ["episode_id"], "start_sec", "sentence_id", "confidence", "filled")
    return done.select("episode_id", "sentence_id", F.round("filled", 6).alias("confidence"))


# --- similarity and alignment

_PAIR = f"""(SELECT a.episode_id, a.block_id, coalesce(a.text, '') AS a, coalesce(q.text, '') AS q FROM (SELECT * FROM {C} WHERE source = 'apple') a
    JOIN (SELECT * FROM {C} WHERE source = 'qwen') q USING (episode_id, block_id))"""


def pair(spark: SparkSession, d: str) -> DataFrame:
    c = candidates(spark, d)
    a = c.where("source = 'apple'").select(*BLOCK, F.coalesce("text", F.lit("")).alias("a"))
    return a.join(c.where("source = 'qwen'").select(*BLOCK, F.coalesce("text", F.lit("")).alias("q")), BLOCK)


@query(
    f"""WITH x AS (SELECT episode_id, block_id, a, q FROM {_PAIR}),
    ca AS (SELECT episode_id, block_id, ch, count(*) AS n FROM (SELECT episode_id, block_id, unnest(string_split(a, '')) AS ch FROM x WHERE a <> '') GROUP BY ALL),
    cq AS (SELECT episode_id, block_id, ch, count(*) AS n FROM (SELECT episode_id, block_id, unnest(string_split(q, '')) AS ch FROM x WHERE q <> '') GROUP BY ALL),
    c AS (SELECT episode_id, block_id, sum(least(ca.n, cq.n)) AS common FROM ca JOIN cq USING (episode_id, block_id, ch) GROUP BY ALL)
    SELECT episode_id, block_id, round(CASE WHEN length(a) + length(q) = 0 THEN 1.0 WHEN a = '' OR q = '' THEN 0.0 ELSE least(1.0, 2.0 * coalesce(common, 0) / (length(a) + length(q))) END, 6) AS bound
    FROM x LEFT JOIN c USING (episode_id, block_id)"""
)
def m_overlap_bound(spark, d):
    """M3 of anchor and primary candidates."""
    return pair(spark, d).select(*BLOCK, F.round(sm.overlap_bound(F.col("a"), F.col("q")), 6).alias("bound"))


@query(
    f"""WITH n AS (SELECT episode_id, block_id, regexp_replace(q, '({WS}|[、。，．,.!?！？])+', '', 'g') AS c, regexp_replace(a, '({WS}|[、。，．,.!?！？])+', '', 'g') AS a FROM {_PAIR}),
    z AS (SELECT *, least(10, greatest(5, length(a) // 8)) AS k FROM n),
    y AS (SELECT *, substr(c, 1, greatest(24, k * 4)) AS head, substr(c, greatest(length(c) - greatest(24, k * 4) + 1, 1)) AS tail FROM z)
    SELECT episode_id, block_id, length(c) >= 12 AND length(a) >= 12 AND (instr(head, substr(a, 1, k)) - 1 > 3 OR instr(reverse(tail), reverse(substr(a, length(a) - k + 1))) - 1 > 3) AS mismatch FROM y"""
)
def m_anchor_mismatch(spark, d):
    """M9 of anchor and primary candidates."""
    return pair(spark, d).select(*BLOCK, sm.anchor_mismatch(F.col("q"), F.col("a")).alias("mismatch"))


@query(
    f"""SELECT episode_id, block_id, x <> y AND (len(x) > 0 OR len(y) > 0) AS differ FROM (SELECT episode_id, block_id, list_sort(list_distinct(regexp_extract_all(a, '[0-9０-９]+'))) AS x,
    list_sort(list_distinct(regexp_extract_all(q, '[0-9０-９]+'))) AS y FROM {_PAIR})"""
)
def r_numbers_differ(spark, d):
    """R2 of anchor and primary candidates."""
    return pair(spark, d).select(*BLOCK, risk.numbers_differ(F.col("a"), F.col("q")).alias("differ"))


@query()
def m_pair_ratio(spark, d):
    """M1 and M2 of anchor and primary candidates."""
    df = pair(spark, d).withColumn("x", tx.match_norm(F.col("a"))).withColumn("y", tx.match_norm(F.col("q")))
    return df.select(*BLOCK, F.round(sm.sequence_ratio(F.col("x"), F.col("y")), 6).alias("ratio"))


@query()
def a_alignments(spark, d):
    """A1-A3: alignment of every engine text with its anchor text."""
    texts = table(spark, d, "text_artifact").dropDuplicates(["episode_id", "source"]).where("source <> 'apple_txt'").select("episode_id", "source", "raw_text")
    return alignment.align_engines(texts).select("episode_id", "engine", "anchor_length", "engine_length", "global_alignment_score", "coverage_ratio", F.size("anchors").alias("anchors"))


# --- risk and fusion

_KIND = "CASE WHEN local_alignment_score IS NULL THEN NULL WHEN local_alignment_score >= 0.97 THEN 'none' WHEN local_alignment_score >= 0.9 THEN 'soft_domain' WHEN local_alignment_score >= 0.8 THEN 'surface' WHEN local_alignment_score >= 0.5 THEN 'critical' ELSE 'odd' END"


@query(
    f"""WITH a AS (SELECT episode_id, block_id, source, {_KIND} AS k0, coalesce(local_alignment_score, 0) AS loc, coalesce(alignment_score, 0) AS ratio, coalesce(contains(text, '回'), false) AS num,
        coalesce(abs(span_drift_start) > 2, false) AS drift, coalesce(boundary_contamination, false) AS edge FROM {C}),
    b AS (SELECT *, CASE WHEN k0 IN ('none', 'surface', 'soft_domain', 'critical', 'semantic') THEN k0 ELSE 'semantic' END AS kind FROM a),
    c AS (SELECT *, (kind IN ('critical', 'semantic') OR loc < 0.82 OR num OR edge OR (drift AND loc < 0.9)) AND NOT (kind = 'soft_domain' AND ratio >= 0.88 AND loc >= 0.82 AND NOT num) AS needs_review FROM b)
    SELECT episode_id, block_id, source, kind AS difference_type, needs_review, array_to_string(list_filter([CASE WHEN edge THEN 'boundary_contamination_suspected' END, CASE WHEN kind = 'critical' THEN 'critical_term_disagreement' END,
        CASE WHEN drift THEN 'large_span_drift' END, CASE WHEN num THEN 'numeric_disagreement' END, CASE WHEN kind IN ('critical', 'semantic') THEN 'qwen_apple_disagreement' END,
        CASE WHEN kind = 'soft_domain' THEN 'soft_domain_difference' END, CASE WHEN kind = 'surface' THEN 'surface_difference' END], lambda x: x IS NOT NULL), '|') AS flags FROM c"""
)
def r_normalized_flags(spark, d):
    """R9 on flags and types made from the candidates' scores."""
    df = candidates(spark, d).withColumn("kind", F.expr(_KIND))
    flags = F.array_compact(
        F.array(
            F.when(F.coalesce(F.col("text").contains("回"), F.lit(False)), F.lit("numeric_disagreement")),
            F.when(F.coalesce(F.abs("span_drift_start") > 2, F.lit(False)), F.lit("large_span_drift")),
            F.when(F.coalesce("boundary_contamination", F.lit(False)), F.lit("boundary_contamination_suspected")),
        )
    )
    df = df.withColumn("n", risk.normalized_flags(F.col("kind"), F.col("alignment_score"), F.col("local_alignment_score"), flags))
    return df.select(*CAND, "n.difference_type", "n.needs_review", F.array_join("n.risk_flags", "|").alias("flags"))


@query(
    f"""SELECT episode_id, block_id, source, CASE WHEN text IS NULL THEN 'E' WHEN l >= 0.88 AND a >= 0.88 AND NOT r THEN 'A' WHEN l >= 0.75 AND a >= 0.75 AND NOT r THEN 'B' WHEN l >= 0.4 AND a >= 0.45 THEN 'C' WHEN l >= 0.25 THEN 'D' ELSE 'E' END AS grade
    FROM (SELECT *, coalesce(local_alignment_score, 0) AS l, coalesce(max(local_alignment_score) FILTER (source <> 'apple') OVER (PARTITION BY episode_id, block_id), 0) AS a, coalesce(boundary_contamination, false) AS r FROM {C})"""
)
def r_quality_grade(spark, d):
    """R3 on each candidate's score, the best score of its block's engines, and its contamination."""
    c = candidates(spark, d)
    best = c.where("source <> 'apple'").groupBy(*BLOCK).agg(F.max("local_alignment_score").alias("best"))
    l, a = F.coalesce("local_alignment_score", F.lit(0.0)), F.coalesce("best", F.lit(0.0))  # noqa: E741
    return c.join(best, BLOCK, "left").select(*CAND, risk.quality_grade(l, a, risk.no(F.col("boundary_contamination")), F.col("text").isNull()).alias("grade"))


@query()
def r_flagged_blocks(spark, d):
    """R1-R8 and M4 over all blocks and candidates."""
    df = risk.flagged_blocks(table(spark, d, "alignment_block"), table(spark, d, "block_candidate"))
    return df.select(*BLOCK, "qwen_apple_difference_type", F.round("qwen_apple_similarity", 6).alias("qwen_apple_similarity"), F.round("candidate_agreement_score", 6).alias("candidate_agreement_score"), "alignment_quality", "risk_flags", "needs_review")


@query()
def f_final_blocks(spark, d):
    """The final text of every block."""
    flagged = risk.normalized_blocks(risk.flagged_blocks(table(spark, d, "alignment_block"), table(spark, d, "block_candidate")))
    return fusion.final_blocks(flagged, table(spark, d, "sentence_unit")).select(
        *BLOCK, "selected_source", "selection_method", "final_text", "final_text_display", "cleanup_reasons", "cleanup_reverted", "final_risk_flags", "start_sec", "end_sec"
    )


@query(
    f"""SELECT episode_id, block_id, source FROM (SELECT *, row_number() OVER (PARTITION BY episode_id, block_id ORDER BY coalesce(local_alignment_score, 0) DESC,
    CASE source WHEN 'qwen' THEN 0 WHEN 'apple' THEN 1 WHEN 'nemotron' THEN 2 ELSE 3 END) AS rn FROM {C}) WHERE rn = 1"""
)
def k_best_source(spark, d):
    """K3: the source with the best score, ties by priority."""
    rank = F.expr("-(" + " ".join(["CASE source", *[f"WHEN '{s}' THEN {i}" for i, s in enumerate(tb.SOURCE_PRIORITY)], "ELSE 9 END"]) + ")")
    best = F.max_by("source", F.struct(F.coalesce("local_alignment_score", F.lit(0.0)).alias("s"), rank.alias("r")))
    return candidates(spark, d).groupBy(*BLOCK).agg(best.alias("source"))


@query(
    f"""SELECT episode_id, block_id, stability_score, sentence_count FROM (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY coalesce(stability_score, 0), start_sec, block_id) AS rn FROM {B}) WHERE rn <= 10"""
)
def k_least_stable(spark, d):
    """K1 and K2: the ten least stable blocks of each episode."""
    rows = reports.top_rows(blocks(spark, d), ["episode_id"], [F.coalesce("stability_score", F.lit(0.0)).asc(), F.col("start_sec").asc(), F.col("block_id").asc()], 10)
    return rows.select("episode_id", "block_id", "stability_score", "sentence_count")


# --- counts


@query(f"SELECT source, r AS reason, count(*) AS count FROM (SELECT source, unnest(unusable_reason) AS r FROM {C}) GROUP BY ALL")
def h_reason_crosstab(spark, d):
    """H2 and H8: reasons by engine."""
    return reports.crosstab(candidates(spark, d), "source", "unusable_reason").withColumnRenamed("unusable_reason", "reason")


@query(
    f"""SELECT source, count(*) AS rows, count(*) FILTER (usable_for_agreement) AS usable, round_even(avg(local_alignment_score), 4) AS mean_local, max(local_alignment_score) AS max_local, max(search_radius) AS max_radius FROM {C} GROUP BY source"""
)
def h_engine_stats(spark, d):
    """H6 and H7."""
    return reports.engine_stats(candidates(spark, d))


@query(
    f"""SELECT episode_id, count(*) FILTER (skipped) AS skipped, count(*) FILTER (boundary_contamination) AS contaminated, count(*) FILTER (abs(span_drift_start) > 80 OR abs(span_drift_end) > 80) AS drifted,
    count(*) FILTER (local_alignment_score < 0.7) AS low FROM {C} GROUP BY episode_id"""
)
def h_conditional_counts(spark, d):
    """H5: many counts in one pass."""
    from spoolweave.operators.spans import large_drift

    tests = {"skipped": F.col("skipped"), "contaminated": F.col("boundary_contamination"), "drifted": large_drift(F.col("span_drift_start"), F.col("span_drift_end")), "low": F.col("local_alignment_score") < 0.7}
    return reports.conditional_counts(candidates(spark, d), tests, ["episode_id"])


@query("SELECT source AS name, count(*) AS count FROM documents GROUP BY source ORDER BY count DESC, name LIMIT 10")
def h_top_sources(spark, d):
    """H4: the commonest values."""
    return reports.top_counts(table(spark, d, "documents"), "source")


@query(
    f"""SELECT episode_id, block_id, array_to_string(list(source ORDER BY coalesce(local_alignment_score, 0) DESC, source), '|') AS sources FROM {C} GROUP BY episode_id, block_id"""
)
def h_ordered_lists(spark, d):
    """Sources of each block from the best score down."""
    df = candidates(spark, d).withColumn("o", F.struct((-F.coalesce("local_alignment_score", F.lit(0.0))).alias("s"), F.col("source").alias("n")))
    return reports.ordered_list(df, BLOCK, "source", "o").select(*BLOCK, F.array_join("values", "|").alias("sources"))


@query(
    f"""SELECT episode_id, block_id, source, CASE WHEN list_contains(r, 'local_alignment_low') THEN 'local_alignment_low' WHEN list_contains(r, 'boundary_contamination') THEN 'boundary_contamination' WHEN len(r) > 0 THEN r[1] END AS reason
    FROM (SELECT *, coalesce(unusable_reason, []) AS r FROM {C})"""
)
def h_first_reason(spark, d):
    """H9: the first reason by priority."""
    r = F.coalesce("unusable_reason", F.array().cast("array<string>"))
    return candidates(spark, d).select(*CAND, F.coalesce(reports.first_reason(r, ["local_alignment_low", "boundary_contamination"]), F.get(r, F.lit(0))).alias("reason"))


# --- joins and checks


@query(
    f"""SELECT b.episode_id, b.block_id, u.sentence_id FROM {B} b JOIN {U} u ON u.episode_id = b.episode_id AND u.end_sec >= b.start_sec - 0.3 AND u.start_sec <= b.end_sec + 0.3
    WHERE b.end_sec + 0.3 >= b.start_sec - 0.3 AND u.end_sec >= u.start_sec"""
)
def j_interval_overlap(spark, d):
    """Units that overlap a block's time, give or take 0.3 s."""
    left = blocks(spark, d).select("episode_id", "block_id", F.col("start_sec").alias("l_start"), F.col("end_sec").alias("l_end"))
    right = units(spark, d).select("episode_id", "sentence_id", F.col("start_sec").alias("r_start"), F.col("end_sec").alias("r_end"))
    return joins.interval_overlap(left, right, ["episode_id"], 30.0, 0.3).select("episode_id", "block_id", "sentence_id")


@query(
    f"""SELECT episode_id, sentence_id, CAST(length(text) AS INT) AS length, coalesce(char_start < lag(char_end) OVER (PARTITION BY episode_id ORDER BY char_start, sentence_id), false) AS overlap, length(text) < 3 AS very_short,
    text IS DISTINCT FROM substr(whole, char_start + 1, char_end - char_start) AS mismatch FROM {U} LEFT JOIN (SELECT DISTINCT ON (episode_id) episode_id, raw_text AS whole FROM text_artifact WHERE source = 'apple') USING (episode_id)"""
)
def v_units(spark, d):
    """V1 and W4, against the anchor's whole text."""
    whole = table(spark, d, "text_artifact").where("source = 'apple'").dropDuplicates(["episode_id"]).select("episode_id", F.col("raw_text").alias("full_text"))
    return validation.check_units(table(spark, d, "sentence_unit"), whole)


@query(
    f"""WITH m AS (SELECT episode_id, block_id, unnest(sentence_ids) AS sentence_id, generate_subscripts(sentence_ids, 1) AS pos FROM {B}),
    j AS (SELECT m.*, u.text AS t, u.start_sec AS s, u.end_sec AS e, u.episode_id IS NULL AS gone FROM m LEFT JOIN {U} u USING (episode_id, sentence_id)),
    a AS (SELECT episode_id, block_id, count(*) FILTER (t IS NULL) AS missing, count(*) - count(DISTINCT sentence_id) AS repeated, string_agg(coalesce(t, ''), '' ORDER BY pos) AS joined, arg_min_null(s, pos) AS s0, arg_max_null(e, pos) AS e1 FROM j GROUP BY ALL)
    SELECT episode_id, block_id, coalesce(missing, 0) AS missing, coalesce(repeated, 0) AS repeated, joined IS NULL AS empty, text IS DISTINCT FROM joined AS text_mismatch, start_sec IS DISTINCT FROM s0 OR end_sec IS DISTINCT FROM e1 AS time_mismatch FROM {B} b LEFT JOIN a USING (episode_id, block_id)"""
)
def v_blocks(spark, d):
    """Members against the block."""
    return validation.check_blocks(table(spark, d, "alignment_block"), table(spark, d, "sentence_unit"))


@query(f"SELECT DISTINCT episode_id, sentence_id FROM sentence_unit EXCEPT SELECT episode_id, unnest(sentence_ids) FROM {B} WHERE stability_score >= 0.8")
def j_unassigned(spark, d):
    """Sentences in no stable block."""
    return validation.unassigned_sentences(blocks(spark, d).where("stability_score >= 0.8"), table(spark, d, "sentence_unit"))


@query(f"SELECT episode_id, sentence_id, count(*) AS blocks FROM (SELECT DISTINCT episode_id, block_id, unnest(s) AS sentence_id FROM (SELECT *, list_concat(sentence_ids, [lead(sentence_ids[1]) OVER (PARTITION BY episode_id ORDER BY start_sec, block_id)]) AS s FROM {B})) WHERE sentence_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def j_doubly_assigned(spark, d):
    """Sentences in several blocks, where each block also names the first sentence of the next."""
    df = od.with_blocks(blocks(spark, d).select(*BLOCK, "start_sec", "sentence_ids"), "start_sec", segmentation.BLOCK_SECONDS)
    df = od.neighbours(df, ["episode_id"], ["start_sec", "block_id"], after={"next": F.get("sentence_ids", F.lit(0))})
    return validation.doubly_assigned(df.withColumn("sentence_ids", F.array_compact(F.concat("sentence_ids", F.array("next")))))


_D = "(SELECT DISTINCT ON (episode_id, block_id) episode_id, block_id, selected_source FROM llm_decision WHERE selected_source IS NOT NULL ORDER BY episode_id, block_id, request_id)"


@query(
    f"""SELECT episode_id, source, coalesce(sum(search_radius) FILTER (source = coalesce(selected_source, 'unknown')), 0)::DOUBLE AS chosen, coalesce(sum(search_radius) FILTER (source <> coalesce(selected_source, 'unknown')), 0)::DOUBLE AS other
    FROM {C} LEFT JOIN {_D} USING (episode_id, block_id) GROUP BY ALL"""
)
def j_selected_effort(spark, d):
    """Search effort spent on the source selected for a block, and on the others."""
    decided = table(spark, d, "llm_decision").where("selected_source is not null").groupBy(*BLOCK).agg(F.min_by("selected_source", "request_id").alias("selected_source"))
    rows = joins.with_selected_source(candidates(spark, d), decided).withColumn("search_radius", F.coalesce(F.col("search_radius").cast("double"), F.lit(0.0)))
    return reports.split_totals(rows, F.col("source") == F.col("selected_source"), "search_radius", ["episode_id", "source"])


@query(f"SELECT request_id, episode_id, block_id FROM (SELECT DISTINCT request_id, episode_id, block_id FROM llm_decision WHERE needs_review) ORDER BY request_id LIMIT 10")
def k_problem_rows(spark, d):
    """The first ten rows that need a review."""
    rows = table(spark, d, "llm_decision").where("needs_review").select("request_id", "episode_id", "block_id").distinct()
    return reports.top_rows(rows, [], [F.col("request_id").asc()], 10)


@query(f"SELECT source AS name, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, min(episode_id || '|' || block_id || '|' || source)) AS place FROM {C} GROUP BY source")
def h_first_seen(spark, d):
    """H3: values from the commonest down, ties by where they were first seen."""
    c = candidates(spark, d).withColumn("at", F.concat_ws("|", *CAND))
    counts = reports.most_common(c, "source", ["at"])
    return counts.join(c.groupBy(F.col("source").alias("name")).agg(F.min("at").alias("at")), "name").withColumn("place", F.row_number().over(Window.orderBy(F.desc("count"), "at")).cast("bigint")).drop("at")


@query(
    f"""SELECT episode_id, block_id, max_by(source, (coalesce(search_radius, 0)::DOUBLE, source)) AS widest FROM {C} WHERE source <> 'apple' GROUP BY ALL"""
)
def h_dominant(spark, d):
    """The engine whose search was the widest, by a map of efforts."""
    efforts = F.map_from_entries(F.collect_list(F.struct("source", F.coalesce(F.col("search_radius").cast("double"), F.lit(0.0)).alias("v"))))
    return candidates(spark, d).groupBy(*BLOCK).agg(efforts.alias("m")).select(*BLOCK, reports.dominant(F.col("m"), ("apple",)).alias("widest")).where("widest is not null")


_STRIP = f"regexp_replace(coalesce(text, ''), '^{WS}+|{WS}+$', '', 'g')"


def any_of(test: str, column: str, parts) -> str:
    return "(" + " OR ".join(f"{test}({column}, {lit(p)})" for p in parts) + ")" if parts else "false"


@query(
    f"""SELECT episode_id, block_id, source, {any_of("starts_with", "s", tb.SUSPECT_PREFIXES)} OR {any_of("ends_with", "s", tb.SUSPECT_SUFFIXES)} AS suspect,
    length(s) > 0 AND (regexp_matches(right(s, 4), {lit(tb.TRAILING_FRAGMENT)}) OR {any_of("ends_with", "s", tb.TRAILING_FRAGMENTS)}) AS cut_off,
    CASE WHEN s = '' OR {any_of("contains", "s", HARD)} THEN 'human_required' WHEN {any_of("contains", "s", SOFT)} OR starts_with(s, '、') OR starts_with(s, '。') OR {any_of("ends_with", "s", tb.BAD_SUFFIXES)} THEN 'machine_note' END AS level
    FROM (SELECT *, {_STRIP} AS s FROM {C})"""
)
def t_edges(spark, d):
    """T12, T18 and T20 over all candidates."""
    text = F.col("text")
    return candidates(spark, d).select(*CAND, tx.suspect_edge(text).alias("suspect"), tx.trailing_cut(text).alias("cut_off"), tx.pattern_level(text, HARD, SOFT).alias("level"))


@query(
    f"""SELECT episode_id, sentence_id, sha256(text) AS hash, array_to_string(regexp_extract_all(coalesce(text, ''), '[\\x{{3040}}-\\x{{30FF}}\\x{{4E00}}-\\x{{9FFF}}々ー]+'), '|') AS runs,
    CASE WHEN display_text IS NOT NULL AND NOT regexp_full_match(display_text, '{WS}*') THEN display_text WHEN raw_text IS NOT NULL AND NOT regexp_full_match(raw_text, '{WS}*') THEN raw_text
        WHEN text IS NOT NULL AND NOT regexp_full_match(text, '{WS}*') THEN text ELSE '' END AS shown FROM {U}"""
)
def t_values(spark, d):
    """T21, T23 and T24 over all units."""
    text = F.col("text")
    return units(spark, d).select(*UNIT, tx.stable_hash(text).alias("hash"), F.array_join(tx.japanese_word_runs(text), "|").alias("runs"), tx.first_filled(F.col("display_text"), F.col("raw_text"), text, default="").alias("shown"))


@query(f"SELECT request_id, array_to_string(coalesce(review_reason, []), '|') AS reasons, len(coalesce(review_reason, [])) AS n FROM (SELECT DISTINCT ON (request_id) * FROM llm_decision)")
def t_reasons(spark, d):
    """Reasons as lists, null as empty."""
    reasons = tx.reason_list(F.col("review_reason"))
    return table(spark, d, "llm_decision").dropDuplicates(["request_id"]).select("request_id", F.array_join(reasons, "|").alias("reasons"), F.size(reasons).cast("bigint").alias("n"))


@query(
    f"""WITH f AS (SELECT episode_id, unnest(coalesce(unusable_reason, ['none'])) AS r, source FROM {C} WHERE source = 'qwen'),
    k AS (SELECT episode_id, array_to_string(list(r || ':' || n ORDER BY r), '|') AS flags FROM (SELECT episode_id, r, count(*) AS n FROM f GROUP BY ALL) GROUP BY episode_id),
    b AS (SELECT episode_id, count(*) AS block_count, count(*) FILTER (coalesce(boundary_contamination, false)) AS needs_review_count, count(*) FILTER (NOT coalesce(boundary_contamination, false)) AS auto_accepted_count FROM {C} WHERE source = 'qwen' GROUP BY episode_id)
    SELECT b.*, flags FROM b LEFT JOIN k USING (episode_id)"""
)
def v_flag_summary(spark, d):
    """V7, H1 and H2: verdicts and flags of an episode's blocks, on the primary candidates' reasons."""
    rows = candidates(spark, d).where("source = 'qwen'").select(
        *BLOCK, risk.no(F.col("boundary_contamination")).alias("needs_review"), F.coalesce("unusable_reason", F.array(F.lit("none"))).alias("risk_flags"), F.lit("x").alias("qwen_apple_difference_type")
    )
    flags = F.array_join(F.transform(F.map_entries("risk_flag_counts"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), "|")
    return reports.flag_summary(rows).select("episode_id", "block_count", "needs_review_count", "auto_accepted_count", flags.alias("flags"))


# --- sources, outputs, arbitration, spans

_ENGINES = ", ".join(lit(e) for e in tb.ENGINE_SUFFIX)
_T = "(SELECT DISTINCT ON (episode_id, source) episode_id, source, coalesce(raw_text, '') AS raw_text FROM text_artifact)"


def artifact_files(spark: SparkSession, d: str) -> DataFrame:
    """The artifacts as the files a run reads, written to the shared folder and listed."""
    texts = table(spark, d, "text_artifact").dropDuplicates(["episode_id", "source"]).select("episode_id", "source", tx.text_or_empty(F.col("raw_text")).alias("raw_text"))
    return episodes.list_files(spark, sinks.write_episode_files(texts, scratch_folder(spark)), content=True)


@query(f"SELECT episode_id, source, raw_text FROM {_T} WHERE source IN ({_ENGINES})")
def s_engine_texts(spark, d):
    """Engine texts written as files and read back."""
    return episodes.engine_texts(artifact_files(spark, d))


@query(f"SELECT a.episode_id, nfc_normalize(a.raw_text) AS full_text, CAST(length(nfc_normalize(a.raw_text)) AS INT) AS timed, CAST(0 AS INT) AS has_snapshots FROM {_T} a WHERE a.source = 'apple' AND length(a.raw_text) > 0")
def s_anchor_texts(spark, d):
    """Anchor texts written as JSON and archives and read back, with a time for each character."""
    done = episodes.anchor_timeline(artifact_files(spark, d)).where(F.length("full_text") > 0)
    return done.where("source_file is not null").select("episode_id", "full_text", F.size("timeline").alias("timed"), "has_snapshots")


@query(f"SELECT episode_id, sentence_id, text, start_sec, end_sec, confidence, confirmed_snapshot_indexes IS NULL AS unconfirmed FROM (SELECT DISTINCT ON (episode_id, sentence_id) episode_id, sentence_id, text, start_sec, end_sec, confirmed_snapshot_indexes, max(confidence) OVER (PARTITION BY episode_id, sentence_id) AS confidence FROM sentence_unit)")
def s_table_round_trip(spark, d):
    """The units written as JSON lines by episode and read back."""
    best = Window.partitionBy(*UNIT)
    rows = table(spark, d, "sentence_unit").withColumn("confidence", F.max("confidence").over(best)).dropDuplicates(UNIT).select(*UNIT, "text", "start_sec", "end_sec", "confidence", "confirmed_snapshot_indexes")
    path = sinks.write_table(rows, scratch_folder(spark), "units")
    back = episodes.read_jsonl(spark, path, ", ".join(f"{n} {t}" for n, t in rows.dtypes))
    return back.select(*UNIT, "text", "start_sec", "end_sec", "confidence", F.col("confirmed_snapshot_indexes").isNull().alias("unconfirmed"))


_PROMPT = " || chr(10) || ".join([lit(arbitration.INSTRUCTION), *[f"'{x}: ' || coalesce(max(text) FILTER (source = '{x}'), '')" for x in tb.SOURCES]])


@query(f"SELECT episode_id, block_id, sha256(episode_id || '|' || block_id || '|{arbitration.VERSION}|' || sha256({_PROMPT})) AS cache_key FROM {C} GROUP BY episode_id, block_id")
def l_cache_keys(spark, d):
    """Prompt and key of every block's request."""
    texts = candidates(spark, d).groupBy(*BLOCK).agg(*[F.max(F.when(F.col("source") == x, F.col("text"))).alias(f"{x}_text") for x in tb.SOURCES])
    return texts.select(*BLOCK, arbitration.cache_key(arbitration.request(texts)).alias("cache_key"))


@query()
def l_applied_decisions(spark, d):
    """The table's decisions applied to the primary texts of their blocks."""
    texts = candidates(spark, d).groupBy(*BLOCK).agg(*[F.max(F.when(F.col("source") == x, F.col("text"))).alias(f"{x}_text") for x in tb.SOURCES])
    finals = texts.withColumn("selected_source", F.lit(tb.PRIMARY)).withColumn("final_text", F.col(f"{tb.PRIMARY}_text"))
    made = table(spark, d, "llm_decision").groupBy(*BLOCK).agg(F.min_by(F.struct("success", "error", "selected_source", "final_text"), "request_id").alias("x")).select(*BLOCK, "x.*")
    return arbitration.apply_decisions(finals, made.withColumn("success", F.coalesce("success", F.lit(False)))).select(*BLOCK, "selected_source", "final_text", "method", "accepted", "changed", "reasons")


def timed_texts(spark: SparkSession, d: str) -> DataFrame:
    """The anchor texts with times spread evenly at 0.2 s a character."""
    texts = table(spark, d, "text_artifact").where("source = 'apple'").dropDuplicates(["episode_id"])
    texts = texts.select("episode_id", tx.nfc(tx.text_or_empty(F.col("raw_text"))).alias("full_text"), "source_file")
    runs = F.lit(None).cast("array<struct<text:string,audioTimeRange:struct<startSeconds:double,endSeconds:double>,transcriptionConfidence:double>>")
    return texts.withColumn("timeline", segmentation.char_timeline(F.col("full_text"), runs, F.lit(0.0), F.length("full_text") * 0.2))


@query()
def a_block_candidates(spark, d):
    """Candidate spans in every engine's text for the segments of every anchor text, with what a span must hold."""
    texts = table(spark, d, "text_artifact").dropDuplicates(["episode_id", "source"]).where("source <> 'apple_txt'").select("episode_id", "source", "raw_text")
    parts = segmentation.segment_records(timed_texts(spark, d), tb.TERMINATORS + ".").select("episode_id", F.col("segment_id").alias("block_id"), "char_start", "char_end")
    found = spans.block_candidates(parts, texts, alignment.align_engines(texts))
    rows = found.join(texts.select("episode_id", "source", tx.nfc(tx.text_or_empty(F.col("raw_text"))).alias("whole")), ["episode_id", "source"])
    span = F.substring("whole", F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    free = F.col("skipped") | (F.length("text") == 0)
    return rows.select(
        *CAND,
        (free | F.contains(F.col("whole"), F.col("text")) & (F.contains(span, F.col("text")) | (F.length(tx.strip(span)) == 0))).alias("text_in_place"),
        ((F.col("char_start") - F.col("initial_char_start") == F.col("span_drift_start")) & (F.col("char_end") - F.col("initial_char_end") == F.col("span_drift_end"))).alias("drift_adds_up"),
        F.col("local_alignment_score").between(0, 1).alias("score_in_range"),
        (F.col("usable_for_agreement") | (F.size("unusable_reason") > 0)).alias("reason_if_unusable"),
    )


@query()
def g_segment_records(spark, d):
    """Segment records of the anchor texts, with times spread evenly at 0.2 s a character."""
    return segmentation.segment_records(timed_texts(spark, d), tb.TERMINATORS + ".")


@query()
def m_candidate_scores(spark, d):
    """M5 and M6: agreement of each block's usable candidates with its flag, and the pairwise ratios."""
    texts = candidates(spark, d).groupBy(*BLOCK).agg(
        *[F.max(F.when(F.col("source") == x, F.col("text"))).alias(f"__{x}") for x in tb.SOURCES],
        *[F.coalesce(F.bool_or(F.when(F.col("source") == x, F.col("usable_for_agreement"))), F.lit(False)).alias(f"{x}_usable") for x in tb.SOURCES],
    )
    for x in tb.SOURCES:
        texts = texts.withColumn(f"{x}_text", tx.text_or_empty(F.col(f"__{x}"))).withColumn(f"{x}_norm", tx.match_norm(F.col(f"{x}_text"))).drop(f"__{x}")
    scored = fusion.agreement_metrics(texts.withColumn("score", sm.score_candidates({x: (F.col(f"{x}_norm"), F.col(f"{x}_usable")) for x in tb.SOURCES})))
    ratios = [c for c in scored.columns if c.endswith("_similarity")]
    return scored.select(*BLOCK, F.round("score.agreement", 6).alias("agreement"), "score.flags", *[F.round(c, 6).alias(c) for c in ratios], "qwen_boundary_tainted")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
