"""Problem 8: mix sources to target shares of tokens, small sources repeated up to a cap.

Each distinct text counts once, under the document with the smallest id that has it, so no
text stands more often in the mix than its source's cap. The mix is as large as the caps
allow while every source has exactly its share: size = min over sources of
available * cap / weight; or smaller, if a total is asked for.

Within a source, texts are ordered by a seeded hash of their content. The hash's leading
bits range-partition the order into buckets; sums of tokens by bucket and a scan over the
buckets give every bucket its place, so all buckets but the one in which a source's budget
ends are decided whole. Only rows of those cut buckets are numbered one by one. A source
whose budget exceeds its tokens goes through whole epochs first.

The cut keeps the text at the budget if at least half of it fits, so a source's size is off
by at most half a text. Shares reached are reported beside the targets.

Defined cases: null or blank sources, and sources without a target, are left out, as are
empty texts; spellings of a source (case, blanks, hyphens) are one source; a target without
documents is left out and the other weights are scaled up; weights of zero or null weigh
nothing; a null max_repeats is 1. Empty tables give an empty mix. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolweave.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Word pattern of the byte-level vocabularies; fixed by the vocabulary files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKET_BITS = 14
SEED = 20


@lru_cache(2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str, path: str = TOKENIZER) -> int:
    return len(_encoder(path).encode_ordinary(text))


def source_key(source: Column) -> Column:
    """One spelling for a source: lower case, words joined by underscores."""
    key = F.regexp_replace(F.trim(F.lower(source)), "[\\s\\-_]+", "_")
    return F.when(key != "", key)


def _sizes(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encode = _encoder(path).encode_ordinary
    for batch in batches:
        texts = batch.column("text").to_pylist()
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "source": batch.column("source"),
                "text_id": pa.array([xxhash.xxh3_128_digest(b) for b in raw], pa.binary()),
                "tokens": pa.array([len(encode(t)) for t in texts], pa.int64()),
            }
        )


def document_sizes(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per distinct text of the target sources: smallest doc_id, its source, tokens."""
    wanted = targets.select(source_key(F.col("source")).alias("source")).where("source is not null").distinct()
    slim = documents.select("doc_id", source_key(F.col("source")).alias("source"), "text").where((F.length("text") > 0) & F.col("doc_id").isNotNull())
    slim = slim.join(wanted, "source", "left_semi").select("doc_id", "source", "text")
    kind = dict(slim.dtypes)["doc_id"]
    sized = slim.mapInArrow(lambda it: _sizes(it, tokenizer), f"doc_id {kind}, source string, text_id binary, tokens bigint")
    one = sized.groupBy("text_id").agg(F.min(F.struct("doc_id", "source", "tokens")).alias("d"))
    return one.select("text_id", "d.*")


def source_plan(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """Per source: available tokens, weight, cap, budget, whole epochs and the rest of the budget."""
    clean = (
        targets.select(source_key(F.col("source")).alias("source"), F.coalesce("target_weight", F.lit(0.0)).cast("double").alias("weight"), F.coalesce("max_repeats", F.lit(1)).cast("bigint").alias("cap"))
        .where("source is not null and weight > 0 and cap > 0")
        .groupBy("source")
        .agg(F.sum("weight").alias("weight"), F.max("cap").alias("cap"))
    )
    have = sizes.groupBy("source").agg(F.sum("tokens").alias("available"), F.count("*").alias("texts")).where("available > 0")
    every = Window.partitionBy(F.lit(1))  # one row a source
    plan = clean.join(have, "source").withColumn("weight", F.col("weight") / F.sum("weight").over(every))
    plan = plan.withColumn("mix", F.min(F.col("available") * F.col("cap") / F.col("weight")).over(every))
    if total is not None:
        plan = plan.withColumn("mix", F.least(F.col("mix"), F.lit(float(total))))
    plan = plan.withColumn("budget", F.least(F.round(F.col("mix") * F.col("weight")).cast("bigint"), F.col("available") * F.col("cap")))
    plan = plan.withColumn("epochs", F.floor(F.col("budget") / F.col("available")))
    return plan.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available"))


def mix_sources(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = SEED, total: int | None = None) -> DataFrame:
    """doc_id, source, tokens and repeats of the chosen texts; ``total`` is the size wished for, in tokens."""
    order = F.xxhash64("text_id", F.lit(seed))
    sizes = cut(document_sizes(documents, targets, tokenizer).withColumn("place", order).withColumn("bucket", F.shiftright("place", 64 - BUCKET_BITS)))
    plan = source_plan(sizes, targets, total).select("source", "epochs", "rest")
    # scan over at most 2 ** BUCKET_BITS rows a source
    scan = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = sizes.groupBy("source", "bucket").agg(F.sum("tokens").alias("sum")).join(plan, "source").withColumn("through", F.sum("sum").over(scan))
    buckets = buckets.withColumn("before", F.col("through") - F.col("sum")).withColumn(
        "part", F.when(F.col("through") <= F.col("rest"), "all").when(F.col("before") >= F.col("rest"), "none").otherwise("cut")
    )
    placed = sizes.join(buckets.select("source", "bucket", "epochs", "rest", "before", "part"), ["source", "bucket"])
    whole = placed.where("part <> 'cut'").withColumn("repeats", F.col("epochs") + F.when(F.col("part") == "all", 1).otherwise(0))
    run = Window.partitionBy("source", "bucket").orderBy("place", "text_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = placed.where("part = 'cut'").withColumn("after", F.col("before") + F.sum("tokens").over(run))
    edge = edge.withColumn("repeats", F.col("epochs") + F.when(F.col("after") - F.col("tokens") / 2 <= F.col("rest"), 1).otherwise(0))
    columns = ["doc_id", "source", "tokens", F.col("repeats").cast("int").alias("repeats")]
    return whole.select(*columns).unionByName(edge.select(*columns)).where("repeats > 0")


def mix_shares(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, seed: int = SEED, total: int | None = None) -> DataFrame:
    """Per source: its target share, the tokens and share reached, texts, and the most repeats."""
    mixed = mix_sources(documents, targets, tokenizer, seed, total)
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("texts"), F.max("repeats").alias("most_repeats"))
    weights = targets.select(source_key(F.col("source")).alias("source"), "target_weight").where("source is not null").groupBy("source").agg(F.sum("target_weight").alias("target_share"))
    out = weights.join(got, "source", "left").fillna(0, ["tokens", "texts", "most_repeats"])
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # one row a source
    return out.withColumn("share", F.when(total > 0, F.col("tokens") / total).otherwise(F.lit(0.0)))
