"""Problem 5: oversized blocks cut into pieces at sentence boundaries, one sentence of overlap.

Per block: prefix sums of the sentence lengths form the sorted boundary array, the last
boundary under the limit is found by binary search, the next piece steps back by the
overlapping sentence where that leaves room, and a sentence over the limit is cut inside
(at the last space or mark under the limit, else hard; OVERLAP characters back each time).

Only oversized blocks leave the scan, and only the sentences they name are joined, by a
shuffle on (episode, sentence); a block's sentences meet in one row, as in its sentence_ids.

Defined cases: sentence_ids named twice count once, ids without a sentence or null are left
out, null text counts as length 0, equal start times are ordered by sentence_id; a block
with null text, or none of whose sentences exist, has no pieces; redelivered rows count
once; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 400
#: Characters that the parts of a sentence over the limit share with the part before.
OVERLAP = 40


def cut_pieces(lengths: list[int], limit: int = LIMIT) -> list[tuple[int, int]]:
    """(first, last) sentence of each piece."""
    n = len(lengths)
    ends = np.concatenate(([0], np.cumsum(np.asarray(lengths, dtype=np.int64))))
    out, i = [], 0
    while i < n:
        # last boundary at or under the limit, counted from this sentence's start
        j = max(int(np.searchsorted(ends, ends[i] + limit, side="right")) - 2, i)
        j = min(j, n - 1)
        out.append((i, j))
        if j == n - 1:
            break
        alone = j == i
        i = j + 1 if alone or lengths[j] + lengths[j + 1] > limit else j
    return out


NATURAL = regex.compile("(?<=[。．！？!?；;])|(?<=[.…](?=\\s))|(?<=[、，,])|(?<=\\s)", regex.V0)


def cut_inside(text: str, limit: int = LIMIT, overlap: int = 0) -> list[tuple[int, int]]:
    """Pieces of one text over the limit: at natural boundaries, else hard; with an overlap in characters."""
    bounds = np.asarray(sorted({m.start() for m in NATURAL.finditer(text)} | {0, len(text)}), dtype=np.int64)
    out, at = [], 0
    while len(text) - at > limit:
        k = int(np.searchsorted(bounds, at + limit, side="right")) - 1
        end = int(bounds[k])
        if end <= at + overlap:
            end = at + limit
        out.append((at, end))
        at = end - overlap
    out.append((at, len(text)))
    return out


def oversized_sentences(blocks: DataFrame, units: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """The distinct sentences that oversized blocks name, and all sentences with their size."""
    large = blocks.where(F.length("text") > limit).select("episode_id", "block_id", F.explode("sentence_ids").alias("sentence_id")).where("sentence_id is not null").distinct()
    sentences = units.where("sentence_id is not null").select("episode_id", "sentence_id", "start_sec", F.coalesce(F.length("text"), F.lit(0)).alias("size"), F.coalesce("text", F.lit("")).alias("text"))
    return large, sentences


def _cut(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, no, first, last, size = [], [], [], [], []
        for r, sentences in enumerate(batch.column("sentences").to_pylist()):
            lengths = [s["size"] for s in sentences]
            for k, (i, j) in enumerate(cut_pieces(lengths, limit)):
                rows.append(r)
                no.append(k + 1)
                first.append(sentences[i]["sentence_id"])
                last.append(sentences[j]["sentence_id"])
                size.append(sum(lengths[i : j + 1]))
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_pydict(
            {
                "episode_id": batch.column("episode_id").take(taken),
                "block_id": batch.column("block_id").take(taken),
                "piece_no": pa.array(no, pa.int32()),
                "first_sentence_id": pa.array(first, pa.string()),
                "last_sentence_id": pa.array(last, pa.string()),
                "size": pa.array(size, pa.int64()),
            }
        )


def block_pieces(blocks: DataFrame, units: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Pieces of the oversized blocks; size is in code points and over the limit only for a single long sentence."""
    large, sentences = oversized_sentences(blocks, units, limit)
    joined = large.join(sentences.drop("text"), ["episode_id", "sentence_id"]).dropDuplicates(["episode_id", "block_id", "sentence_id"])
    lists = joined.groupBy("episode_id", "block_id").agg(F.array_sort(F.collect_list(F.struct("start_sec", "sentence_id", "size"))).alias("sentences"))
    schema = "episode_id string, block_id string, piece_no int, first_sentence_id string, last_sentence_id string, size bigint"
    return lists.mapInArrow(lambda it: _cut(it, limit), schema)


def _inner(batches: Iterator[pa.RecordBatch], limit: int, overlap: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, no, a, b = [], [], [], []
        for r, text in enumerate(batch.column("text").to_pylist()):
            for k, (x, y) in enumerate(cut_inside(text, limit, overlap)):
                rows.append(r)
                no.append(k + 1)
                a.append(x)
                b.append(y)
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_pydict(
            {
                "episode_id": batch.column("episode_id").take(taken),
                "block_id": batch.column("block_id").take(taken),
                "sentence_id": batch.column("sentence_id").take(taken),
                "part_no": pa.array(no, pa.int32()),
                "char_start": pa.array(a, pa.int32()),
                "char_end": pa.array(b, pa.int32()),
            }
        )


def long_sentence_parts(blocks: DataFrame, units: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The inner cuts of sentences over the limit, for the oversized blocks that name them."""
    large, sentences = oversized_sentences(blocks, units, limit)
    joined = large.join(sentences.where(F.col("size") > limit), ["episode_id", "sentence_id"]).dropDuplicates(["episode_id", "block_id", "sentence_id"])
    schema = "episode_id string, block_id string, sentence_id string, part_no int, char_start int, char_end int"
    return joined.select("episode_id", "block_id", "sentence_id", "text").mapInArrow(lambda it: _inner(it, limit, overlap), schema)
