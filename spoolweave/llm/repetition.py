"""Problem 2: how much of a text repeats earlier parts of the same text.

The share of repetition is the share of letters that stand in a passage of 8 or more
letters which occurred earlier in the text; case, width, punctuation and spacing aside.

To find the texts in which repetition prevails, a cascade of necessary conditions rejects
most texts before the exact share is computed. Cost and rejections are measured once, on
SAMPLE texts spread over the whole table (the smallest hashes of the keys): the condition
with the most rejections per second goes first, the next is the best on the texts left over,
and so on; a condition that rejects none of those is left out. The order decides only the
time taken: every condition is sound, so the result is the same in any order.

Defined cases: null or empty texts have share 0 and are never found; under 9 letters
nothing can repeat; a redelivered row gives one row; extra columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolweave.functions import charmap as cm

PASSAGE = 8
PREVAILS = 0.5
SAMPLE = 400
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_codes(letters: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit code for the k letters from each position (the last k - 1 positions excepted)."""
    n = len(letters) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = letters.astype(np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = (out ^ wide[j : j + n]) * _MIX
            out ^= out >> np.uint64(29)
    return out


def repeated_letters(letters: np.ndarray, k: int = PASSAGE) -> int:
    """Letters of one text that stand in a passage of k or more letters seen earlier."""
    grams = gram_codes(letters, k)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    again = np.zeros(len(grams), bool)
    same = grams[order[1:]] == grams[order[:-1]]
    again[order[1:][same]] = True
    edge = np.zeros(len(letters) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _few_grams(k: int, share: float) -> Callable[[np.ndarray], bool]:
    """Of C repeated letters in runs of at least 8, at least C (9 - k) / 8 k-grams start again."""
    least = share * (PASSAGE + 1 - k) / PASSAGE

    def rejects(letters: np.ndarray) -> bool:
        n = len(letters) - k + 1
        if n <= 0:
            return True
        return n - len(set(_grams(letters, k))) < least * len(letters)

    return rejects


def _grams(letters: np.ndarray, k: int) -> list[int]:
    if k == 1:
        return letters.tolist()
    wide = letters.astype(np.int64)
    n = len(letters) - k + 1
    out = wide[:n].copy()
    for j in range(1, k):
        # up to three letters stay exact in 63 bits; more are mixed
        out = (out << 21) + wide[j : j + n] if k <= 3 else (out * 1_000_003) ^ wide[j : j + n]
    return out.tolist()


RULES: dict[str, Callable[[np.ndarray], bool]] = {
    "short": lambda letters: len(letters) < PASSAGE + 1,
    "single letters": _few_grams(1, PREVAILS),
    "pairs": _few_grams(2, PREVAILS),
    "triples": _few_grams(3, PREVAILS),
    "passages": _few_grams(PASSAGE, PREVAILS),
}


@dataclass
class Step:
    """A rule of the cascade, and what it did to the texts of the sample that came to it."""

    rule: str
    seen: int
    rejected: int
    seconds: float


def plan_rules(sample: list[np.ndarray], clock: Callable[[], float] = time.perf_counter) -> list[Step]:
    """The cascade: at each step the rule with the most rejections per second among the texts no earlier one rejected."""
    steps: list[Step] = []
    left, open_ = sample, dict(RULES)
    while left and open_:
        trials = []
        for name, rule in open_.items():
            began = clock()
            out = [rule(x) for x in left]
            trials.append((Step(name, len(left), sum(out), max(clock() - began, 1e-9)), out))
        best, out = max(trials, key=lambda t: t[0].rejected / t[0].seconds)
        if not best.rejected:
            break
        steps.append(best)
        left = [x for x, gone in zip(left, out, strict=True) if not gone]
        del open_[best.rule]
    return steps


def sampled_letters(slim: DataFrame, keys: list[str], most: int = SAMPLE) -> list[np.ndarray]:
    """Letters of at most ``most`` texts with the smallest hashes of their keys."""
    rows = slim.orderBy(F.xxhash64(*keys), *keys).select("__text").limit(most).collect()
    return [letters for _, letters in _texts([r[0] for r in rows])]


def prevails(letters: np.ndarray, order: list[str]) -> bool:
    """Whether at least half of the letters are repeated; the cascade, then the exact share."""
    for name in order:
        if RULES[name](letters):
            return False
    return repeated_letters(letters) * 2 >= len(letters)


def _texts(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    texts = [t or "" for t in texts]
    for a, b in cm.groups(texts):
        letters, at = cm.folded(texts[a:b], marks=True)
        for i in range(a, b):
            yield i, letters[at[i - a] : at[i - a + 1]]


def _found(batches: Iterator[pa.RecordBatch], keys: list[str], order: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = pa.array([i for i, x in _texts(batch.column("__text").to_pylist()) if prevails(x, order)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(k).take(keep) for k in keys], names=keys)


def _slim(df: DataFrame, column: str, keys: list[str]) -> tuple[DataFrame, str]:
    slim = df.select(*[F.col(k) for k in keys], F.col(column).alias("__text"))
    return slim, ", ".join(f"`{k}` {t}" for k, t in slim.dtypes if k != "__text")


def repetitive(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Keys of the texts in which repetition prevails."""
    slim, schema = _slim(df, column, keys)
    slim = slim.where(F.length("__text") > PASSAGE)
    order = [step.rule for step in plan_rules(sampled_letters(slim, keys))]
    return slim.mapInArrow(lambda it: _found(it, keys, order), schema).distinct()


def cascade(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """The cascade as planned for a table: place, rule, texts of the sample seen and rejected, and seconds they took."""
    slim, _ = _slim(df, column, keys)
    steps = plan_rules(sampled_letters(slim.where(F.length("__text") > PASSAGE), keys))
    rows = [(i + 1, s.rule, s.seen, s.rejected, s.seconds) for i, s in enumerate(steps)]
    return df.sparkSession.createDataFrame(rows, "place int, rule string, seen int, rejected int, seconds double")


def _shares(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, again = [], []
        for _, x in _texts(batch.column("__text").to_pylist()):
            n.append(len(x))
            again.append(repeated_letters(x))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(n, pa.int64()), pa.array(again, pa.int64())], names=[*keys, "letters", "repeated"])


def repetition_shares(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """keys, letters, repeated letters, their share, and whether repetition prevails."""
    slim, schema = _slim(df, column, keys)
    out = slim.mapInArrow(lambda it: _shares(it, keys), schema + ", letters bigint, repeated bigint").distinct()
    share = F.when(F.col("letters") > 0, F.col("repeated") / F.col("letters")).otherwise(F.lit(0.0))
    return out.withColumn("share", share).withColumn("prevails", (F.col("letters") > 0) & (F.col("repeated") * 2 >= F.col("letters")))
