"""Similarity of texts.

The sequence ratio is the one of the standard library's matcher (not symmetric); no built-in
equals it, so it is an Arrow function. Everything around it is built in: the multiset bound
is a sound pre-filter, and equal or empty pairs never reach Python.
"""

from __future__ import annotations

import difflib
from itertools import combinations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolweave.functions import text as tx


def _equal_after(a: str, b: str, i: int, j: int, most: int) -> int:
    """How many characters from a[i] and b[j] on are equal, at most so many."""
    k, step = 0, 8
    while k < most:
        n = min(step, most - k)
        if a[i + k : i + k + n] == b[j + k : j + k + n]:
            k, step = k + n, 2 * step
        else:
            most, step = k + n - 1, n // 2
    return k


def _equal_before(a: str, b: str, i: int, j: int, most: int) -> int:
    """The same for the characters before a[i] and b[j]."""
    k, step = 0, 8
    while k < most:
        n = min(step, most - k)
        if a[i - k - n : i - k] == b[j - k - n : j - k]:
            k, step = k + n, 2 * step
        else:
            most, step = k + n - 1, n // 2
    return k


#: Runs up to this length are met by their grams, longer ones by blocks.
SHORT_RUN = 8


def _short_run(a: str, b: str, alo: int, ahi: int, blo: int, bhi: int, most: int) -> tuple[int, int, int]:
    """Longest equal run where none is longer than ``most``, by halving what is open of its length."""
    i = size = 0
    while size < most:
        n = (size + most + 1) // 2
        if 8 * (ahi - alo) < bhi - blo:
            places = (p for p in range(alo, ahi - n + 1) if b.find(a[p : p + n], blo, bhi) >= 0)
        else:
            grams = {b[j : j + n] for j in range(blo, bhi - n + 1)}
            places = (p for p in range(alo, ahi - n + 1) if a[p : p + n] in grams)
        p = next(places, None)
        if p is None:
            most = n - 1
        else:
            i, size = p, n
    return i, b.find(a[i : i + size], blo, bhi), size


def _longest_run(a: str, b: str, alo: int, ahi: int, blo: int, bhi: int, most: int) -> tuple[int, int, int]:
    """Longest equal run of a[alo:ahi] and b[blo:bhi], the first in a, then in b; no run is longer than ``most``.

    A run of 2g - 1 characters or more holds one of the blocks that cut a into g characters each. So every run
    that long is met by looking up the blocks in b and widening what is found; g is halved until that holds for the best run.
    """
    i = j = size = 0
    most = min(ahi - alo, bhi - blo, most)
    g = (most + 1) // 2
    while most > SHORT_RUN:
        done: dict[int, int] = {}  # where the last run of a diagonal ends in a
        for p in range(alo, ahi - g + 1, g):
            block = a[p : p + g]
            q = b.find(block, blo, bhi)
            while q >= 0:
                if done.get(q - p, 0) <= p:
                    before = _equal_before(a, b, p, q, min(p - alo, q - blo))
                    k = before + g + _equal_after(a, b, p + g, q + g, min(ahi - p, bhi - q) - g)
                    x, y = p - before, q - before
                    done[q - p] = x + k
                    if k > size or (k == size and (x, y) < (i, j)):
                        i, j, size = x, y, k
                q = b.find(block, q + 1, bhi)
        if size >= 2 * g - 1:
            return i, j, size
        most = 2 * g - 2
        g = (size + 1) // 2 if size else g // 2
    return _short_run(a, b, alo, ahi, blo, bhi, most)


def longest_run(a: str, b: str) -> tuple[int, int, int]:
    """Longest equal run of two filled texts, the first in a, then in b: its places and length."""
    return _longest_run(a, b, 0, len(a), 0, len(b), len(a))


def matching_runs(a: str, b: str) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the matching blocks that the standard library's matcher finds without junk, in order.

    The longest run first, then the same to its left and right, as there; but runs are found by string search, so similar texts
    take time by their length and not by its square.
    """
    runs, todo = [], [(0, len(a), 0, len(b), len(a))] if a and b else []
    while todo:
        alo, ahi, blo, bhi, most = todo.pop()
        i, j, k = _longest_run(a, b, alo, ahi, blo, bhi, most)
        if k:
            runs.append((i, j, k))
            if alo < i and blo < j:
                todo.append((alo, i, blo, j, k))
            if i + k < ahi and j + k < bhi:
                todo.append((i + k, ahi, j + k, bhi, k))
    return sorted(runs)


class Matched:
    """Ratios of a target to many stretches of one text, which share most of their parts: what matches in a part is found once."""

    def __init__(self, target: str, text: str) -> None:
        self.target, self.text = target, text
        self.known: dict[tuple[int, int, int, int], int] = {}
        self.widest: dict[int, tuple[int, int, int]] = {}  # longest run from a start to the end of the text

    def ratio(self, start: int, end: int) -> float:
        """The ratio to text[start:end]."""
        a, end = self.target, min(end, len(self.text))
        if self.text[start:end] == a:
            return 1.0
        return 2.0 * self.count(0, len(a), start, end, len(a)) / (len(a) + end - start) if a and start < end else 0.0

    def _run(self, alo: int, ahi: int, blo: int, bhi: int, most: int) -> tuple[int, int, int]:
        if alo == 0 and ahi == len(self.target):
            wide = self.widest.get(blo)
            if wide is None:
                wide = self.widest[blo] = _longest_run(self.target, self.text, alo, ahi, blo, len(self.text), most)
            # the longest run of a wider stretch is that of every part which holds it
            if wide[1] + wide[2] <= bhi:
                return wide
            most = min(most, wide[2])
        return _longest_run(self.target, self.text, alo, ahi, blo, bhi, most)

    def count(self, alo: int, ahi: int, blo: int, bhi: int, most: int) -> int:
        """Matched characters of target[alo:ahi] and text[blo:bhi]. To the left of a longest run are only shorter ones, so the calls do not nest deep."""
        done, total = [], 0
        while alo < ahi and blo < bhi:
            key = (alo, ahi, blo, bhi)
            if (known := self.known.get(key)) is not None:
                total = known
                break
            i, j, k = self._run(alo, ahi, blo, bhi, most)
            done.append((key, k + (self.count(alo, i, blo, j, k - 1) if k > 1 else 0)))
            if not k:
                break
            alo, blo, most = i + k, j + k, k
        for key, own in reversed(done):
            total += own
            self.known[key] = total
        return total


def ratio_value(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    return 2.0 * sum(k for _, _, k in matching_runs(a, b)) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    out = []
    for x, y in zip(a, b, strict=True):
        if x is None or y is None:
            out.append(None)
        else:
            v = known.get((x, y))
            if v is None:
                v = known[(x, y)] = ratio_value(x, y)
            out.append(v)
    return pd.Series(out, dtype="float64")


def sequence_ratio(a: Column, b: Column) -> Column:
    """Matched share of two texts; equal and empty ones without Python (M1)."""
    open_ = (a != b) & (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(a == b, F.lit(1.0)).when(open_, _ratio(F.when(open_, a), F.when(open_, b))).when(a.isNotNull() & b.isNotNull(), F.lit(0.0))


def segment_similarity(a: Column, b: Column) -> Column:
    """Sequence ratio of the match texts (M2)."""
    return sequence_ratio(tx.match_norm(a), tx.match_norm(b))


def char_counts(c: Column) -> Column:
    """Map of character to count."""
    chars = F.array_sort(F.split(c, ""))
    return F.map_from_entries(F.transform(F.array_distinct(chars), lambda x: F.struct(x.alias("c"), F.size(F.filter(chars, lambda y: y == x)).alias("n"))))


def overlap_bound(a: Column, b: Column) -> Column:
    """Upper bound of the sequence ratio: twice the common characters over both lengths (M3).

    The characters of a that b cannot match are what remains after removing b's from it.
    """
    chars_a, chars_b = F.split(a, ""), F.split(b, "")
    common = F.aggregate(
        F.array_distinct(chars_a),
        F.lit(0),
        lambda n, x: n + F.least(F.size(F.filter(chars_a, lambda y: y == x)), F.size(F.filter(chars_b, lambda y: y == x))),
    )
    both = F.length(a) + F.length(b)
    return F.when(both == 0, 1.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(F.least(F.lit(1.0), 2.0 * common / both))


def agreement(norms: list[Column]) -> Column:
    """Mean pairwise ratio of the filled texts: 0 for none, 1 for one (M4). norms are match texts."""
    filled = [F.length(n) > 0 for n in norms]
    n = sum((f.cast("int") for f in filled), F.lit(0))
    total, pairs = F.lit(0.0), F.lit(0)
    for i, j in combinations(range(len(norms)), 2):
        both = filled[i] & filled[j]
        total = total + F.when(both, sequence_ratio(norms[i], norms[j])).otherwise(0.0)
        pairs = pairs + both.cast("int")
    return F.when(n == 0, 0.0).when(n == 1, 1.0).otherwise(total / pairs)


def anchor_mismatch(candidate: Column, anchor: Column) -> Column:
    """The anchor's first or last characters stand off the candidate's edge (M9)."""

    def sized(x: Column) -> Column:
        k = F.least(F.lit(10), F.greatest(F.lit(5), F.floor(F.length(x["a"]) / 8))).cast("int")
        return F.struct(x["c"].alias("c"), x["a"].alias("a"), k.alias("k"), F.greatest(F.lit(24), k * 4).alias("reach"))

    def test(x: Column) -> Column:
        front = F.position(F.substring(x["a"], F.lit(1), x["k"]), F.substring(x["c"], F.lit(1), x["reach"]))
        tail = F.substring(x["c"], F.greatest(F.length(x["c"]) - x["reach"] + 1, F.lit(1)), x["reach"])
        # the last occurrence of the suffix is the first one of both reversed
        back = F.position(F.reverse(F.substring(x["a"], F.length(x["a"]) - x["k"] + 1, x["k"])), F.reverse(tail))
        return (F.length(x["c"]) >= 12) & (F.length(x["a"]) >= 12) & ((front > 4) | (back > 4))

    start = F.struct(tx.anchor_norm(candidate).alias("c"), tx.anchor_norm(anchor).alias("a"))
    return tx.let(tx.let(start, sized), test)


def contained_in_any(fragment: Column, candidates: Column) -> Column:
    """Some candidate holds the fragment, as it is or without punctuation."""
    plain = tx.no_punct(fragment)
    return F.exists(candidates, lambda c: c.contains(fragment) | ((F.length(plain) > 0) & tx.no_punct(c).contains(plain)))


def majority_prefix(texts: Column) -> Column:
    """Fold of texts from the left to a shared prefix: the longer of two that extend each other,
    their common start where they differ, the later text where they share nothing (M8)."""

    def merge(a: Column, b: Column) -> Column:
        n = F.least(F.length(a), F.length(b))
        same = F.size(F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i <= n) & (F.substring(a, F.lit(1), i) == F.substring(b, F.lit(1), i))))
        return F.when(b.startswith(a), b).when(a.startswith(b), a).when(same == 0, b).otherwise(F.substring(a, F.lit(1), same))

    rest = F.slice(texts, F.lit(2), F.greatest(F.size(texts) - 1, F.lit(0)))
    return F.when(F.size(texts) > 0, F.aggregate(rest, F.get(texts, F.lit(0)), merge)).otherwise("")


def matches_result(segment: Column, result: Column) -> Column:
    """Match texts are equal, or share their first 12 characters, or their first 48 at a ratio of 0.7 (M7)."""
    filled = (F.length(segment) > 0) & (F.length(result) > 0)
    head = F.substring(segment, 1, 12) == F.substring(result, 1, 12)
    return filled & (head | (sequence_ratio(F.substring(segment, 1, 48), F.substring(result, 1, 48)) >= 0.7))


def score_candidates(texts: dict[str, tuple[Column, Column]], least: float = 0.7) -> Column:
    """Agreement of the usable texts, and a flag where two or more of them disagree (M5). texts: match text and usability by source."""
    used = [F.when(usable, norm).otherwise("") for norm, usable in texts.values()]
    count = sum((usable.cast("int") for _, usable in texts.values()), F.lit(0))
    score = agreement(used)
    flags = F.array_compact(F.array(F.when((count >= 2) & (score < least), F.lit("all_models_disagree"))))
    return F.struct(score.alias("agreement"), flags.alias("flags"))
