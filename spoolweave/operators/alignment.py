"""Alignment of engine texts with the anchor text (A1-A3).

Matching blocks are those of the standard library's matcher, so an (episode, engine) pair is
one Arrow row; projections between anchors are vectorised interpolations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolweave.functions import text as tx
from spoolweave.functions.similarity import matching_runs

ALIGNMENT = (
    "episode_id string, engine string, anchor_length int, engine_length int, global_alignment_score double, coverage_ratio double, "
    "anchors array<struct<anchor_start:int,anchor_end:int,engine_start:int,engine_end:int,score:double>>, "
    "anchor_to_engine array<double>, engine_to_anchor array<double>"
)

#: Characters of texts whose alignments leave Python at once; each has a place in the other text.
BATCH_CHARS = 1_000_000


def equal_runs(source: str, target: str) -> list[tuple[int, int, int]]:
    """(source start, target start, length) of the equal runs."""
    runs: list[tuple[int, int, int]] = []
    for a, b, n in matching_runs(source, target):
        if runs and runs[-1][0] + runs[-1][2] == a and runs[-1][1] + runs[-1][2] == b:
            runs[-1] = (runs[-1][0], runs[-1][1], runs[-1][2] + n)
        else:
            runs.append((a, b, n))
    return runs


def project(points: list[tuple[int, int]], source_length: int, target_length: int) -> np.ndarray:
    """Place in the target of every place in the source: linear between anchors, end slopes outside (A2)."""
    places = np.arange(max(source_length, 0), dtype=float)
    ratio = (target_length - 1) / max(source_length - 1, 1)
    best: dict[int, int] = {}
    for s, t in points:
        best[s] = max(t, best.get(s, t))
    if not best:
        return places * ratio
    src = np.array(sorted(best), dtype=float)
    dst = np.array([best[int(s)] for s in src], dtype=float)
    if len(src) == 1:
        return dst[0] + (places - src[0]) * ratio
    left = np.clip(np.searchsorted(src, places, side="right") - 1, 0, len(src) - 2)
    share = (places - src[left]) / (src[left + 1] - src[left])
    return dst[left] + share * (dst[left + 1] - dst[left])


def align_texts(engine: str, anchor: str) -> dict:
    """Anchors, both projections, score and coverage of two match texts (A1)."""
    runs = equal_runs(engine, anchor)
    ends = [p for a, b, n in runs for p in ((a, b), (a + n - 1, b + n - 1))]
    matched = sum(n for _, _, n in runs)
    return {
        "anchor_length": len(anchor),
        "engine_length": len(engine),
        "global_alignment_score": matched / max(len(engine), len(anchor), 1),
        "coverage_ratio": matched / max(len(engine), 1),
        "anchors": [{"anchor_start": b, "anchor_end": b + n, "engine_start": a, "engine_end": a + n, "score": 1.0} for a, b, n in runs],
        "anchor_to_engine": project([(b, a) for a, b in ends], len(anchor), len(engine)),
        "engine_to_anchor": project(ends, len(engine), len(anchor)),
    }


def align_engines(texts: DataFrame, anchor: str = "apple") -> DataFrame:
    """Alignments of every engine text with the anchor text of its episode (A3).

    texts: episode_id, source, raw_text; one row a source. The anchor side joins on the
    episode, so each pair is an independent row and pairs spread over all tasks.
    """
    norm = texts.select("episode_id", "source", tx.match_norm(tx.text_or_empty(F.col("raw_text"))).alias("norm"))
    base = norm.where(F.col("source") == anchor).select("episode_id", F.col("norm").alias("anchor_norm"))
    pairs = norm.where(F.col("source") != anchor).join(base, "episode_id").select("episode_id", F.col("source").alias("engine"), "norm", "anchor_norm")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, chars = [], 0
            for e, s, n, a in pdf.itertuples(index=False):
                rows.append({"episode_id": e, "engine": s, **align_texts(n, a)})
                chars += len(n) + len(a)
                if chars > BATCH_CHARS:
                    yield pd.DataFrame(rows)
                    rows, chars = [], 0
            if rows:
                yield pd.DataFrame(rows)

    # a few long pairs a task rather than a batch of thousands
    return pairs.repartition("episode_id", "engine").mapInPandas(run, ALIGNMENT)
