"""Order-dependent operators without one task per group.

A group (an episode) may hold a large share of all rows, so no operator here sorts a whole
group in one task. Rows are cut into blocks of their order column; work inside a block is
local, and one summary row a block carries what the next block needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolweave.session import cut

BLOCK = "__block"


def with_blocks(df: DataFrame, order: str | Column, width: float) -> DataFrame:
    """Add the block number: the order column in steps of ``width``."""
    c = F.col(order) if isinstance(order, str) else order
    return df.withColumn(BLOCK, F.floor(c / width).cast("bigint"))


def with_edges(df: DataFrame, keys: list[str], summary: dict[str, Column], scans: dict[str, Callable[[Any], Column]]) -> DataFrame:
    """Rows with what the other blocks of their group say: one aggregate a block, all scans over it, one join.

    ``summary`` holds aggregates by name; each scan is a function of the window over the
    blocks of a group in order, and sees the aggregates as columns.
    """
    across = Window.partitionBy(*keys).orderBy(BLOCK)
    edges = df.groupBy(*keys, BLOCK).agg(*[c.alias(n) for n, c in summary.items()])
    edges = edges.select(*keys, BLOCK, *[f(across).alias(n) for n, f in scans.items()])
    return df.join(edges, [*keys, BLOCK])


def neighbours(df: DataFrame, keys: list[str], order: list[str], before: dict[str, Column] | None = None, after: dict[str, Column] | None = None, number: str | None = None) -> DataFrame:
    """Values of the row before and of the row after in the group, and the 1-based row number, across blocks, all in one go.

    Local windows inside a block; first row, last row and count of each block for the rest.
    """
    before, after = before or {}, after or {}
    local = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    place = F.struct(*order)
    df = df.withColumn("__back", F.struct(F.lit(True).alias("__"), *[c.alias(n) for n, c in before.items()])).withColumn("__on", F.struct(F.lit(True).alias("__"), *[c.alias(n) for n, c in after.items()]))
    summary = {"__last": F.max_by("__back", place), "__first": F.min_by("__on", place), "__n": F.count("*")}
    scans = {
        "__far_back": lambda w: F.lag("__last").over(w),
        "__far_on": lambda w: F.lead("__first").over(w),
        "__before": lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    }
    df = df.withColumn("__near_back", F.lag("__back").over(local)).withColumn("__near_on", F.lead("__on").over(local)).withColumn("__local", F.row_number().over(local))
    df = with_edges(df, keys, summary, scans)
    back, on = F.coalesce("__near_back", "__far_back"), F.coalesce("__near_on", "__far_on")
    out = {n: back[n] for n in before} | {n: on[n] for n in after}
    if number:
        out[number] = (F.col("__before") + F.col("__local")).cast("bigint")
    return df.withColumns(out).drop("__back", "__on", "__near_back", "__near_on", "__far_back", "__far_on", "__before", "__local")


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """1-based row number by group, for a frame with blocks."""
    return neighbours(df, keys, order, number=name)


def carry_last(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, ahead: bool = False) -> DataFrame:
    """The value of the row before (after, with ``ahead``) in the group, across blocks."""
    return neighbours(df, keys, order, **{"after" if ahead else "before": {name: value}})


#: Output columns (a frame, or lists by name) and state after some rows and the state before them.
Fold = Callable[[pd.DataFrame, Any], "tuple[pd.DataFrame | dict[str, list], Any]"]


def map_groups(df: DataFrame, by: list[str], order: list[str], fn: Callable[[pd.DataFrame], list[dict]], schema: str) -> DataFrame:
    """Rows that a function makes of each sorted group.

    Groups are told apart in a sorted stream rather than handed over one by one: with many
    small groups a call of its own for each would cost more than their rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0].strip("`") for f in _split(schema)]
        rest: pd.DataFrame | None = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if not len(pdf):
                continue
            # the codes of a null are equal to each other
            codes = np.stack([pd.factorize(pdf[c])[0] for c in by])
            starts = np.flatnonzero(np.concatenate(([True], (codes[:, 1:] != codes[:, :-1]).any(axis=0))))
            rows = [row for a, b in zip(starts, starts[1:], strict=False) for row in fn(pdf.iloc[a:b])]
            rest = pdf.iloc[starts[-1] :]
            if rows:
                yield pd.DataFrame(rows, columns=names)
        rows = fn(rest) if rest is not None else []
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInPandas(run, schema)


#: Share of a block before it that a fold runs through to guess the state at its start.
WARM_UP = 0.25
#: Rounds of corrections after which the result is written anew, so that its plan stays small.
ROUNDS_A_WRITE = 8


def forgetful_fold(df: DataFrame, keys: list[str], order: list[str], fold: Fold, out: str, state: str, width: float | None = None) -> DataFrame:
    """A left fold over each group in order, run block by block.

    ``fold(rows, state)`` takes a block's sorted rows and the state before them (None at the
    start) and returns its output rows and the state after. State that is soon forgotten, as
    that of the transcript folds, is guessed right by running through the rows just before a
    block (where ``width``, the blocks' width in the first order column, is given). Then each
    block whose incoming state proved different runs again, until no state differs: the
    result is that of the sequential fold in any case. All blocks run once, and are written
    once; only corrected ones run and are written again.

    ``out`` is the schema of the output rows, ``state`` the type of the state. The frame
    needs blocks (with_blocks).
    """
    types = dict(df.dtypes)
    key_schema = ", ".join(f"`{k}` {types[k]}" for k in keys)
    result_schema = f"{key_schema}, {BLOCK} bigint, __in {state}, __after {state}, __rows array<struct<{_fields(out)}>>"
    names = [f.split()[0].strip("`") for f in _split(out)]

    def run(pdf: pd.DataFrame) -> list[dict]:
        own = pdf["__own"].to_numpy(dtype=bool)
        if not own.any():
            return []
        before = pdf["__in"].iloc[-1]
        before = None if before is None or (not isinstance(before, (list, dict, tuple)) and pd.isna(before)) else before
        if not own.all():
            before = fold(pdf[~own], None)[1]
            pdf = pdf[own]
        rows, after = fold(pdf, before)
        listed = rows[names].to_dict("records") if isinstance(rows, pd.DataFrame) else [dict(zip(names, r, strict=True)) for r in zip(*(rows[n] for n in names), strict=True)]
        return [{**{k: pdf[k].iloc[0] for k in keys}, BLOCK: pdf[BLOCK].iloc[0], "__in": before, "__after": after, "__rows": listed}]

    rows = df.withColumn("__in", F.lit(None).cast(state))
    if width is None:
        warm = rows.withColumn("__for", F.col(BLOCK))
    else:
        late = F.col(order[0]) / width - F.col(BLOCK) >= 1 - WARM_UP
        warm = rows.withColumn("__for", F.explode(F.when(late, F.array(F.col(BLOCK), F.col(BLOCK) + 1)).otherwise(F.array(BLOCK))))
    warm = warm.withColumn("__own", F.col("__for") == F.col(BLOCK))
    parts = [cut(map_groups(warm, [*keys, "__for"], order, run, result_schema))]
    across = Window.partitionBy(*keys).orderBy(BLOCK)
    # each round settles at least the first stale block of a group, so as many rounds as blocks are enough
    while True:
        done = reduce(DataFrame.unionByName, parts)
        incoming = done.select(*keys, BLOCK, "__in", F.lag("__after").over(across).alias("__new"))
        stale = cut(incoming.where(~F.col("__in").eqNullSafe(F.col("__new"))).select(*keys, BLOCK, F.col("__new").alias("__in")))
        if stale.isEmpty():
            return done.select(*keys, F.inline("__rows"))
        again = map_groups(df.join(stale, [*keys, BLOCK]).withColumn("__own", F.lit(True)), [*keys, BLOCK], order, run, result_schema)
        parts = [p.join(stale.select(*keys, BLOCK), [*keys, BLOCK], "left_anti") for p in parts] + [cut(again)]
        if len(parts) > ROUNDS_A_WRITE:
            parts = [cut(reduce(DataFrame.unionByName, parts))]


def _split(schema: str) -> list[str]:
    parts, depth, last = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and not depth:
            parts.append(schema[last:i].strip())
            last = i + 1
    return [*parts, schema[last:].strip()]


def _fields(schema: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.split(None, 1) for f in _split(schema)))
