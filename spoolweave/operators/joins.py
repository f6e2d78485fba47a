"""Joins that the engine's equi-joins don't cover directly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolweave.operators.ordered import BLOCK, with_edges


def interval_overlap(left: DataFrame, right: DataFrame, keys: list[str], width: float, slack: float = 0.0) -> DataFrame:
    """Rows whose [start_sec, end_sec] overlap within a group.

    Both sides are spread over buckets and joined on the bucket, so the join is an equi-join
    however long a group is. Buckets of ``width`` seconds double from level to level, and an
    interval lies at the level at which it covers few of them, so one with a wild end makes no
    more rows than others; a pair meets at the higher level of its two, in the first bucket
    both share. left: keys, l_id, l_start, l_end; right: keys, r_id, r_start, r_end.
    """
    lo, hi = F.col("l_start") - slack, F.col("l_end") + slack
    level = lambda a, b: F.greatest(F.lit(0), F.ceil(F.log2((b - a) / (4 * width)))).cast("int")
    a = left.where(hi >= lo).withColumn("__own_l", F.coalesce(level(lo, hi), F.lit(0)))
    b = right.where("r_end >= r_start").withColumn("__own_r", F.coalesce(level(F.col("r_start"), F.col("r_end")), F.lit(0)))
    # the levels in use: a handful of numbers, one for each doubling of an interval's length
    used = sorted({r[0] for side in (a.select("__own_l"), b.select("__own_r")) for r in side.distinct().collect()})

    def spread(side: DataFrame, own: str, begin: Column, end: Column) -> DataFrame:
        side = side.withColumn("__level", F.explode(F.filter(F.array(*map(F.lit, used)) if used else F.array().cast("array<int>"), lambda v: v >= F.col(own))))
        step = width * F.pow(F.lit(2.0), F.col("__level"))
        return side.withColumn("__b", F.explode(F.sequence(F.floor(begin / step), F.floor(end / step))))

    hit = spread(a, "__own_l", lo, hi).join(spread(b, "__own_r", F.col("r_start"), F.col("r_end")), [*keys, "__level", "__b"])
    hit = hit.where((F.col("__level") == F.greatest("__own_l", "__own_r")) & (F.col("r_end") >= lo) & (F.col("r_start") <= hi))
    step = width * F.pow(F.lit(2.0), F.col("__level"))
    first = F.greatest(F.floor(lo / step), F.floor(F.col("r_start") / step))
    return hit.where(F.col("__b") == first).drop("__b", "__level", "__own_l", "__own_r")


def known_around(df: DataFrame, keys: list[str], order: list[str], known: Column, value: Column, before: str | None = None, after: str | None = None) -> DataFrame:
    """The value of the nearest known row at or before each row, and of the nearest at or after it.

    For a frame with blocks (ordered.with_blocks): running values inside each block, and one
    scan over one row a block for what comes from other blocks.
    """
    local = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    df = df.withColumn("__k", F.when(known, F.struct(value.alias("v"))))
    place = F.when(F.col("__k").isNotNull(), F.struct(*order))
    summary, scans, out = {}, {}, {}
    if before:
        df = df.withColumn("__nb", F.last("__k", ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        summary["__last"] = F.max_by("__k", place)
        scans["__fb"] = lambda w: F.last("__last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        out[before] = F.coalesce("__nb", "__fb")["v"]
    if after:
        df = df.withColumn("__na", F.first("__k", ignorenulls=True).over(local.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        summary["__first"] = F.min_by("__k", place)
        scans["__fa"] = lambda w: F.first("__first", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
        out[after] = F.coalesce("__na", "__fa")["v"]
    return with_edges(df, keys, summary, scans).withColumns(out).drop("__k", "__nb", "__na", "__fb", "__fa")


def as_of(df: DataFrame, keys: list[str], order: list[str], known: Column, value: Column, name: str, ahead: bool = False) -> DataFrame:
    """The value of the nearest known row at or before each row (after, with ``ahead``)."""
    return known_around(df, keys, order, known, value, **{"after" if ahead else "before": name})


def interpolated(df: DataFrame, keys: list[str], order: str, tie: str, value: str, name: str) -> DataFrame:
    """Fill gaps of a value linearly between the known rows around them; beyond them the nearest holds."""
    spot = F.struct(F.col(order).cast("double").alias("at"), F.col(value).cast("double").alias("v"))
    df = known_around(df, keys, [order, tie], F.col(value).isNotNull(), spot, "__b", "__a")
    at, gap = F.col(order).cast("double"), F.col("__a.at") - F.col("__b.at")
    between = F.col("__b.v") + (F.col("__a.v") - F.col("__b.v")) * ((at - F.col("__b.at")) / gap)
    out = F.when(F.col("__b").isNull(), F.col("__a.v")).when(F.col("__a").isNull() | (gap == 0), F.col("__b.v")).otherwise(between)
    return df.withColumn(name, out).drop("__b", "__a")


def dictionary_hits(df: DataFrame, column: str, keys: list[str], words: dict[str, tuple[str, ...]]) -> DataFrame:
    """keys and term of each term one of whose spellings occurs in the text.

    The dictionary is an expression, so nothing is joined or broadcast.
    """
    found = F.array_compact(F.array(*[F.when(_any(F.col(column), spellings), F.lit(term)) for term, spellings in words.items()]))
    return df.select(*keys, F.explode(found).alias("term"))


def _any(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def rewrites(texts: Column) -> Column:
    """Updates (a text that differs from the one before) and rewrites (one that doesn't extend it) of a list of texts."""
    n = F.size(texts)
    pairs = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    changed = F.filter(pairs, lambda i: F.get(texts, i) != F.get(texts, i - 1))
    return F.struct(F.size(changed).alias("updates"), F.size(F.filter(changed, lambda i: ~F.get(texts, i).startswith(F.get(texts, i - 1)))).alias("rewrites"))


def stability_score(updates: Column, rewrites_: Column) -> Column:
    """0.82 less the weight of updates and rewrites, within 0.05 and 0.99."""
    return F.greatest(F.lit(0.05), F.least(F.lit(0.99), 0.82 - F.least(F.lit(0.38), 0.015 * F.log1p(updates.cast("double")) + 0.03 * rewrites_)))


def with_selected_source(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows with the source selected for their block, 'unknown' where none was."""
    chosen = selected.select("episode_id", "block_id", "selected_source").dropDuplicates(["episode_id", "block_id"])
    return rows.join(chosen, ["episode_id", "block_id"], "left").fillna("unknown", ["selected_source"])
