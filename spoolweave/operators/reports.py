"""Counts and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoolweave.functions import tables as tb
from spoolweave.functions import text as tx


def value_counts(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """Count of each value (H1)."""
    return df.groupBy(*(keys or []), F.col(column).alias("name")).agg(F.count("*").alias("count"))


def list_counts(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """Count of each member of a list column (H2)."""
    return value_counts(df.select(*(keys or []), F.explode(column).alias(column)), column, keys)


def most_common(df: DataFrame, column: str, order: list[str], limit: int | None = None) -> DataFrame:
    """Counts from the most common down, ties in first-seen order (H3)."""
    out = df.groupBy(F.col(column).alias("name")).agg(F.count("*").alias("count"), F.min(F.struct(*order)).alias("seen")).orderBy(F.desc("count"), "seen").drop("seen")
    return out.limit(limit) if limit else out


def top_counts(df: DataFrame, column: str, limit: int = 10) -> DataFrame:
    """The commonest values, ties by name (H4)."""
    return value_counts(df, column).orderBy(F.desc("count"), "name").limit(limit)


def conditional_counts(df: DataFrame, tests: dict[str, Column], keys: list[str]) -> DataFrame:
    """Many conditional counts in one pass (H5)."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in tests.items()])


def engine_stats(candidates: DataFrame) -> DataFrame:
    """Sums, maxima and means by engine (H6, H7)."""
    return candidates.groupBy("source").agg(
        F.count("*").alias("rows"),
        F.count_if("usable_for_agreement").alias("usable"),
        F.bround(F.avg("local_alignment_score"), 4).alias("mean_local"),
        F.max("local_alignment_score").alias("max_local"),
        F.max("search_radius").alias("max_radius"),
    )


def crosstab(df: DataFrame, first: str, second: str) -> DataFrame:
    """Counts by two columns, the second a list (H8)."""
    return df.select(F.col(first), F.explode(second).alias(second)).groupBy(first, second).agg(F.count("*").alias("count"))


def first_reason(reasons: Column, priority: list[str]) -> Column:
    """The first of a priority list among a row's reasons (H9)."""
    return F.try_element_at(F.filter(F.array(*map(F.lit, priority)), lambda p: F.array_contains(reasons, p)), F.lit(1))


def ordered_list(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Values of a group as a list in order."""
    return df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"]).alias("values"))


def dominant(entries: Column, leave_out: tuple[str, ...] = ()) -> Column:
    """Key of the largest value of a map, some keys aside."""
    rows = F.filter(F.map_entries(entries), lambda e: ~e["key"].isin(*leave_out)) if leave_out else F.map_entries(entries)
    return F.array_max(F.transform(rows, lambda e: F.struct(e["value"].alias("v"), e["key"].alias("k"))))["k"]


def split_totals(df: DataFrame, chosen: Column, value: str, keys: list[str]) -> DataFrame:
    """Totals of a value over chosen and other rows."""
    return df.groupBy(*keys).agg(F.sum(F.when(chosen, F.col(value)).otherwise(0.0)).alias("chosen"), F.sum(F.when(~chosen, F.col(value)).otherwise(0.0)).alias("other"))


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group (K1, K2, K6); with no keys, of all rows.

    Spark keeps only n rows a task and group before the shuffle (window group limit).
    """
    if not keys:
        return df.orderBy(*order).limit(n)
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rn") <= n).drop("__rn")


def flag_summary(blocks: DataFrame) -> DataFrame:
    """Per episode: blocks, verdicts, and counts by difference type and flag (V7)."""
    base = blocks.groupBy("episode_id").agg(F.count("*").alias("block_count"), F.count_if("needs_review").alias("needs_review_count"), F.count_if(~F.col("needs_review")).alias("auto_accepted_count"))

    def as_map(counts: DataFrame, name: str) -> DataFrame:
        return counts.where("name is not null").groupBy("episode_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "count")))).alias(name))

    kinds = as_map(value_counts(blocks, "qwen_apple_difference_type", ["episode_id"]), "difference_type_counts")
    flags = as_map(list_counts(blocks, "risk_flags", ["episode_id"]), "risk_flag_counts")
    return base.join(kinds, "episode_id", "left").join(flags, "episode_id", "left")


def final_summary(finals: DataFrame) -> DataFrame:
    """Per episode: sources chosen, switches, corrections, cleanups, unusual patterns, error phrases left (V4, V8, V9)."""
    tests = {f"selected_{s}_count": F.col("selected_source") == s for s in tb.SOURCES} | {
        "source_changed_count": F.col("selected_source") != F.col("ranked_source"),
        "corrected_block_count": F.size("corrections") > 0,
        "cleanup_applied_count": F.size("cleanup_reasons") > 0,
        "cleanup_reverted_count": F.col("cleanup_reverted"),
        "unusual_pattern_count": F.size("unusual_patterns") > 0,
        "error_phrase_in_final_count": tx.has_error_phrase(F.col("final_text")),
        "display_differs_count": F.col("final_text_display") != F.col("final_text"),
        "large_span_drift_warning_count": F.array_contains("final_risk_flags", "large_span_drift_warning"),
    }
    totals = finals.groupBy("episode_id").agg(
        F.count("*").alias("block_count"),
        *[F.count_if(c).alias(n) for n, c in tests.items()],
        F.sum(F.size("corrections")).alias("correction_count"),
        F.sum("inserted_period_count").alias("inserted_period_count"),
        F.bround(F.avg("candidate_agreement_score"), 4).alias("mean_agreement"),
        F.max(F.length("final_text_display")).alias("longest_display"),
    )
    return totals


def phrase_totals(df: DataFrame, column: str, phrases: tuple[str, ...] = tb.ERROR_PHRASES) -> DataFrame:
    """Occurrences of each phrase over all texts."""
    counts = tx.phrase_counts(F.col(column), phrases)
    return df.select(F.explode(counts).alias("name", "n")).groupBy("name").agg(F.sum("n").alias("count"))
