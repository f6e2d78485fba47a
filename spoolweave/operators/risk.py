"""Differences, grades and risk flags of block candidates.

Everything is a column expression over precomputed similarities. Null scores count as 0,
null texts as empty, an unknown difference type as semantic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolweave.functions import similarity as sm
from spoolweave.functions import tables as tb
from spoolweave.functions import text as tx
from spoolweave.operators.spans import large_drift

SAFE = ("none", "surface", "soft_domain")
HARD = ("critical", "semantic")


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def no(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def difference_type(anchor: Column, other: Column, anchor_norm: Column, other_norm: Column) -> Column:
    """Struct of difference type, surface ratio, and whether a term of weight differs."""
    x, y = tx.surface_norm(anchor_norm), tx.surface_norm(other_norm)
    ratio = sm.sequence_ratio(x, y)
    critical = tx.raw_terms(anchor, tb.CRITICAL_TERMS, tb.TERM_ALIASES) != tx.raw_terms(other, tb.CRITICAL_TERMS, tb.TERM_ALIASES)
    soft = tx.raw_terms(anchor, tb.SOFT_TERMS) != tx.raw_terms(other, tb.SOFT_TERMS)
    kind = F.when(x == y, "none").when(critical, "critical").when(soft & (ratio >= 0.88), "soft_domain").when(ratio >= 0.86, "surface").otherwise("semantic")
    return F.struct(kind.alias("type"), ratio.alias("ratio"), kind.isin(*HARD).alias("weighty"))


def numbers_differ(a: Column, b: Column) -> Column:
    """Digit runs differ and one side has some (R2)."""
    x, y = tx.digit_runs(a), tx.digit_runs(b)
    return ((F.size(x) > 0) | (F.size(y) > 0)) & (x != y)


def quality_grade(align: Column, agree: Column, review: Column, missing: Column) -> Column:
    """Grade A to E."""
    return (
        F.when(missing, "E")
        .when((align >= 0.88) & (agree >= 0.88) & ~review, "A")
        .when((align >= 0.75) & (agree >= 0.75) & ~review, "B")
        .when((align >= 0.4) & (agree >= 0.45), "C")
        .when(align >= 0.25, "D")
        .otherwise("E")
    )


def confidence_rejections(local: Column, ratio: Column, kind: Column, numeric: Column, weighty: Column, error: Column, grade: Column, touching: Column, usable: Column) -> Column:
    """Tests that keep the primary engine from high confidence; none for high confidence."""
    tests = (
        ("qwen_alignment_lt_0_90", local < 0.90),
        ("qwen_apple_similarity_lt_0_88", ratio < 0.88),
        ("qwen_difference_not_safe", ~kind.isin(*SAFE)),
        ("qwen_numeric_disagreement", numeric),
        ("qwen_critical_term_disagreement", weighty),
        ("qwen_domain_error", error),
        ("preliminary_quality_not_a_or_b", ~grade.isin("A", "B")),
        ("qwen_boundary_contamination", F.coalesce(touching, F.lit(True))),
        ("qwen_not_usable_for_agreement", ~no(usable)),
    )
    return F.array_compact(F.array(*[F.when(no(t), F.lit(n)) for n, t in tests]))


def support_skip(mode: str, rejections: Column, score: Column) -> Column:
    """Reason to skip a support engine, or null."""
    base = F.when(score < tb.MIN_ENGINE_SCORE, "global_alignment_low")
    if mode == "qwen-only":
        return F.lit("qwen_only_mode")
    return F.when(F.size(rejections) == 0, "qwen_high_confidence").otherwise(base) if mode == "staged" else base


def wide_blocks(blocks: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row a block with a struct a source (and the anchor's own text)."""
    keep = [c for c in candidates.columns if c not in ("episode_id", "block_id", "source", "ingested_at")]
    rows = candidates.dropDuplicates(["episode_id", "block_id", "source"])
    wide = rows.groupBy("episode_id", "block_id").agg(*[F.first(F.when(F.col("source") == s, F.struct(*keep)), ignorenulls=True).alias(s) for s in tb.SOURCES])
    own = blocks.dropDuplicates(["episode_id", "block_id"]).select("episode_id", "block_id", F.col("text").alias("anchor_text"), "start_sec", "end_sec", "stability_score", "sentence_ids")
    return own.join(wide, ["episode_id", "block_id"])


def compare(wide: DataFrame) -> DataFrame:
    """Match texts, pairwise agreement, difference type and grade of wide blocks."""
    df = wide
    for s in tb.SOURCES:
        df = df.withColumn(f"{s}_text", tx.text_or_empty(F.col("anchor_text") if s == tb.ANCHOR else F.col(f"{s}.text")))
        df = df.withColumn(f"{s}_norm", tx.match_norm(F.col(f"{s}_text")))
    usable = {s: no(F.col(f"{s}.usable_for_agreement")) for s in tb.SOURCES if s != tb.ANCHOR}
    norms = [F.col(f"{tb.ANCHOR}_norm"), *[F.when(u, F.col(f"{s}_norm")).otherwise("") for s, u in usable.items()]]
    df = df.withColumn("candidate_agreement_score", sm.agreement(norms))
    p = tb.PRIMARY
    df = df.withColumn("difference", difference_type(F.col("apple_text"), F.col(f"{p}_text"), F.col("apple_norm"), F.col(f"{p}_norm")))
    scores = {s: zero(F.coalesce(F.col(f"{s}.local_alignment_score"), F.col(f"{s}.alignment_score"))) for s in usable}
    some = reduce(lambda a, b: a | b, usable.values())
    least = F.when(some, F.least(*[F.when(usable[s], scores[s]) for s in usable])).otherwise(F.least(*scores.values()))
    return df.withColumn("alignment_quality", quality_grade(least, F.col("candidate_agreement_score"), F.lit(False), ~some))


def risk_flags(df: DataFrame) -> Column:
    """Sorted distinct risk flags of compared blocks."""
    engines = [s for s in tb.SOURCES if s != tb.ANCHOR]
    kind, agree = F.col("difference.type"), F.col("candidate_agreement_score")
    usable = {s: no(F.col(f"{s}.usable_for_agreement")) for s in engines}
    n = reduce(lambda a, b: a + b, [u.cast("int") for u in usable.values()])
    numbers = F.array_distinct(F.filter(F.array(*[tx.numbers(F.col(f"{s}_text")) for s in tb.SOURCES]), lambda x: F.size(x) > 0))
    terms = {s: tx.terms_in(F.col(f"{s}_norm")) for s in tb.SOURCES}
    some = [F.when(usable[s], terms[s]).otherwise(F.array().cast("array<string>")) for s in engines]
    sets = F.array_distinct(F.filter(F.array(*some), lambda x: F.size(x) > 0))
    any_term = (F.size(terms[tb.ANCHOR]) > 0) | (F.size(sets) > 0)
    drift = reduce(lambda a, b: a | b, [usable[s] & no(large_drift(F.col(f"{s}.span_drift_start"), F.col(f"{s}.span_drift_end"))) for s in engines])
    duration = zero(F.col("end_sec")) - zero(F.col("start_sec"))
    edge = tx.suspect_edge(F.col(f"{tb.PRIMARY}_text"), tb.SUSPECT_PREFIXES_BUILD, ()) | tx.suspect_edge(F.col("apple_text"), tb.SUSPECT_PREFIXES_BUILD, ())
    error = reduce(lambda a, b: a | b, [tx.has_error_phrase(F.col(f"{s}_text")) for s in tb.SOURCES])
    tests = [("apple_unstable", zero(F.col("stability_score")) < 0.45)]
    tests += [(f"{s}_alignment_low", ~no(F.col(f"{s}.skipped")) & (zero(F.coalesce(F.col(f"{s}.alignment_score"), F.col(f"{s}.local_alignment_score"))) < 0.55)) for s in engines]
    tests += [
        ("qwen_apple_disagreement", kind.isin(*HARD)),
        ("critical_term_disagreement", F.col("difference.weighty")),
        # also flagged for critical and semantic rows; flag normalisation drops it there
        ("soft_domain_difference", kind.isin(*HARD, "soft_domain")),
        ("all_models_disagree", (n >= 2) & (agree < 0.5)),
        ("numeric_disagreement", F.size(numbers) > 1),
        ("proper_noun_disagreement", any_term & (F.size(sets) > 1) & (agree < 0.55)),
        ("large_span_drift", drift),
        ("span_too_short", duration < 0.3),
        ("span_too_long", duration > 25.0),
        ("boundary_contamination_suspected", edge),
        ("domain_error_phrase", error),
    ]
    flags = F.array_sort(F.array_compact(F.array(*[F.when(no(t), F.lit(name)) for name, t in tests])))
    # flags about engines that were never asked say nothing
    known = all("skip_reason" in df.schema[s].dataType.names for s in tb.SUPPORT)
    asked = ~reduce(lambda a, b: a & b, [no(F.col(f"{s}.skip_reason").isin("qwen_high_confidence", "qwen_only_mode")) for s in tb.SUPPORT]) if known else F.lit(True)
    dropped = F.array(*[F.lit(f"{s}_alignment_low") for s in tb.SUPPORT], F.lit("all_models_disagree"))
    return F.when(asked, flags).otherwise(F.array_except(flags, dropped))


def flagged_blocks(blocks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Wide blocks with agreement, difference, grade, flags and the automatic verdict."""
    df = compare(wide_blocks(blocks, candidates))
    df = df.withColumn("risk_flags", risk_flags(df))
    has = lambda f: F.array_contains("risk_flags", f)
    kind, ratio, grade = F.col("difference.type"), F.col("difference.ratio"), F.col("alignment_quality")
    local = zero(F.coalesce(F.col(f"{tb.PRIMARY}.local_alignment_score"), F.col(f"{tb.PRIMARY}.alignment_score")))
    drift = reduce(lambda a, b: a | b, [no(large_drift(F.col(f"{s}.span_drift_start"), F.col(f"{s}.span_drift_end"))) for s in tb.SOURCES if s != tb.ANCHOR])
    accept = (
        grade.isin("A", "B")
        & (local >= 0.82)
        & (F.col("candidate_agreement_score") >= 0.70)
        & ~has("numeric_disagreement")
        & kind.isin(*SAFE)
        & ((kind != "soft_domain") | (ratio >= 0.88))
        & ~has("span_too_long")
        & ~has("all_models_disagree")
        & (~drift | (local >= 0.90))
    )
    severe = F.arrays_overlap(
        "risk_flags",
        F.array(
            *map(
                F.lit,
                ("all_models_disagree", "numeric_disagreement", "span_too_short", "span_too_long", "qwen_alignment_low", "apple_unstable", "critical_term_disagreement", "boundary_contamination_suspected", "domain_error_phrase"),
            )
        ),
    )
    review = ~accept & ((grade == "E") | (grade.isin("C", "D") & severe) | kind.isin(*HARD) | (drift & (local < 0.90)))
    return df.withColumn("qwen_apple_difference_type", kind).withColumn("qwen_apple_similarity", ratio).withColumn("needs_review", review).withColumn("auto_accepted", ~review)


def normalized_flags(kind: Column, ratio: Column, local: Column, flags: Column) -> Column:
    """Struct of difference type, flags from the fixed list, and the review verdict."""
    kind = F.when(kind.isin(*SAFE, *HARD), kind).otherwise("semantic")
    flags = F.coalesce(flags, F.array().cast("array<string>"))
    has = lambda f: F.array_contains(flags, f)
    numeric, long, drift = has("numeric_disagreement"), has("span_too_long"), has("large_span_drift")
    edge, error = has("boundary_contamination_suspected"), has("domain_error_phrase")
    local, ratio = zero(local), zero(ratio)
    blocked = kind.isin(*HARD) | (local < 0.82) | numeric | long | edge | error | (drift & (local < 0.90))
    cleared = (kind == "soft_domain") & (ratio >= 0.88) & (local >= 0.82) & ~numeric & ~long
    review = blocked & ~cleared
    tests = (
        ("boundary_contamination_suspected", edge),
        ("critical_term_disagreement", kind == "critical"),
        ("domain_error_phrase", error),
        ("large_span_drift", drift),
        ("numeric_disagreement", numeric),
        ("qwen_apple_disagreement", kind.isin(*HARD)),
        ("soft_domain_difference", kind == "soft_domain"),
        ("span_too_long", long),
        ("surface_difference", kind == "surface"),
    )
    out = F.array_sort(F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests])))
    return F.struct(
        kind.alias("difference_type"),
        out.alias("risk_flags"),
        review.alias("needs_review"),
        F.when(review, out).otherwise(F.array().cast("array<string>")).alias("needs_review_reason"),
        (~review).alias("auto_accepted"),
    )


def normalized_blocks(flagged: DataFrame) -> DataFrame:
    """Flagged blocks with type, flags and verdict as normalised: what the final selection takes."""
    local = F.coalesce(F.col(f"{tb.PRIMARY}.local_alignment_score"), F.col(f"{tb.PRIMARY}.alignment_score"))
    df = flagged.withColumn("__n", normalized_flags(F.col("qwen_apple_difference_type"), F.col("qwen_apple_similarity"), local, F.col("risk_flags")))
    names = {"qwen_apple_difference_type": "difference_type"} | {c: c for c in ("risk_flags", "needs_review", "needs_review_reason", "auto_accepted")}
    return df.withColumns({c: F.col(f"__n.{n}") for c, n in names.items()}).drop("__n")
