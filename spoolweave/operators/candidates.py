"""Building candidates in one or two phases.

``full`` searches every engine for every block. ``staged`` searches the primary engine first
and the others only for blocks where the primary is not trusted, so the costly search runs on
the rows that need it; ``qwen-only`` leaves the others out. Blocks that are skipped get
placeholder rows with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolweave.functions import similarity as sm
from spoolweave.functions import tables as tb
from spoolweave.functions import text as tx
from spoolweave.operators import risk, spans
from spoolweave.session import cut

MODES = ("full", "staged", "qwen-only")


def trusted_blocks(blocks: DataFrame, primary: DataFrame) -> DataFrame:
    """episode_id, block_id and the tests that speak against the primary candidate (none: trusted)."""
    own = blocks.select("episode_id", "block_id", tx.text_or_empty(F.col("text")).alias("a"), F.coalesce("stability_score", F.lit(0.0)).alias("stable"))
    df = own.join(primary.withColumn("q", tx.text_or_empty(F.col("text"))).drop("text"), ["episode_id", "block_id"])
    df = df.withColumn("an", tx.match_norm(F.col("a"))).withColumn("qn", tx.match_norm(F.col("q")))
    df = df.withColumn("agree", sm.agreement([F.col("an"), F.col("qn")])).withColumn("d", risk.difference_type(F.col("a"), F.col("q"), F.col("an"), F.col("qn")))
    grade = risk.quality_grade(F.least("local_alignment_score", "stable"), F.col("agree"), F.lit(False), F.lit(False))
    against = risk.confidence_rejections(
        F.col("local_alignment_score"), F.col("d.ratio"), F.col("d.type"), risk.numbers_differ(F.col("a"), F.col("q")), F.col("d.weighty"),
        tx.has_error_phrase(F.col("q")), grade, F.col("boundary_contamination"), F.col("usable_for_agreement"),
    )
    return df.select("episode_id", "block_id", against.alias("rejections"))


def build(blocks: DataFrame, texts: DataFrame, alignments: DataFrame, mode: str = "full", swapped: bool = True) -> DataFrame:
    """Candidates of all engines in the given mode, with alignment_score beside the local one."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    if mode == "full":
        found = spans.block_candidates(blocks, texts, alignments, swapped=swapped)
        return cut(found.withColumn("alignment_score", F.col("local_alignment_score")))
    first = texts.where(F.col("source").isin(tb.ANCHOR, tb.PRIMARY))
    primary = cut(spans.block_candidates(blocks, first, alignments, swapped=swapped))
    if mode == "staged":
        doubt = cut(trusted_blocks(blocks, primary))
        open_ = blocks.join(doubt.where(F.size("rejections") > 0).select("episode_id", "block_id"), ["episode_id", "block_id"], "left_semi")
        rest = texts.where(F.col("source") != tb.PRIMARY)
        more = spans.block_candidates(open_, rest, alignments, swapped=swapped)
        skipped = doubt.where(F.size("rejections") == 0).select("episode_id", "block_id", F.lit("qwen_high_confidence").alias("why"))
    else:
        more = None
        skipped = blocks.select("episode_id", "block_id", F.lit("qwen_only_mode").alias("why"))
    out = primary if more is None else primary.unionByName(more)
    out = out.unionByName(placeholders(skipped, primary))
    return cut(out.withColumn("alignment_score", F.col("local_alignment_score")))


def placeholders(skipped: DataFrame, like: DataFrame) -> DataFrame:
    """A row for each support engine of a skipped block."""
    rows = skipped.withColumn("source", F.explode(F.array(*map(F.lit, tb.SUPPORT))))
    fixed = {
        "episode_id": F.col("episode_id"),
        "block_id": F.col("block_id"),
        "source": F.col("source"),
        "text": F.lit(""),
        "local_alignment_score": F.lit(0.0),
        "usable_for_agreement": F.lit(False),
        "boundary_contamination": F.lit(False),
        "unusable_reason": F.array("why"),
        "skipped": F.lit(True),
        "skip_reason": F.col("why"),
        "span_drift_start": F.lit(0),
        "span_drift_end": F.lit(0),
    }
    return rows.select(*[fixed.get(n, F.lit(None)).cast(t).alias(n) for n, t in like.dtypes])
