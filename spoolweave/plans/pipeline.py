"""The whole run over many episodes: sources, units, blocks, alignment, candidates, flags, final texts, reports.

Each stage is a table; a run can resume from any stage that was written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolweave.operators import alignment, arbitration, candidates, fusion, reports, risk, segmentation, validation
from spoolweave.session import cut
from spoolweave.sources import episodes, sinks


@dataclass
class Run:
    units: DataFrame
    blocks: DataFrame
    candidates: DataFrame
    flagged: DataFrame
    finals: DataFrame
    sentences: DataFrame
    summary: DataFrame


def anchor_candidates(blocks: DataFrame, like: DataFrame) -> DataFrame:
    """The anchor's own rows in the form of engine candidates: its text, its stability as score."""
    own = {
        "episode_id": F.col("episode_id"),
        "block_id": F.col("block_id"),
        "source": F.lit("apple"),
        "text": F.col("text"),
        "char_start": F.col("char_start"),
        "char_end": F.col("char_end"),
        "local_alignment_score": F.col("stability_score"),
        "alignment_score": F.col("stability_score"),
        "usable_for_agreement": F.lit(True),
        "boundary_contamination": F.lit(False),
        "skipped": F.lit(False),
    }
    return blocks.select(*[own.get(n, F.lit(None)).cast(t).alias(n) for n, t in like.dtypes])


def run_episodes(spark: SparkSession, folder: str, prefix: str | None = None, swapped: bool = True, punctuate: bool = True, mode: str = "full", model=None) -> Run:
    """All stages from a folder of source files."""
    files = episodes.list_files(spark, folder, prefix, content=True)
    timeline = cut(episodes.anchor_timeline(files))
    units = cut(segmentation.sentence_units(timeline))
    blocks = cut(segmentation.merge_blocks(units))
    units = units.join(segmentation.block_membership(blocks), ["episode_id", "sentence_id"], "left")
    texts = timeline.select("episode_id", F.lit("apple").alias("source"), F.col("full_text").alias("raw_text")).unionByName(episodes.engine_texts(files))
    aligned = cut(alignment.align_engines(texts))
    found = candidates.build(blocks, texts, aligned, mode, swapped)
    rows = found.unionByName(anchor_candidates(blocks, found))
    return run_fusion(units, blocks, rows, punctuate, model)


def run_fusion(units: DataFrame, blocks: DataFrame, found: DataFrame, punctuate: bool = True, model=None, cache: DataFrame | None = None) -> Run:
    """The stages after the candidates (also the way to resume). A model, if given, arbitrates doubtful blocks; cache holds its earlier decisions."""
    ask = arbitration.arbiter(model, cache) if model else None
    flagged = cut(risk.normalized_blocks(risk.flagged_blocks(blocks, found)))
    finals = cut(fusion.final_blocks(flagged, units, punctuate, arbiter=ask))
    return Run(units, blocks, found, flagged, finals, fusion.final_sentences(finals, units), reports.final_summary(finals))


def write_run(run: Run, root: str, source: str, force: bool = False) -> dict[str, int]:
    """Write all artifacts, then check what was written."""
    spark = run.finals.sparkSession
    sinks.guard_output(spark, source, root, force)
    tables = {
        "sentence_units": run.units,
        "alignment_blocks": run.blocks,
        "block_candidates": run.candidates,
        "final_blocks": run.finals,
        "final_sentences": run.sentences,
        "summary": run.summary,
        "review_queue": run.finals.where("needs_review"),
        "block_checks": validation.check_blocks(run.blocks, run.units),
    }
    for name, df in tables.items():
        sinks.write_table(df, root, name)
    sinks.write_transcripts(run.finals, root)
    return validation.check_outputs(spark, root, {"final_blocks": run.finals.count(), "review_queue": run.finals.where("needs_review").count(), "sentence_units": None})
