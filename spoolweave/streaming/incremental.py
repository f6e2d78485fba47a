"""Candidates that keep arriving: flags are normalised as files land.

The stages before the fusion are row-local, so a stream applies them unchanged; each batch
is appended once (the checkpoint makes a batch that is run again the same batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoolweave.operators import risk

BLOCK_ROW = (
    "episode_id string, block_id string, qwen_apple_difference_type string, qwen_apple_similarity double, risk_flags array<string>, "
    "qwen struct<local_alignment_score:double,alignment_score:double>, arrived timestamp"
)


def normalise(rows: DataFrame) -> DataFrame:
    """Row-local flag normalisation, for batch and stream alike."""
    done = risk.normalized_flags(
        F.col("qwen_apple_difference_type"), F.col("qwen_apple_similarity"), F.coalesce("qwen.local_alignment_score", "qwen.alignment_score"), F.col("risk_flags")
    )
    return rows.withColumn("n", done).select("episode_id", "block_id", "arrived", "n.*")


def read_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(BLOCK_ROW).json(folder)


def flag_counts(rows: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Flags by time window; rows later than ``late`` are left out, and finished windows leave the state."""
    flags = normalise(rows).withWatermark("arrived", late).select("arrived", F.explode("risk_flags").alias("flag"))
    return flags.groupBy(F.window("arrived", width), "flag").agg(F.count("*").alias("count"))


def start(rows: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write normalised rows as JSON; ``once`` takes all that is there and stops."""
    writer = normalise(rows).writeStream.format("json").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
