"""Session helpers: builder for local runs, checkpoint folder, table reading."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "spoolweave", memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset and the
    session is local is a temporary folder used.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    have = spark.sparkContext.getCheckpointDir()
    if have is None:
        have = tempfile.mkdtemp(prefix="spoolweave-ckpt-")
        spark.sparkContext.setCheckpointDir(have)
    return have


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows once as a table in the shared checkpoint folder and read them back.

    Unlike a plain recomputation the input is evaluated once, and the copy outlives any
    executor. The table is removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/spoolweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder, removed when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/spoolweave-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


_written: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_tables() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may be gone; the folder is temporary
            return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the input tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
