"""Writing results (S13-S16): one dataset an artifact, by episode; the committer makes it atomic."""

from __future__ import annotations

import io
import json
import os
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolweave.functions import tables as tb


def guard_output(spark: SparkSession, source: str, target: str, force: bool = False) -> None:
    """Refuse nested folders, and a filled target unless forced; forced, it is emptied."""
    a, b = source.rstrip("/") + "/", target.rstrip("/") + "/"
    if a.startswith(b) or b.startswith(a):
        raise ValueError("input and output folders may not hold each other")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path) and fs.listStatus(path):
        if not force:
            raise FileExistsError(target)
        fs.delete(path, True)


def write_table(df: DataFrame, root: str, name: str, fmt: str = "json", mode: str = "overwrite") -> str:
    """One artifact under root/name, partitioned by episode."""
    path = f"{root.rstrip('/')}/{name}"
    writer = df.write.mode(mode)
    if "episode_id" in df.columns:
        # rows of an episode together, a large episode in several files
        writer = df.repartition("episode_id", F.pmod(F.hash(*[c for c in df.columns if c != "episode_id"][:1]), F.lit(8))).write.mode(mode).partitionBy("episode_id")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(path)
    return path


def _file_bytes(source: str, text: str) -> list[tuple[str, bytes]]:
    """(name suffix, content) of the files that hold a source's text."""
    if source == tb.ANCHOR:
        seconds = max(0.1, len(text) / 20.0)
        part = {"index": 0, "startSeconds": 0.0, "endSeconds": seconds, "text": text, "confidence": tb.DEFAULT_CONFIDENCE}
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("raw.json", json.dumps({"results": [part]}, ensure_ascii=False))
        return [(tb.FINAL_JSON_SUFFIX, json.dumps({"segments": [part]}, ensure_ascii=False).encode()), (tb.RAW_ZIP_SUFFIX, packed.getvalue())]
    suffix = tb.ENGINE_SUFFIX.get(source, tb.FALLBACK_TEXT_SUFFIX if source == "apple_txt" else None)
    return [(suffix, text.encode("utf-8", "surrogatepass"))] if suffix else []


def write_episode_files(texts: DataFrame, folder: str) -> str:
    """Texts as the files a run reads: an engine's text file, the anchor's JSON and archive, its fallback text.

    texts: episode_id, source, raw_text; one row a file set. Every task writes its own files
    to the shared folder; a file written again by a repeated task is the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa_fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")
        fs.create_dir(root, recursive=True)
        for batch in batches:
            n = 0
            for e, s, t in zip(*(batch.column(c).to_pylist() for c in ("episode_id", "source", "raw_text")), strict=True):
                for suffix, content in _file_bytes(s, t or ""):
                    with fs.open_output_stream(f"{root}/{e}{suffix}") as f:
                        f.write(content)
                    n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    texts.select("episode_id", "source", "raw_text").mapInArrow(run, "files bigint").agg(F.sum("files")).collect()
    return folder


def transcript_line(start: Column, end: Column, text: Column) -> Column:
    """A line of the transcript: - [s.ss-e.ee] text."""
    return F.format_string("- [%.2f-%.2f] %s", start, end, text)


def write_transcripts(finals: DataFrame, root: str) -> str:
    """Transcript lines of each episode in time order, as text files by episode.

    Lines are range-partitioned by (episode, start), so no task takes a whole episode.
    """
    path = f"{root.rstrip('/')}/transcript"
    rows = finals.select("episode_id", "start_sec", transcript_line(F.col("start_sec"), F.col("end_sec"), F.col("final_text_display")).alias("value"))
    rows = rows.repartitionByRange("episode_id", "start_sec").sortWithinPartitions("episode_id", "start_sec").drop("start_sec")
    rows.write.mode("overwrite").partitionBy("episode_id").text(path)
    return path


def markdown_counts(counts: DataFrame, title: str) -> DataFrame:
    """Lines of a Markdown list of counts: - name: n."""
    return counts.select(F.lit(title).alias("title"), F.format_string("- %s: %d", F.col("name").cast("string"), F.col("count")).alias("line"))
