"""Reading the files of many episodes.

Files are listed and grouped by the episode key in their names; nothing limits a run to one
episode. Schemas are given, never inferred, since optional fields differ between files.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolweave.functions import tables as tb
from spoolweave.functions import text as tx
from spoolweave.operators import segmentation as sg

RUN = "struct<text:string,audioTimeRange:struct<startSeconds:double,endSeconds:double>,transcriptionConfidence:double>"
RESULT = f"struct<text:string,runs:array<{RUN}>,startSeconds:double,endSeconds:double,confidence:double>"
SEGMENTS = "segments array<struct<index:int,startSeconds:double,endSeconds:double,text:string,confidence:double>>"


def episode_key(name: Column, markers: tuple[str, ...] = tb.PREFIX_MARKERS) -> Column:
    """Episode prefix of a file name: the part before the first listed marker found, else the
    name of a txt, json or zip file without its extension, else null (S2)."""
    bare = F.when(name.rlike("\\.(txt|json|zip)$"), F.regexp_replace(name, "\\.[^.]*$", ""))
    return F.coalesce(*[F.when(name.contains(m), F.substring_index(name, m, 1)) for m in markers], bare)


def list_files(spark: SparkSession, folder: str, prefix: str | None = None, content: bool = False) -> DataFrame:
    """Files of a folder: name (NFC), path, episode_id, kind; and their bytes if asked for.

    Without ``content`` only names are read: the bytes column is pruned from the scan.
    """
    raw = spark.read.format("binaryFile").load(folder)
    name = tx.nfc(F.element_at(F.split("path", "/"), -1))
    out = raw.select(F.url_decode(name).alias("name"), "path", *(["content"] if content else []))
    if prefix is not None:
        out = out.where(F.col("name").startswith(tx.nfc_value(prefix)))
    return out.withColumn("episode_id", episode_key(F.col("name"))).withColumn("kind", file_kind(F.col("name"))).where("episode_id is not null")


def file_kind(name: Column) -> Column:
    """anchor_json, anchor_text, raw_zip, volatile_zip, an engine, or null."""
    kinds = {"volatile_zip": tb.VOLATILE_ZIP_SUFFIX, "raw_zip": tb.RAW_ZIP_SUFFIX, "anchor_json": tb.FINAL_JSON_SUFFIX, "anchor_text": tb.FALLBACK_TEXT_SUFFIX} | tb.ENGINE_SUFFIX
    return reduce(lambda acc, kv: acc.when(name.endswith(kv[1]), F.lit(kv[0])), kinds.items(), F.when(F.lit(False), F.lit("")))


def missing_inputs(files: DataFrame) -> DataFrame:
    """Required kinds that an episode lacks."""
    need = F.array(*map(F.lit, ("anchor_json", *tb.ENGINE_SUFFIX)))
    return files.groupBy("episode_id").agg(F.array_sort(F.array_except(need, F.collect_set("kind"))).alias("missing")).where(F.size("missing") > 0)


def engine_texts(files: DataFrame) -> DataFrame:
    """episode_id, source, raw_text of the flat engine texts (first by name where several fit)."""
    rows = files.where(F.col("kind").isin(*tb.ENGINE_SUFFIX)).groupBy("episode_id", "kind").agg(F.min_by("content", "name").alias("content"))
    return rows.select("episode_id", F.col("kind").alias("source"), F.decode("content", "UTF-8").alias("raw_text"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


# --- JSON inside zip archives


def members(content: bytes) -> Iterator[object]:
    """Parsed JSON members of an archive in archive order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for info in z.infolist():
            if not info.is_dir() and info.filename.endswith(".json"):
                yield json.loads(z.read(info).decode("utf-8"))


def first_results(content: bytes | None) -> list[dict]:
    """The results list of the first JSON member: its ``results``, itself if a list, else none."""
    data = next(members(content), None) if content else None
    if isinstance(data, dict):
        data = data.get("results", [])
    return data if isinstance(data, list) else []


def as_result(row: dict) -> dict:
    """One result with its text apart from its runs; text may be a scalar or {text, runs}."""
    text = row.get("text")
    inner = text if isinstance(text, dict) else {"text": text, "runs": []}
    start = float(row.get("startSeconds") or 0.0)
    runs = []
    for r in inner.get("runs") or []:
        span = r.get("audioTimeRange") or {}
        runs.append({"text": r.get("text"), "audioTimeRange": {k: span.get(k) for k in ("startSeconds", "endSeconds")}, "transcriptionConfidence": r.get("transcriptionConfidence")})
    return {
        "text": tx.nfc_value(str(inner.get("text") or "")),
        "runs": runs,
        "startSeconds": start,
        "endSeconds": float(row.get("endSeconds") or start),
        "confidence": float(row.get("confidence") or tb.DEFAULT_CONFIDENCE),
    }


def snapshot_texts(content: bytes | None) -> list[str]:
    """Text of each snapshot of a volatile archive, or one text of all results."""
    if content is None:
        return []
    rows = first_results(content)
    if rows and all(isinstance(r, dict) and isinstance(r.get("results"), list) for r in rows):
        return ["".join(as_result(x)["text"] for x in r["results"]) for r in rows]
    return ["".join(as_result(r)["text"] for r in rows if isinstance(r, dict))]


#: Characters of texts that leave Python at once.
BATCH_CHARS = 1_000_000
ANCHORS = ["episode_id", "full_text", "results", "has_snapshots", "source_file"]
ANCHOR_KINDS = ("anchor_json", "anchor_text", "raw_zip", "volatile_zip")


def anchor_results(raw_zip: bytes | None, segments: list | None, fallback: str) -> list[dict] | None:
    """Results of the archive, else of the final segments, else the fallback text as one segment of a twentieth of a second a character."""
    if raw := [as_result(r) for r in first_results(raw_zip) if isinstance(r, dict)]:
        return raw
    if segments is None or not len(segments):
        segments = [{"text": fallback, "startSeconds": 0.0, "endSeconds": max(0.1, len(fallback) / 20.0)}] if fallback else None

    def made(s: dict) -> dict:
        text, start, end, confidence = (s.get(k) for k in ("text", "startSeconds", "endSeconds", "confidence"))
        start = 0.0 if start is None else start
        return {
            "text": text or "",
            "runs": [],
            "startSeconds": start,
            "endSeconds": start if end is None else end,
            "confidence": tb.DEFAULT_CONFIDENCE if confidence is None else confidence,
        }

    return None if segments is None else [made(s or {}) for s in segments]


def _read_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results, text and snapshots of each episode; each file is opened once and few texts are held at a time."""
    for pdf in batches:
        rows, chars = [], 0
        for r in pdf.itertuples(index=False):
            fallback = tx.nfc_value(r.fallback or "")
            results = anchor_results(r.raw_zip, r.segments, fallback)
            joined = "".join(x["text"] for x in results or [])
            # an archive that is there but holds nothing still counts as one snapshot
            snaps = 0 if r.volatile_zip is None else max(len(snapshot_texts(r.volatile_zip)), 1)
            rows.append((r.episode_id, tx.nfc_value(joined) if joined else fallback, results, snaps, r.source_file))
            chars += len(joined) + len(r.volatile_zip or b"")
            if chars > BATCH_CHARS:
                yield pd.DataFrame(rows, columns=ANCHORS)
                rows, chars = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=ANCHORS)


def anchor_timeline(files: DataFrame) -> DataFrame:
    """Full anchor text and character timeline of each episode.

    files: as list_files with content. Raw results come from the archive, else from the
    final segments, else from the fallback text as one segment of a twentieth of a second
    a character.
    """
    content = F.when(F.col("kind").isin(*ANCHOR_KINDS), F.col("content"))
    wide = files.select("episode_id", "kind", "name", "path", content.alias("content")).groupBy("episode_id").agg(
        *[F.min_by(F.when(F.col("kind") == k, F.col("content")), F.when(F.col("kind") == k, F.col("name"))).alias(k) for k in ANCHOR_KINDS],
        F.min(F.when(F.col("kind") == "anchor_json", F.col("path"))).alias("source_file"),
    )
    parsed = F.from_json(F.decode("anchor_json", "UTF-8"), SEGMENTS)["segments"]
    # one operator reads everything: as columns, functions and the contents they take would be repeated for each use of them
    read = wide.select("episode_id", "raw_zip", "volatile_zip", F.decode("anchor_text", "UTF-8").alias("fallback"), parsed.alias("segments"), "source_file")
    df = read.mapInPandas(_read_anchors, f"episode_id string, full_text string, results array<{RESULT}>, has_snapshots int, source_file string")
    timeline = F.flatten(F.transform("results", lambda r: sg.char_timeline(r["text"], r["runs"], r["startSeconds"], r["endSeconds"])))
    return df.select("episode_id", "full_text", sg.padded_timeline(timeline, F.length("full_text")).alias("timeline"), "has_snapshots", "source_file")
