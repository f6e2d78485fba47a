"""Sentence chunks, units and blocks."""

from __future__ import annotations

import re
from bisect import bisect_right
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolweave.functions import tables as tb
from spoolweave.functions import text as tx
from spoolweave.operators import ordered as od

#: Seconds of recording in a block of ordered work: some hundreds of rows, so that the cost of a task's groups is small beside that of their rows.
BLOCK_SECONDS = 3600.0


def chunks(c: Column, terminators: str = tb.TERMINATORS) -> Column:
    """Array of (text, char_start, char_end): a cut after each terminator, blank chunks left out (G1).

    Chunks tile the text, so the ends are running sums of the lengths: one pass in the engine.
    """
    cls = "".join("\\" + t if t in "\\]^-[" else t for t in terminators)
    parts = F.regexp_extract_all(tx.text_or_empty(c), F.lit(f"([^{cls}]*[{cls}]|[^{cls}]+)"), 1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<text:string,char_start:int,char_end:int>>").alias("out"))
    # the fold appends to one growing array; lengths of transcripts make that linear enough
    done = F.aggregate(
        parts,
        start,
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p)).alias("at"),
            F.array_append(acc["out"], F.struct(p.alias("text"), acc["at"].alias("char_start"), (acc["at"] + F.length(p)).alias("char_end"))).alias("out"),
        ),
    )["out"]
    return F.filter(done, lambda x: ~tx.is_blank(x["text"]))


def sentence_chunks(df: DataFrame, column: str, keys: list[str], terminators: str = tb.TERMINATORS) -> DataFrame:
    """One row per chunk: keys, chunk_no (from 1), text, char_start, char_end.

    Offsets come from a running sum over the exploded chunks of a text, so long texts cost no
    growing array. Null and empty texts give no rows.
    """
    cls = "".join("\\" + t if t in "\\]^-[" else t for t in terminators)
    slim = df.select(*keys, F.regexp_extract_all(F.col(column), F.lit(f"([^{cls}]*[{cls}]|[^{cls}]+)"), 1).alias("__parts"))
    sizes = F.transform("__parts", lambda p: F.length(p))
    slim = slim.withColumn("__ends", _running(sizes))
    rows = slim.select(*keys, F.posexplode(F.arrays_zip("__parts", "__ends"))).withColumn("text", F.col("col.__parts")).withColumn("char_end", F.col("col.__ends"))
    rows = rows.where(F.length("text") > 0).withColumn("char_start", F.col("char_end") - F.length("text"))
    rows = rows.where(~tx.is_blank(F.col("text")))
    return rows.select(*keys, (F.col("pos") + 1).alias("chunk_no"), "text", F.col("char_start").cast("int"), F.col("char_end").cast("int"))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _running(sizes: pd.Series) -> pd.Series:
    """Running sums of each list."""
    return pd.Series([None if s is None else pd.Series(s, dtype="int64").cumsum().to_numpy(dtype="int32") for s in sizes])


def char_timeline(text: Column, runs: Column, start: Column, end: Column) -> Column:
    """Time and confidence of each character of a result: its run's, or an even share of the interval (A4)."""
    facts = F.struct(F.length(text).alias("n"), start.cast("double").alias("s"), F.greatest(end - start, F.lit(0.01)).cast("double").alias("d"), end.cast("double").alias("e"))

    def spread(x: Column) -> Column:
        # the length is taken once a text, not once a character
        places = F.when(x["n"] > 0, F.sequence(F.lit(0), x["n"] - 1)).otherwise(F.array().cast("array<int>"))
        count = F.size(runs)

        def of_run(i: Column) -> Column:
            r = F.get(runs, F.least(i, count - 1))
            return F.struct(
                F.coalesce(r["audioTimeRange"]["startSeconds"], x["s"]).cast("double").alias("start_sec"),
                F.coalesce(r["audioTimeRange"]["endSeconds"], x["e"]).cast("double").alias("end_sec"),
                F.coalesce(r["transcriptionConfidence"], F.lit(tb.DEFAULT_CONFIDENCE)).cast("double").alias("confidence"),
            )

        def even(i: Column) -> Column:
            return F.struct(
                (x["s"] + x["d"] * i / x["n"]).cast("double").alias("start_sec"), (x["s"] + x["d"] * (i + 1) / x["n"]).cast("double").alias("end_sec"), F.lit(tb.DEFAULT_CONFIDENCE).alias("confidence")
            )

        return F.when(F.coalesce(count, F.lit(0)) > 0, F.transform(places, of_run)).otherwise(F.transform(places, even))

    return tx.let(facts, spread)


def padded_timeline(timeline: Column, length: Column) -> Column:
    """A timeline as long as the text: 0.01 s for each character that is missing."""
    have = F.size(timeline)
    last = F.coalesce(F.get(timeline, have - 1)["end_sec"], F.lit(0.0))
    more = F.when(length > have, F.sequence(F.lit(0), length - have - 1)).otherwise(F.array().cast("array<int>"))
    tail = F.transform(
        more, lambda i: F.struct((last + i * 0.01).alias("start_sec"), (last + (i + 1) * 0.01).alias("end_sec"), F.lit(tb.DEFAULT_CONFIDENCE).alias("confidence"))
    )
    return F.concat(timeline, tail)


def run_range(runs: Column, first: Column, last: Column) -> Column:
    """Start of the first and end of the last run of a range (A5)."""
    lo, hi = F.get(runs, first)["audioTimeRange"], F.get(runs, F.least(last, F.size(runs)) - 1)["audioTimeRange"]
    return F.struct(lo["startSeconds"].alias("start_sec"), hi["endSeconds"].alias("end_sec"))


def sentence_units(texts: DataFrame, terminators: str = tb.TERMINATORS) -> DataFrame:
    """Units of full texts with character timelines.

    texts: episode_id, full_text, timeline (array of start_sec, end_sec), has_snapshots
    (int: volatile snapshots read), source_file. A chunk with no timeline is skipped (its
    number stays used); a fragment under three characters without a closing mark joins the
    unit kept before it.
    """
    units = _timed_chunks(F.col("full_text"), F.transform("timeline", lambda x: x["start_sec"]), F.transform("timeline", lambda x: x["end_sec"]), F.lit(terminators))
    rows = texts.select("episode_id", "has_snapshots", "source_file", F.explode(units).alias("u")).select("episode_id", "has_snapshots", "source_file", "u.*")
    marks = "".join("\\" + t if t in "\\]^-[" else t for t in terminators)
    tiny = (F.length(tx.strip(F.col("text"))) < tb.MIN_FRAGMENT) & ~F.col("text").rlike(f"[{marks}]$")
    rows = rows.withColumn(od.BLOCK, F.floor(F.col("n") / 256).cast("bigint")).withColumn("keep", ~tiny)
    rows = rows.withColumn("kind", F.when((F.length("text") < tb.MIN_FRAGMENT) & ~F.col("text").rlike(f"[{marks}]$"), "tail").otherwise("sentence"))
    return _islands(rows)


_CHUNK = T.StructType(
    [
        T.StructField("n", T.IntegerType()),
        T.StructField("text", T.StringType()),
        *(T.StructField(n, T.IntegerType()) for n in ("char_start", "char_end")),
        *(T.StructField(n, T.DoubleType()) for n in ("start_sec", "end_sec")),
    ]
)


@F.pandas_udf(T.ArrayType(_CHUNK))
def _timed_chunks(text: pd.Series, starts: pd.Series, ends: pd.Series, marks: pd.Series) -> pd.Series:
    """Chunks of each text with the times of their characters; a chunk beyond the timeline is left out."""
    out = []
    for t, s, e, m in zip(text, starts, ends, marks, strict=True):
        units, at, n = [], 0, 0
        for piece in re.findall(f"[^{re.escape(m)}]*[{re.escape(m)}]|[^{re.escape(m)}]+", t or ""):
            stop = at + len(piece)
            if piece.strip():
                n += 1
                if s is not None and at < len(s):
                    units.append({"n": n, "text": piece, "char_start": at, "char_end": stop, "start_sec": float(s[at]), "end_sec": float(e[min(stop, len(e)) - 1])})
            at = stop
        out.append(units)
    return pd.Series(out)


def _islands(rows: DataFrame) -> DataFrame:
    """Join each fragment to the last kept unit before it; the first unit of a text is kept."""
    order = ["n"]
    rows = od.carry_last(rows, ["episode_id"], order, F.lit(1), "has_before")
    rows = rows.withColumn("keep", F.col("keep") | F.col("has_before").isNull())
    local = Window.partitionBy("episode_id", od.BLOCK).orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("head", F.last(F.when(F.col("keep"), F.col("n")), ignorenulls=True).over(local))
    heads = rows.groupBy("episode_id", od.BLOCK).agg(F.max("head").alias("h"))
    before = Window.partitionBy("episode_id").orderBy(od.BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("episode_id", od.BLOCK, F.last("h", ignorenulls=True).over(before).alias("carried"))
    rows = rows.join(heads, ["episode_id", od.BLOCK]).withColumn("head", F.coalesce("head", "carried"))
    joined = rows.groupBy("episode_id", "head").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), "").alias("text"),
        F.min("char_start").alias("char_start"),
        F.max("char_end").alias("char_end"),
        F.min_by("start_sec", "n").alias("start_sec"),
        F.max_by("end_sec", "n").alias("end_sec"),
        F.min_by("kind", "n").alias("unit_kind"),
        F.first("has_snapshots").alias("snapshots"),
        F.first("source_file").alias("source_file"),
    )
    snap = F.col("snapshots")
    hint = tx.boundary_hint(F.col("text"))
    return joined.select(
        "episode_id",
        F.format_string("sent_%06d", F.col("head")).alias("sentence_id"),
        F.col("head").alias("seq"),
        "text",
        "char_start",
        "char_end",
        "start_sec",
        "end_sec",
        F.when(snap > 0, 2).otherwise(0).alias("confirmation_count"),
        F.when(snap >= 2, F.array(F.lit(0), F.lit(1))).when(snap == 1, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")).alias("confirmed_snapshot_indexes"),
        F.when(snap > 0, 0.85).otherwise(0.7).alias("stability_score"),
        F.col("unit_kind"),
        F.lit(False).alias("start_sec_is_estimated"),
        F.lit(False).alias("end_sec_is_estimated"),
        "source_file",
        F.col("head").cast("int").alias("source_index"),
        F.lit(None).cast("double").alias("confidence"),
        hint["raw_text"].alias("raw_text"),
        hint["alignment_text"].alias("alignment_text"),
        hint["boundary_text"].alias("boundary_text"),
        hint["display_text"].alias("display_text"),
        hint["boundary_hints"].alias("boundary_hints"),
    )


# --- blocks

OPEN = "struct<head:string,start:double,size:int,last_end:double,hinted:boolean>"


def _group(rows: pd.DataFrame, state: Any, least: int, most: int, min_s: float, max_s: float) -> tuple[dict[str, list], Any]:
    """Append each unit to the open group or begin a new one with it.

    A group is closed once it has the least count and duration. It is also closed before a
    unit when it has the least count and that unit or its own last one is a short response,
    when it is full, or when the unit would make it too long.
    """
    head, start, size, last_end, hinted = (state["head"], state["start"], state["size"], state["last_end"], state["hinted"]) if state else (None, 0.0, 0, 0.0, False)
    heads = []
    for sid, s, e, short in zip(rows["sentence_id"], rows["start_sec"], rows["end_sec"], rows["short"], strict=True):
        grows = head is not None
        if grows:
            closed = size >= least and size > 1 and last_end - start >= min_s
            split = size >= least and (hinted or short)
            fits = size < most and (e - start <= max_s or size < least)
            grows = not closed and not split and fits
        if grows:
            size += 1
        else:
            head, start, size = sid, s, 1
        last_end, hinted = e, bool(short)
        heads.append(head)
    return {"sentence_id": rows["sentence_id"].tolist(), "head": heads}, {"head": head, "start": float(start), "size": int(size), "last_end": float(last_end), "hinted": bool(hinted)}


def merge_blocks(
    units: DataFrame,
    least: int = tb.BLOCK_MIN_UNITS,
    most: int = tb.BLOCK_MAX_UNITS,
    min_seconds: float = tb.BLOCK_MIN_SECONDS,
    max_seconds: float = tb.BLOCK_MAX_SECONDS,
    width: float = BLOCK_SECONDS,
) -> DataFrame:
    """Greedy blocks of units by count and duration, oversized ones split at sentences, numbered.

    Order is start_sec, then sentence_id. A null end counts as the start. The fold runs in
    blocks of recording time; a group open at a block's end is the state carried on.
    """
    ids = units.select(
        "episode_id",
        "sentence_id",
        "start_sec",
        F.coalesce("end_sec", "start_sec").alias("end_sec"),
        F.coalesce(F.exists("boundary_hints", lambda h: h["type"] == tb.HINT_TYPE), F.lit(False)).alias("short"),
    ).dropDuplicates(["episode_id", "sentence_id"])
    timed = od.with_blocks(ids, "start_sec", width)
    heads = od.forgetful_fold(
        timed, ["episode_id"], ["start_sec", "sentence_id"], lambda r, s: _group(r, s, least, most, min_seconds, max_seconds), "sentence_id string, head string", OPEN, width
    )
    members = units.dropDuplicates(["episode_id", "sentence_id"]).join(heads, ["episode_id", "sentence_id"])
    cols = F.struct("start_sec", "sentence_id", F.coalesce("end_sec", "start_sec").alias("end_sec"), "text", "char_start", "char_end", "stability_score")
    groups = members.groupBy("episode_id", "head").agg(F.array_sort(F.collect_list(cols)).alias("u"))
    groups = groups.withColumn("parts", _parts(F.col("u"), most, max_seconds)).withColumn("split", F.size("parts") > 1)
    rows = groups.select("episode_id", "u", "split", F.explode("parts").alias("part"))
    get = lambda f: F.transform("part", lambda x: x[f])
    first, last = F.get("part", F.lit(0)), F.get("part", F.size("part") - 1)
    rows = rows.select(
        "episode_id",
        get("sentence_id").alias("sentence_ids"),
        F.size("part").alias("sentence_count"),
        F.array_join(get("text"), "").alias("text"),
        first["char_start"].alias("char_start"),
        last["char_end"].alias("char_end"),
        first["start_sec"].alias("start_sec"),
        last["end_sec"].alias("end_sec"),
        F.array_min(get("stability_score")).alias("stability_score"),
        F.when(F.col("split"), "sentence_boundary_split").alias("block_split_reason"),
        F.transform("u", lambda x: x["sentence_id"]).alias("parent_sentence_ids"),
        F.col("split").alias("is_sub_block"),
        first["sentence_id"].alias("__first"),
    )
    rows = od.row_numbers(od.with_blocks(rows, "start_sec", width), ["episode_id"], ["start_sec", "__first"], "block_seq")
    return rows.withColumn("block_id", F.format_string("block_%06d", F.col("block_seq"))).drop("__first", od.BLOCK)


def _parts(u: Column, most: int, max_seconds: float) -> Column:
    """Greedy split of one group's units by count and duration (groups are small)."""
    kind = "array<array<struct<start_sec:double,sentence_id:string,end_sec:double,text:string,char_start:int,char_end:int,stability_score:double>>>"
    total = F.get(u, F.size(u) - 1)["end_sec"] - F.get(u, F.lit(0))["start_sec"]

    def step(acc: Column, x: Column) -> Column:
        open_ = F.get(acc, F.size(acc) - 1)
        over = (F.size(acc) == 0) | (F.size(open_) + 1 > most) | (x["end_sec"] - F.get(open_, F.lit(0))["start_sec"] > max_seconds)
        return F.when(over, F.array_append(acc, F.array(x))).otherwise(F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.array_append(open_, x))))

    split = F.aggregate(u, F.array().cast(kind), step)
    keep = (F.size(u) <= 1) | ((F.size(u) <= most) & (total <= max_seconds))
    return F.when(keep, F.array(u).cast(kind)).otherwise(split)


def block_membership(blocks: DataFrame) -> DataFrame:
    """episode_id, sentence_id, block_id."""
    return blocks.select("episode_id", F.explode("sentence_ids").alias("sentence_id"), "block_id")


# --- clamping


LEAST_SECONDS = 0.1


def _clamp(rows: pd.DataFrame, previous: float | None) -> tuple[list[float], list[float]]:
    starts, ends = [], []
    for s, e in zip(rows["start_sec"], rows["end_sec"], strict=True):
        if previous is not None:
            s = max(s, previous)
            if e <= s:
                e = s + LEAST_SECONDS
        starts.append(float(s))
        ends.append(float(e))
        previous = float(e)
    return starts, ends


def _clamp_function(rows: pd.DataFrame) -> tuple[list[float], list[float], int]:
    """The end after some rows as a function of the end before them.

    Below limits[k] (and not below the one before) it is values[k]; from the last limit on,
    each row adds LEAST_SECONDS. A row sends an end under its own limit to its own end.
    """
    limits: list[float] = []
    values: list[float] = []
    pushed = 0
    for s, e in zip(rows["start_sec"], rows["end_sec"], strict=True):
        limit, own = (e, e) if e > s else (s, s + LEAST_SECONDS)
        values = [own if v < limit else v + LEAST_SECONDS for v in values]
        reach = limit - LEAST_SECONDS * pushed
        if not limits or reach > limits[-1]:
            limits.append(reach)
            values.append(own)
        pushed += 1
        # pieces of one value are one piece
        keep = [k for k in range(len(values)) if k == len(values) - 1 or values[k] != values[k + 1]]
        limits, values = [limits[k] for k in keep], [values[k] for k in keep]
    return limits, values, pushed


def _clamped_end(limits: list[float], values: list[float], pushed: int, before: float) -> float:
    k = bisect_right(limits, before)
    if k < len(values):
        return float(values[k])
    for _ in range(pushed):
        before += LEAST_SECONDS
    return float(before)


def clamp_times(df: DataFrame, key: str, ident: str, order: list[str], width: float = BLOCK_SECONDS) -> DataFrame:
    """Each start at or after the end before it, and each end at least 0.1 s after its start.

    Every block of time becomes a function from the end before it to the end after it; the
    functions are applied in order over one row a block, and each block is then clamped from
    its own end before. Nothing is run twice, whatever the times are.
    """
    kind, key_kind = dict(df.dtypes)[ident], dict(df.dtypes)[key]
    slim = df.select(key, F.col(ident).alias("__id"), *[c for c in dict.fromkeys(order) if c not in ("start_sec", "end_sec", ident)], "start_sec", "end_sec")
    by = ["__id" if o == ident else o for o in order]
    rows = od.with_blocks(slim, by[0], width).withColumn("start_sec", F.col("start_sec").cast("double")).withColumn("end_sec", F.col("end_sec").cast("double"))

    def summed(pdf: pd.DataFrame) -> list[dict]:
        limits, values, pushed = _clamp_function(pdf)
        return [{key: pdf[key].iloc[0], od.BLOCK: pdf[od.BLOCK].iloc[0], "limits": limits, "values": values, "pushed": pushed, "alone": _clamp(pdf, None)[1][-1]}]

    def scanned(pdf: pd.DataFrame) -> list[dict]:
        rows, end = [], None
        for k, block, limits, values, pushed, alone in zip(*(pdf[c] for c in (key, od.BLOCK, "limits", "values", "pushed", "alone")), strict=True):
            rows.append({key: k, od.BLOCK: block, "before": end})
            end = float(alone) if end is None else _clamped_end(list(limits), list(values), int(pushed), end)
        return rows

    def clamped(pdf: pd.DataFrame) -> list[dict]:
        before = pdf["before"].iloc[0]
        starts, ends = _clamp(pdf, None if pd.isna(before) else float(before))
        return [{key: k, "__id": i, "start_clamped": s, "end_clamped": e} for k, i, s, e in zip(pdf[key], pdf["__id"], starts, ends, strict=True)]

    block = [key, od.BLOCK]
    functions = od.map_groups(rows, block, by, summed, f"`{key}` {key_kind}, {od.BLOCK} bigint, limits array<double>, values array<double>, pushed int, alone double")
    before = od.map_groups(functions, [key], [od.BLOCK], scanned, f"`{key}` {key_kind}, {od.BLOCK} bigint, before double")
    done = od.map_groups(rows.join(before, block), block, by, clamped, f"`{key}` {key_kind}, __id {kind}, start_clamped double, end_clamped double")
    return done.withColumnRenamed("__id", ident)


# --- older segmenters


def _short(rows: pd.DataFrame, state: Any) -> tuple[dict[str, list], Any]:
    """Join a chunk to the one before while either is short and both together stay small."""
    head, start, end, size = (state["head"], state["start"], state["end"], state["size"]) if state else (None, 0.0, 0.0, 0)
    heads = []
    for cid, s, e, n in zip(rows["chunk_id"], rows["start_sec"], rows["end_sec"], rows["n"], strict=True):
        short = size < tb.SHORT_CHUNK_CHARS or n < tb.SHORT_CHUNK_CHARS or end - start < tb.SHORT_CHUNK_SECONDS or e - s < tb.SHORT_CHUNK_SECONDS
        if head is not None and short and size + n <= tb.MERGED_CHARS and e - start <= tb.MERGED_SECONDS:
            size, end = size + n, e
        else:
            head, start, end, size = cid, s, e, n
        heads.append(head)
    return {"chunk_id": rows["chunk_id"].tolist(), "head": heads}, {"head": head, "start": float(start), "end": float(end), "size": int(size)}


def merge_short_chunks(df: DataFrame, width: float = BLOCK_SECONDS) -> DataFrame:
    """Short chunks joined to their neighbours (G6): episode_id, head, text, start_sec, end_sec, chunks.

    df: episode_id, chunk_id, start_sec, end_sec, text.
    """
    slim = df.select("episode_id", "chunk_id", "start_sec", "end_sec", F.length("text").alias("n"))
    heads = od.forgetful_fold(
        od.with_blocks(slim, "start_sec", width), ["episode_id"], ["start_sec", "chunk_id"], _short, "chunk_id string, head string", "struct<head:string,start:double,end:double,size:int>", width
    )
    joined = df.join(heads, ["episode_id", "chunk_id"]).groupBy("episode_id", "head").agg(
        F.array_sort(F.collect_list(F.struct("start_sec", "chunk_id", "text", "end_sec"))).alias("c")
    )
    return joined.select(
        "episode_id",
        "head",
        F.array_join(F.transform("c", lambda x: x["text"]), "").alias("text"),
        F.get("c", F.lit(0))["start_sec"].alias("start_sec"),
        F.get("c", F.size("c") - 1)["end_sec"].alias("end_sec"),
        F.size("c").alias("chunks"),
    )


def segment_records(texts: DataFrame, terminators: str = tb.TERMINATORS) -> DataFrame:
    """Numbered segments of full texts: timed chunks, short ones joined to their neighbours.

    texts: episode_id, full_text, timeline, source_file.
    """
    timed = _timed_chunks(F.col("full_text"), F.transform("timeline", lambda x: x["start_sec"]), F.transform("timeline", lambda x: x["end_sec"]), F.lit(terminators))
    rows = texts.select("episode_id", "source_file", F.explode(timed).alias("u")).select("episode_id", "source_file", "u.*").withColumn("chunk_id", F.format_string("%012d", "n"))
    merged = merge_short_chunks(rows.select("episode_id", "chunk_id", "start_sec", "end_sec", "text"))
    head = rows.select("episode_id", F.col("chunk_id").alias("head"), "char_start", "source_file", F.col("n").alias("source_index"))
    df = od.row_numbers(od.with_blocks(merged.join(head, ["episode_id", "head"]), "start_sec", BLOCK_SECONDS), ["episode_id"], ["start_sec", "head"], "no")
    return df.select(
        "episode_id",
        F.format_string("seg_%06d", "no").alias("segment_id"),
        "start_sec",
        "end_sec",
        "text",
        "char_start",
        (F.col("char_start") + F.length("text")).alias("char_end"),
        F.lit(0.8).alias("stability_score"),
        F.lit(False).alias("start_sec_is_estimated"),
        "source_file",
        "source_index",
    )
