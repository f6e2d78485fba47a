"""Checks of units, blocks and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolweave.functions import tables as tb
from spoolweave.operators import ordered as od


def check_units(units: DataFrame, texts: DataFrame | None = None, width: float = 4096) -> DataFrame:
    """Per unit: length, whether it starts before the one before ends, and whether its slice of
    the full text differs (V1, W4). texts: episode_id, full_text, or None to leave that out."""
    rows = units.dropDuplicates(["episode_id", "sentence_id"]).select("episode_id", "sentence_id", "text", "char_start", "char_end")
    rows = od.carry_last(od.with_blocks(rows, F.coalesce("char_start", F.lit(0)), width), ["episode_id"], ["char_start", "sentence_id"], F.col("char_end"), "before")
    rows = rows.withColumn("length", F.length("text")).withColumn("overlap", F.coalesce(F.col("char_start") < F.col("before"), F.lit(False)))
    rows = rows.withColumn("very_short", F.col("length") < tb.MIN_FRAGMENT)
    if texts is None:
        return rows.select("episode_id", "sentence_id", "length", "overlap", "very_short", F.lit(None).cast("boolean").alias("mismatch"))
    joined = rows.join(texts.select("episode_id", "full_text"), "episode_id", "left")
    piece = F.substring("full_text", F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    return joined.select("episode_id", "sentence_id", "length", "overlap", "very_short", (~F.col("text").eqNullSafe(piece)).alias("mismatch"))


def unit_summary(checked: DataFrame) -> DataFrame:
    """Counts and lengths of an episode's units."""
    return checked.groupBy("episode_id").agg(
        F.count("*").alias("units"),
        F.count_if("overlap").alias("overlaps"),
        F.count_if("mismatch").alias("mismatches"),
        F.count_if("very_short").alias("very_short_sentence_count"),
        F.min("length").alias("min_sentence_length"),
        F.max("length").alias("max_sentence_length"),
    )


def check_blocks(blocks: DataFrame, units: DataFrame) -> DataFrame:
    """Per block: missing and repeated sentences, and whether text and times equal the members' (V2, J3, J10)."""
    own = units.dropDuplicates(["episode_id", "sentence_id"]).select("episode_id", "sentence_id", F.col("text").alias("u_text"), F.col("start_sec").alias("u_start"), F.col("end_sec").alias("u_end"))
    rows = blocks.dropDuplicates(["episode_id", "block_id"])
    members = rows.select("episode_id", "block_id", F.posexplode("sentence_ids").alias("pos", "sentence_id"))
    found = members.join(own, ["episode_id", "sentence_id"], "left")
    agg = found.groupBy("episode_id", "block_id").agg(
        F.count_if(F.col("u_text").isNull()).alias("missing"),
        (F.count("*") - F.count_distinct("sentence_id")).alias("repeated"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "u_text"))), lambda x: F.coalesce(x["u_text"], F.lit(""))), "").alias("joined"),
        F.min_by("u_start", "pos").alias("first_start"),
        F.max_by("u_end", "pos").alias("last_end"),
    )
    return rows.join(agg, ["episode_id", "block_id"], "left").select(
        "episode_id",
        "block_id",
        F.coalesce("missing", F.lit(0)).alias("missing"),
        F.coalesce("repeated", F.lit(0)).alias("repeated"),
        F.col("joined").isNull().alias("empty"),
        (~F.col("text").eqNullSafe(F.col("joined"))).alias("text_mismatch"),
        (~F.col("start_sec").eqNullSafe(F.col("first_start")) | ~F.col("end_sec").eqNullSafe(F.col("last_end"))).alias("time_mismatch"),
    )


def unassigned_sentences(blocks: DataFrame, units: DataFrame) -> DataFrame:
    """Sentences in no block (anti join)."""
    named = blocks.select("episode_id", F.explode("sentence_ids").alias("sentence_id")).distinct()
    return units.select("episode_id", "sentence_id").distinct().join(named, ["episode_id", "sentence_id"], "left_anti")


def doubly_assigned(blocks: DataFrame) -> DataFrame:
    """Sentences in more than one block, with the number of blocks."""
    rows = blocks.select("episode_id", "block_id", F.explode("sentence_ids").alias("sentence_id")).distinct()
    return rows.groupBy("episode_id", "sentence_id").agg(F.count("*").alias("blocks")).where("blocks > 1")


def check_outputs(spark: SparkSession, root: str, expected: dict[str, int | None]) -> dict[str, int]:
    """Row counts of the written artifacts; raises where one is missing or has not the rows expected (V3)."""
    found = {}
    for name, rows in expected.items():
        n, broken = spark.read.text(f"{root.rstrip('/')}/{name}").agg(F.count("*"), F.count_if(F.try_parse_json("value").isNull())).first()
        if broken:
            raise RuntimeError(f"{name}: {broken} lines are not JSON")
        if rows is not None and n != rows:
            raise RuntimeError(f"{name}: {n} rows written, {rows} expected")
        found[name] = n
    return found
