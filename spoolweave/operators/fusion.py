"""Choosing and cleaning the final text of each block.

Row-local work (scores, choice, downgrade, switch) is column expressions. The edge cleanup
looks at the text before it as already cleaned, so it is a fold; the fold runs block of time
by block of time and carries only the last row's texts (see ordered.forgetful_fold).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolweave.functions import numeric as nm
from spoolweave.functions import similarity as sm
from spoolweave.functions import tables as tb
from spoolweave.functions import text as tx
from spoolweave.operators import ordered as od
from spoolweave.operators.risk import HARD, no, zero
from spoolweave.operators.segmentation import BLOCK_SECONDS, clamp_times
from spoolweave.session import cut


def local_score(source: str) -> Column:
    return zero(F.coalesce(F.col(f"{source}.local_alignment_score"), F.col(f"{source}.alignment_score")))


def rank_score(source: str) -> Column:
    """The score that downgrades compare: alignment, not the combined score (kept as it is established)."""
    return zero(F.coalesce(F.col(f"{source}.alignment_score"), F.col(f"{source}.local_alignment_score")))


def combined_score(source: str) -> Column:
    """Alignment, agreement, stability and source, less penalties for doubtful spans."""
    align, agree, stable = local_score(source), zero(F.col("candidate_agreement_score")), zero(F.col("stability_score"))
    bonus = F.lit(tb.SOURCE_BONUS.get(source, 0.0)) + F.when(no(F.col(f"{source}.usable_for_agreement")), 0.04).otherwise(-0.05)
    penalty = F.lit(0.0)
    ratio = zero(F.col("qwen_apple_similarity"))
    if source != tb.ANCHOR:
        weak = F.when(align < 0.70, 0.18).when(align < 0.82, 0.08).otherwise(0.0)
        penalty = penalty + (weak if source != tb.PRIMARY else F.when(ratio < 0.75, weak).otherwise(0.0))
        text = F.col(f"{source}_text")
        penalty = penalty + F.when(no(F.col(f"{source}.boundary_contamination")) | tx.suspect_edge(text), 0.10).otherwise(0.0)
        penalty = penalty + F.when(sm.anchor_mismatch(text, F.col(f"{tb.ANCHOR}_text")), 0.16).otherwise(0.0)
    if source == tb.PRIMARY:
        hard = F.coalesce(F.col("qwen_apple_difference_type"), F.lit("")).isin(*HARD)
        penalty = penalty + F.when(hard & (ratio < 0.50), 0.20).when(hard & (ratio < 0.75), 0.08).otherwise(0.0)
    return nm.clamp(0.56 * align + 0.24 * agree + 0.12 * stable + bonus - penalty, 0.0, 1.0)


def best_of(options: Column) -> Column:
    """The greatest of an array of structs that begin with what counts, or null."""
    return F.array_max(options)


def candidate_list() -> Column:
    """The sources as structs: combined score, then priority, then what the later steps need."""
    rows = [
        F.struct(
            combined_score(s).alias("score"),
            F.lit(-i).alias("priority"),
            F.lit(s).alias("source"),
            F.col(f"{s}_text").alias("text"),
            F.col(f"{s}_norm").alias("norm"),
            local_score(s).alias("local"),
            rank_score(s).alias("rank"),
        )
        for i, s in enumerate(tb.SOURCE_PRIORITY)
    ]
    return F.array(*rows)


def downgraded(x: Column) -> Column:
    """Struct of the ranked row and the row after the downgrade of a cut primary text.

    x: struct of the candidate list and its best row. Anchor (0.02 ahead) and whisper compete;
    the better of them replaces a primary text that is cut off and scores under 0.82.
    """
    plus = F.create_map(F.lit(tb.ANCHOR), F.lit(0.02), F.lit("whisper"), F.lit(0.0))
    rivals = F.filter(x["list"], lambda c: c["source"].isin(tb.ANCHOR, "whisper") & (F.length(c["text"]) > 0))
    rival = best_of(F.transform(rivals, lambda c: F.struct((c["rank"] + plus[c["source"]]).alias("r"), c["source"].alias("s"), c.alias("c"))))
    cut_off = (x["top"]["source"] == tb.PRIMARY) & (x["top"]["local"] < 0.82) & tx.trailing_cut(x["top"]["text"])
    return tx.let(
        F.struct(x["list"].alias("list"), x["top"].alias("top"), rival.alias("rival"), cut_off.alias("cut")),
        lambda y: F.struct(
            y["list"].alias("list"),
            y["top"].alias("top"),
            F.when(no(y["cut"] & (y["rival"]["r"] >= y["top"]["rank"])), y["rival"]["c"]).otherwise(y["top"]).alias("chosen"),
        ),
    )


def arbitrated(df: DataFrame, arbiter: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The chosen row as the arbiter's decisions leave it."""
    keys = ["episode_id", "block_id"]
    chosen = df.select(
        *keys, F.col("__x.chosen.source").alias("selected_source"), F.col("__x.chosen.text").alias("final_text"), F.col("__x.chosen.local").alias("selected_score"),
        "risk_flags", "qwen_apple_difference_type", *[f"{s}_text" for s in tb.SOURCES],
    )
    done = arbiter(chosen).select(*keys, F.col("selected_source").alias("__s"), F.col("final_text").alias("__t"), F.col("method").alias("__m"))
    df = df.join(done, keys, "left")
    held = F.col("__x.chosen")
    moved = F.when(F.col("__m").isin("kept", "rejected") | F.col("__m").isNull(), held).otherwise(
        held.withField("source", F.col("__s")).withField("text", F.col("__t")).withField("norm", tx.match_norm(F.col("__t")))
    )
    return cut(df.withColumn("__x", F.col("__x").withField("chosen", moved)).drop("__s", "__t"))


def selected(flagged: DataFrame, arbiter: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Scores, choice, downgrade of a cut primary text, arbitration if asked for, and switch away from error phrases.

    Each step is written once: the steps look back at each other's columns so often that one
    nested plan would grow beyond use.
    """
    df = cut(flagged.withColumn("__list", candidate_list()))
    ranked = tx.let(F.struct(F.col("__list").alias("list"), best_of(F.col("__list")).alias("top")), downgraded)
    df = cut(df.withColumn("__x", ranked).drop("__list"))
    df = arbitrated(df, arbiter) if arbiter else df.withColumn("__m", F.lit(None).cast("string"))
    bad = tx.has_error_phrase(F.col("__x.chosen.text"))
    size = F.greatest(F.length("__x.chosen.text"), F.lit(1))
    ratios = []
    for i, s in enumerate(tb.SOURCE_PRIORITY):
        own = F.get("__x.list", F.lit(i))
        fits = bad & (F.length(own["text"]) > 0) & ~tx.has_error_phrase(own["text"]) & (F.length(own["text"]) / size).between(0.65, 1.45) & (own["local"] >= 0.70)
        # the ratio is taken only for rows that can still switch
        df = df.withColumn(f"__r{i}", sm.sequence_ratio(F.when(fits, F.col("__x.chosen.norm")), F.when(fits, own["norm"])))
        ratios.append(F.when(F.col(f"__r{i}") >= 0.78, F.struct((0.75 * F.col(f"__r{i}") + 0.25 * own["local"]).alias("v"), F.lit(s).alias("s"), own.alias("c"))))
    switch = best_of(F.array_compact(F.array(*ratios)))
    df = df.withColumn("__pick", F.coalesce(switch["c"], F.col("__x.chosen")))
    moved = F.col("__pick.source") != F.col("__x.chosen.source")
    method = F.when(moved, "deterministic_domain_error_avoidance").when(~F.col("__m").isin("kept", "rejected"), F.col("__m")).when(F.col("__x.chosen.source") != F.col("__x.top.source"), "deterministic_qwen_downgraded").otherwise("deterministic_ranked")
    df = df.select(
        *[c for c in flagged.columns],
        F.col("__x.top.source").alias("ranked_source"),
        F.col("__x.top.text").alias("ranked_text"),
        F.col("__x.top.rank").alias("confidence"),
        F.col("__pick.source").alias("selected_source"),
        F.col("__pick.text").alias("selected_text"),
        method.alias("selection_method"),
    )
    return df


# --- edge cleanup

_LEAD, _TAIL = re.compile(tb.LEADING_FRAGMENT), re.compile(tb.TRAILING_FRAGMENT)


def _shed(text: str, hinted: bool, neighbours: tuple[str, str], front: bool) -> tuple[str, bool]:
    """Text less the shortest edge fragment that repeats a neighbour's edge, and whether a protected start stood in the way."""
    guarded = front and text.startswith(tb.PROTECTED_PREFIXES)
    if guarded or len(text) < 3:
        return text, guarded
    for n in range(1, min(6, len(text) - 1) + 1):
        piece, rest = (text[:n], text[n:]) if front else (text[-n:], text[:-n])
        if len(rest) < 3:
            break
        if front and rest.startswith(tb.PROTECTED_PREFIXES):
            guarded = True
            continue
        meets = any(x.endswith(piece) if front else x.startswith(piece) for x in neighbours)
        if meets or (hinted and n <= 3 and (_LEAD.match(piece) if front else _TAIL.search(piece))):
            return rest, guarded
    return text, guarded


def clean_edges(text: str, source: str, hinted: bool, before: tuple[str, str], after: tuple[str, str]) -> dict[str, Any]:
    """Cleaned text and what happened; the anchor's own and empty texts stay as they are."""
    out = {"clean_text": text, "reasons": [], "attempted": False, "failed": False, "guarded": False}
    if not text or source == tb.ANCHOR:
        return out
    front, guarded = _shed(text, hinted, before, True)
    both, _ = _shed(front, hinted, after, False)
    failed = both.startswith(tb.BAD_PREFIXES) or both.endswith(tb.BAD_SUFFIXES) or bool(_LEAD.match(both[:4])) or bool(_TAIL.search(both[-4:]))
    reasons = [r for r, x, y in (("leading_fragment_removed", text, front), ("trailing_fragment_removed", front, both)) if x != y]
    return {"clean_text": text if failed else both, "reasons": [] if failed else reasons, "attempted": both != text, "failed": failed, "guarded": guarded}


def correct(text: str) -> str:
    """The ordered corrections on a plain string (T14), for the text the next row looks back at."""
    for wrong, right in tb.CORRECTIONS:
        text = text.replace(wrong, right)
    return text


def _cleanup(rows: pd.DataFrame, state: Any) -> tuple[pd.DataFrame, Any]:
    final, chosen = (state["final"], state["chosen"]) if state else ("", "")
    out = []
    for r in rows.itertuples(index=False):
        done = clean_edges(r.selected_text or "", r.selected_source or "", bool(r.hinted), (final, chosen), (r.next_text or "", r.next_text or ""))
        out.append({"block_id": r.block_id, **done})
        final, chosen = correct(done["clean_text"]), r.selected_text or ""
    return pd.DataFrame(out), {"final": final, "chosen": chosen}


CLEANED = "block_id string, clean_text string, reasons array<string>, attempted boolean, failed boolean, guarded boolean"


def cleaned(df: DataFrame, hinted: DataFrame, width: float = BLOCK_SECONDS) -> DataFrame:
    """Edge cleanup over the blocks of each episode in time order (R14 with W1 and W2).

    hinted: episode_id, block_id of blocks that hold a short-response hint.
    """
    slim = df.select("episode_id", "block_id", zero(F.col("start_sec")).alias("start_sec"), "selected_source", "selected_text", "ranked_text")
    slim = slim.join(hinted.select("episode_id", "block_id", F.lit(True).alias("hinted")).distinct(), ["episode_id", "block_id"], "left").fillna(False, ["hinted"])
    order = ["start_sec", "block_id"]
    slim = od.carry_last(od.with_blocks(slim, "start_sec", width), ["episode_id"], order, F.col("ranked_text"), "next_text", ahead=True)
    return od.forgetful_fold(slim, ["episode_id"], order, _cleanup, CLEANED, "struct<final:string,chosen:string>", width)


def final_blocks(
    flagged: DataFrame, units: DataFrame, punctuate: bool = True, width: float = BLOCK_SECONDS, arbiter: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The final text of every block: chosen, cleaned, corrected, displayed, flagged, times clamped."""
    # read by the cleanup fold and by what follows it
    df = cut(selected(flagged, arbiter))
    hinted = (
        df.select("episode_id", "block_id", F.explode("sentence_ids").alias("sentence_id"))
        .join(units.where(F.exists("boundary_hints", lambda h: h["type"] == tb.HINT_TYPE)).select("episode_id", "sentence_id"), ["episode_id", "sentence_id"])
        .select("episode_id", "block_id")
    )
    df = df.join(cleaned(df, hinted, width), ["episode_id", "block_id"]).withColumn("fixed", tx.corrected(F.col("clean_text")))
    df = cut(df.withColumn("final_text", F.col("fixed.text")).withColumn("corrections", F.col("fixed.applied")).drop("fixed"))
    base = F.when(F.length("final_text") > 0, F.col("final_text")).otherwise(tx.first_filled(F.col("selected_text"), F.col(f"{tb.ANCHOR}_text"), default=""))
    shown = tx.conversation_display(base) if punctuate else F.struct(base.alias("display_text"), F.lit(0).alias("inserted_period_count"))
    df = df.withColumn("shown", shown).withColumn("final_text_display", F.col("shown.display_text")).withColumn("inserted_period_count", F.col("shown.inserted_period_count"))
    df = df.withColumn("unusual_patterns", tx.pattern_hits(F.col("final_text"))).withColumn("unusual_level", tx.pattern_level(F.col("final_text")))
    df = df.withColumn("final_risk_flags", final_flags())
    times = clamp_times(df.select("episode_id", "block_id", zero(F.col("start_sec")).alias("start_sec"), zero(F.col("end_sec")).alias("end_sec")), "episode_id", "block_id", ["start_sec", "block_id"], width)
    df = df.join(times, ["episode_id", "block_id"])
    return df.select(
        "episode_id",
        "block_id",
        "sentence_ids",
        F.col("start_clamped").alias("start_sec"),
        F.col("end_clamped").alias("end_sec"),
        "ranked_source",
        "selected_source",
        "selection_method",
        "confidence",
        "selected_text",
        "clean_text",
        "final_text",
        "final_text_display",
        "inserted_period_count",
        "corrections",
        F.col("reasons").alias("cleanup_reasons"),
        F.col("attempted").alias("cleanup_attempted"),
        F.col("failed").alias("cleanup_reverted"),
        F.col("guarded").alias("cleanup_guarded"),
        "candidate_agreement_score",
        "alignment_quality",
        "qwen_apple_difference_type",
        "qwen_apple_similarity",
        "risk_flags",
        "final_risk_flags",
        "unusual_patterns",
        "unusual_level",
        "needs_review",
    )


def final_flags() -> Column:
    """Flags after selection: drift warnings, unusual patterns, avoided errors, corrections, edges."""
    flags, local = F.col("risk_flags"), local_score(tb.PRIMARY)
    has = lambda f: F.array_contains(flags, f)
    mild = has("large_span_drift") & (local >= 0.90) & ~has("span_too_long")
    flags = F.when(mild, F.transform(flags, lambda f: F.when(f == "large_span_drift", "large_span_drift_warning").otherwise(f))).otherwise(flags)
    clean = ~tx.has_error_phrase(F.col("final_text")) & ~tx.has_error_phrase(F.col("final_text_display"))
    edge = tx.suspect_edge(F.col("final_text")) | tx.suspect_edge(F.col("final_text_display"))
    more = (
        ("unusual_final_text_pattern", F.size("unusual_patterns") > 0),
        ("domain_error_avoided", has("domain_error_phrase") & clean),
        ("domain_text_corrected", F.size("corrections") > 0),
        ("boundary_contamination_suspected", edge),
        ("boundary_cleanup_needed", F.col("failed")),
    )
    return F.array_distinct(F.concat(flags, F.array_compact(F.array(*[F.when(no(t), F.lit(n)) for n, t in more]))))


def final_sentences(finals: DataFrame, units: DataFrame) -> DataFrame:
    """One row per sentence of the final blocks, in block and member order."""
    rows = finals.select("episode_id", "block_id", "selected_source", "final_text", "final_risk_flags", F.posexplode("sentence_ids").alias("member_no", "sentence_id"))
    own = units.dropDuplicates(["episode_id", "sentence_id"]).select("episode_id", "sentence_id", "start_sec", "end_sec", "text", "display_text")
    return rows.join(own, ["episode_id", "sentence_id"]).withColumn("display_text", tx.conversation_display(tx.first_filled(F.col("display_text"), F.col("text"), default=""))["display_text"])


def natural_text(text: Column, norm: Column, candidate_norms: list[Column]) -> Column:
    """No unusual pattern, six characters or more without marks, and close (0.88) to some candidate."""
    plain = tx.pattern_level(text).isNull() & (F.length(tx.no_punct(text)) >= 6)
    near = F.lit(False)
    for c in candidate_norms:
        near = near | F.coalesce(sm.sequence_ratio(F.when(plain & (F.length(c) > 0), norm), F.when(plain & (F.length(c) > 0), c)) >= 0.88, F.lit(False))
    return plain & near


def agreement_metrics(df: DataFrame) -> DataFrame:
    """Pairwise ratios of the four texts and what they say together (M6)."""
    pairs = {"apple_whisper": ("apple", "whisper"), "apple_nemotron": ("apple", "nemotron"), "nemotron_whisper": ("nemotron", "whisper"), "qwen_apple": ("qwen", "apple"), "qwen_whisper": ("qwen", "whisper")}
    for name, (a, b) in pairs.items():
        x, y = F.col(f"{a}_norm"), F.col(f"{b}_norm")
        both = (F.length(f"{a}_text") > 0) & (F.length(f"{b}_text") > 0)
        df = df.withColumn(f"{name}_similarity", F.when(both, sm.sequence_ratio(x, y)).otherwise(0.0))
    three = (F.length("apple_text") > 0) & (F.length("nemotron_text") > 0) & (F.length("whisper_text") > 0)
    least = F.when(three, F.least("apple_whisper_similarity", "apple_nemotron_similarity", "nemotron_whisper_similarity")).otherwise(0.0)
    q = F.col("qwen_text")
    tainted = tx.suspect_edge(q) | tx.trailing_cut(q) | (F.col("qwen_apple_similarity") < 0.86) | (F.col("qwen_whisper_similarity") < 0.86)
    return (
        df.withColumn("apple_whisper_agreement_high", F.col("apple_whisper_similarity") >= 0.92)
        .withColumn("apple_nemotron_whisper_agreement_high", least >= 0.90)
        .withColumn("qwen_boundary_tainted", tainted)
    )
