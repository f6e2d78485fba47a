"""Text functions on columns.

All but Unicode normalisation are built-in expressions, so they stay inside generated code;
normalisation has no built-in and is an Arrow function with a table look-up per character.
Null text counts as empty where a text comes out, and gives no tokens or hints.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolweave.functions import tables as tb

#: Python counts the four information separators as white space, Java does not.
WS = "\\s\\x1c-\\x1f"
BLANK = f"(?U)^[{WS}]*$"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Both ends without white space of any kind."""
    return F.regexp_replace(c, f"(?U)^[{WS}]+|[{WS}]+$", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^[{WS}]+", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)[{WS}]+$", "")


def is_blank(c: Column) -> Column:
    return text_or_empty(c).rlike(BLANK)


def starts_with_any(c: Column, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, p: a | c.startswith(p), prefixes, F.lit(False))


def ends_with_any(c: Column, suffixes: Sequence[str]) -> Column:
    return reduce(lambda a, p: a | c.endswith(p), suffixes, F.lit(False))


def contains_any(c: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, p: a | c.contains(p), parts, F.lit(False))


# --- Unicode normalisation


class _Spellings(dict):
    """Code point -> folded characters it becomes, filled as characters come up."""

    def __init__(self, spaces: bool) -> None:
        super().__init__()
        self.spaces = spaces

    def __missing__(self, code: int) -> str:
        out = []
        for ch in unicodedata.normalize("NFKC", chr(code)).casefold():
            if ch.isspace():
                if self.spaces:
                    out.append(" ")
            elif self.spaces or unicodedata.category(ch)[0] not in "PS":
                out.append(ch)
        self[code] = "".join(out)
        return self[code]


_MATCH, _DISPLAY = _Spellings(False), _Spellings(True)
_SPACES = re.compile(" +")


def nfc_value(text: str) -> str:
    return unicodedata.normalize("NFC", text)


def match_value(text: str) -> str:
    """Folded text without spaces, punctuation and symbols."""
    return nfc_value(text).translate(_MATCH)


def display_value(text: str) -> str:
    """Folded text with punctuation kept and runs of white space as one space."""
    return _SPACES.sub(" ", nfc_value(text).translate(_DISPLAY))


def raw_index_value(text: str) -> np.ndarray:
    """For each character of the match text, the position of its origin in the composed text."""
    raw = nfc_value(text)
    size = {c: len(_MATCH[ord(c)]) for c in set(raw)}
    sizes = np.fromiter(map(size.__getitem__, raw), dtype=np.int64, count=len(raw))
    return np.repeat(np.arange(len(raw)), sizes)


def _string_udf(fn):
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([fn(x) if x is not None else None for x in s], dtype=object)

    return run


nfc = _string_udf(nfc_value)
match_norm = _string_udf(match_value)
display_norm = _string_udf(display_value)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def raw_index(s: pd.Series) -> pd.Series:
    return pd.Series([raw_index_value(x).astype("int32") if x is not None else None for x in s])


def text_artifact(raw: Column) -> list[Column]:
    """Composed, display and match text and the match-to-raw index of a text."""
    return [nfc(raw).alias("raw_text"), display_norm(raw).alias("display_norm_text"), match_norm(raw).alias("match_norm_text"), raw_index(raw).alias("raw_index")]


def raw_span(index: Column, start: Column, end: Column) -> Column:
    """Raw (start, end) of a span of match characters; (0, 0) where it is empty or outside (T5)."""
    lo, hi = F.greatest(start, F.lit(0)), F.least(end, F.size(index))
    inside = (F.size(index) > 0) & (lo < hi)
    zero = F.lit(0)
    return F.struct(
        F.when(inside, F.get(index, lo)).otherwise(zero).cast("int").alias("start"),
        F.when(inside, F.get(index, hi - 1) + 1).otherwise(zero).cast("int").alias("end"),
    )


def norm_span(index: Column, start: Column, end: Column) -> Column:
    """Match (start, end) of the characters whose origin lies in raw [start, end)."""
    below = F.size(F.filter(index, lambda i: i < start))
    upto = F.size(F.filter(index, lambda i: i < end))
    some = upto > below
    return F.struct(F.when(some, below).otherwise(0).alias("start"), F.when(some, upto).otherwise(0).alias("end"))


def surface_norm(norm: Column) -> Column:
    """Match text with spelling variants made one, for surface comparison."""
    out = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), tb.SURFACE_SPELLINGS, norm)
    out = F.regexp_replace(out, f"(?U)[。、，,．.{WS}]+", "")
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), tb.SURFACE_LATE, out)


def anchor_norm(c: Column) -> Column:
    """Without white space and sentence punctuation."""
    return F.regexp_replace(text_or_empty(c), f"(?U)[{WS}、。，．,.!?！？]+", "")


def no_punct(c: Column) -> Column:
    """Without white space, punctuation, brackets and dashes."""
    return F.regexp_replace(text_or_empty(c), f"(?U)[{WS}、。，．,.!?！？「」『』（）()\\-‐‑‒–—…]+", "")


# --- tokens and terms


def numbers(c: Column) -> Column:
    """Distinct numbers in any digits, with one decimal part."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text_or_empty(c), F.lit("(?U)(\\d+(?:[.,]\\d+)?)"), 1)))


def digit_runs(c: Column) -> Column:
    """Distinct runs of ASCII or full-width digits (the other number test of T9)."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text_or_empty(c), F.lit("([0-9０-９]+)"), 1)))


def tokens(c: Column) -> Column:
    """Number, latin, katakana and kanji token sets."""

    def found(pattern: str) -> Column:
        return F.array_sort(F.array_distinct(F.regexp_extract_all(text_or_empty(c), F.lit(pattern), 1)))

    return F.struct(
        numbers(c).alias("numbers"),
        found("([A-Za-z]{2,})").alias("latin"),
        found("([\\x{30A0}-\\x{30FF}ー]{2,})").alias("katakana"),
        found("([\\x{4E00}-\\x{9FFF}]{2,4})").alias("kanji"),
    )


def terms_in(norm: Column, aliases: dict[str, Sequence[str]] | None = None) -> Column:
    """Canonical terms of which an alias occurs in the match text."""
    found = [
        F.when(contains_any(norm, [m for m in map(match_value, names) if m]), F.lit(term)) for term, names in (aliases or tb.TERM_ALIASES).items()
    ]
    return F.array_sort(F.array_compact(F.array(*found)))


def raw_terms(c: Column, terms: Sequence[str], aliases: dict[str, Sequence[str]] | None = None) -> Column:
    """Terms of which an alias occurs in the text as it stands."""
    aliases = aliases or {}
    found = [F.when(contains_any(text_or_empty(c), aliases.get(t, (t,))), F.lit(t)) for t in terms]
    return F.array_sort(F.array_compact(F.array(*found)))


def suspect_edge(c: Column, prefixes: Sequence[str] = tb.SUSPECT_PREFIXES, suffixes: Sequence[str] = tb.SUSPECT_SUFFIXES) -> Column:
    """Starts or ends like the rest of a neighbour's sentence."""
    return let(strip(text_or_empty(c)), lambda s: starts_with_any(s, prefixes) | ends_with_any(s, suffixes))


def has_error_phrase(c: Column, phrases: Sequence[str] = tb.ERROR_PHRASES) -> Column:
    return contains_any(text_or_empty(c), phrases)


def phrase_counts(c: Column, phrases: Sequence[str] = tb.ERROR_PHRASES) -> Column:
    """Map of phrase to non-overlapping count, phrases that occur only."""
    t = text_or_empty(c)
    entries = [F.struct(F.lit(p).alias("k"), ((F.length(t) - F.length(F.replace(t, F.lit(p), F.lit("")))) / len(p)).cast("int").alias("n")) for p in phrases]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["n"] > 0))


def corrected(c: Column, rules: Sequence[tuple[str, str]] = tb.CORRECTIONS) -> Column:
    """Ordered replacements, each seeing the result of those before, and the rules that applied."""
    steps = F.array(*[F.struct(F.lit(a).alias("from"), F.lit(b).alias("to")) for a, b in rules])
    zero = F.struct(text_or_empty(c).alias("text"), F.array().cast("array<struct<from:string,to:string>>").alias("applied"))
    return F.aggregate(
        steps,
        zero,
        lambda acc, r: F.when(
            acc["text"].contains(r["from"]), F.struct(F.replace(acc["text"], r["from"], r["to"]).alias("text"), F.array_append(acc["applied"], r).alias("applied"))
        ).otherwise(acc),
    )


# --- short responses


def _by_length(parts: Sequence[str]) -> list[str]:
    return sorted(parts, key=len, reverse=True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once for a body that uses it often; keeps nested expressions small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first_match(t: Column, tests: Sequence[tuple[str, Callable[[Column, str], Column]]]) -> Column:
    """The first part whose test holds for the text, or null."""
    return reduce(lambda acc, x: acc.when(x[1](t, x[0]), F.lit(x[0])), tests, F.when(F.lit(False), F.lit("")))


_HINTS = "array<struct<type:string,char_pos_in_raw:int,token:string,insert:string,reason:string,confidence:double,applies_to:array<string>>>"


def boundary_hint(c: Column, prefixes: Sequence[str] = tb.SHORT_RESPONSES) -> Column:
    """Struct of boundary_text and boundary_hints: a full stop after a leading short response.

    The longest response that starts the text and is shorter than it decides; one comma or
    space after it is dropped; nothing is put in where a mark stands already.
    """
    tests = [(p, lambda t, p: t.startswith(p) & (F.length(t) > len(p))) for p in _by_length(prefixes)]

    def parts(x: Column) -> Column:
        after = F.substring(x["t"], F.length(x["p"]) + 1, F.length(x["t"]))
        return F.struct(x["t"].alias("t"), x["p"].alias("p"), F.regexp_replace(after, "^[、， 　]", "").alias("r"))

    def put(x: Column) -> Column:
        fits = x["p"].isNotNull() & (F.length(x["r"]) > 0) & ~F.substring(x["r"], 1, 1).isin(*"。、!?！？")
        return F.struct(x["t"].alias("t"), x["p"].alias("p"), x["r"].alias("r"), F.coalesce(fits, F.lit(False)).alias("put"))

    def shown(x: Column) -> Column:
        text = F.when(x["put"], F.concat(x["p"], F.lit("。"), lstrip(x["r"]))).otherwise(x["t"])
        hint = F.struct(
            F.lit(tb.HINT_TYPE).alias("type"),
            F.length(x["p"]).alias("char_pos_in_raw"),
            x["p"].alias("token"),
            F.lit("。").alias("insert"),
            F.lit(tb.HINT_REASON).alias("reason"),
            F.lit(tb.HINT_CONFIDENCE).alias("confidence"),
            F.array(*map(F.lit, tb.HINT_APPLIES)).alias("applies_to"),
        )
        hints = F.when(x["put"], F.array(hint)).otherwise(F.array().cast(_HINTS))
        return F.struct(x["t"].alias("raw_text"), x["t"].alias("alignment_text"), text.alias("boundary_text"), text.alias("display_text"), hints.alias("boundary_hints"))

    start = let(text_or_empty(c), lambda t: F.struct(t.alias("t"), first_match(t, tests).alias("p")))
    return let(let(let(start, parts), put), shown)


def conversation_display(c: Column, prefixes: Sequence[str] = tb.SHORT_RESPONSES, phrases: Sequence[tuple[str, str]] = tb.PHRASE_BOUNDARIES) -> Column:
    """Display text with full stops after short responses and at known phrase boundaries, and counts."""
    rules = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in phrases])

    def times(t: Column, part: Column) -> Column:
        return ((F.length(t) - F.length(F.replace(t, part, F.lit("")))) / F.length(part)).cast("int")

    def step(acc: Column, r: Column) -> Column:
        changed = F.replace(acc["display_text"], r["a"], r["b"])
        return F.when(
            acc["display_text"].contains(r["a"]),
            F.struct(
                changed.alias("display_text"),
                (acc["inserted_period_count"] + times(changed, r["b"]) - times(acc["display_text"], r["b"])).alias("inserted_period_count"),
                acc["short_response_period_count"].alias("short_response_period_count"),
                (acc["boundary_hint_used_count"] + 1).alias("boundary_hint_used_count"),
            ),
        ).otherwise(acc)

    def fold(h: Column) -> Column:
        n = F.size(h["boundary_hints"])
        start = F.struct(h["display_text"].alias("display_text"), n.alias("inserted_period_count"), n.alias("short_response_period_count"), n.alias("boundary_hint_used_count"))
        return F.aggregate(rules, start, step)

    return let(boundary_hint(c, prefixes), fold)


# --- fragments and patterns


def fragment_suggestion(c: Column, anchor: Column) -> Column:
    """Suggested text without a leading or trailing fragment of a neighbour, and why."""
    leads = [(p, lambda x, p: x["t"].startswith(p) & ~x["a"].startswith(p)) for p in tb.LEADING_SUGGESTIONS]
    tails = [(p, lambda x, p: x["t"].endswith(p)) for p in tb.TRAILING_FRAGMENTS]

    def front(x: Column) -> Column:
        return let(
            F.struct(x["t"].alias("t"), first_match(x, leads).alias("p")),
            lambda y: let(
                F.struct(y["t"].alias("t"), lstrip(F.substring(y["t"], F.length(y["p"]) + 1, F.length(y["t"]))).alias("cut")),
                lambda z: _shorter(z, F.coalesce((F.length(z["cut"]) >= 3) & ~starts_with_any(z["cut"], tb.BAD_PREFIXES), F.lit(False))),
            ),
        )

    def back(x: Column) -> Column:
        return let(
            F.struct(x["t"].alias("t"), first_match(x, tails).alias("p")),
            lambda y: let(
                F.struct(y["t"].alias("t"), rstrip(F.substring(y["t"], F.lit(1), F.length(y["t"]) - F.length(y["p"]))).alias("cut")),
                lambda z: _shorter(z, F.coalesce((F.length(z["cut"]) >= 3) & ~ends_with_any(z["cut"], tb.BAD_SUFFIXES), F.lit(False))),
            ),
        )

    def both(f: Column) -> Column:
        return let(
            back(f),
            lambda g: F.struct(
                g["t"].alias("text"),
                F.array_compact(F.array(F.when(f["cut"], F.lit("leading_boundary_fragment_suggested")), F.when(g["cut"], F.lit("trailing_boundary_fragment_suggested")))).alias("reasons"),
            ),
        )

    start = F.struct(text_or_empty(c).alias("t"), text_or_empty(anchor).alias("a"))
    return let(let(start, front), both)


def _shorter(z: Column, good: Column) -> Column:
    return F.struct(F.when(good, z["cut"]).otherwise(z["t"]).alias("t"), good.alias("cut"))


def trailing_cut(c: Column) -> Column:
    """Ends like a sentence cut off."""
    return let(
        strip(text_or_empty(c)),
        lambda s: (F.length(s) > 0) & (F.right(s, F.lit(4)).rlike(tb.TRAILING_FRAGMENT) | ends_with_any(s, tb.TRAILING_FRAGMENTS)),
    )


def pattern_hits(c: Column, hard: Sequence[str] = tb.HARD_PATTERNS, soft: Sequence[str] = tb.SOFT_PATTERNS, width: int = tb.PATTERN_CONTEXT) -> Column:
    """First hit of each unusual pattern with its context and severity."""
    def hit(t: Column, pattern: str, severity: str) -> Column:
        at = F.position(F.lit(pattern), t)  # 1-based
        begin = F.greatest(at - 1 - width, F.lit(0))
        return F.when(
            at > 0,
            F.struct(
                F.lit(pattern).alias("pattern_id"),
                F.lit(pattern).alias("matched_text"),
                F.substring(t, begin + 1, at - 1 + len(pattern) + width - begin).alias("context"),
                F.lit(severity).alias("severity"),
            ),
        )

    every = [*((p, "human_required") for p in hard), *((p, "machine_note") for p in soft)]
    # blank text holds no pattern, so it needs no case of its own
    return let(text_or_empty(c), lambda t: F.array_compact(F.array(*[hit(t, p, s) for p, s in every])))


def pattern_level(c: Column, hard: Sequence[str] = tb.HARD_PATTERNS, soft: Sequence[str] = tb.SOFT_PATTERNS) -> Column:
    """Level of the worst unusual pattern, null for none; empty text is at the worst level."""
    return let(
        strip(text_or_empty(c)),
        lambda s: F.when((s == "") | contains_any(s, hard), "human_required").when(
            contains_any(s, soft) | starts_with_any(s, ("、", "。")) | ends_with_any(s, tb.BAD_SUFFIXES), "machine_note"
        ),
    )


# --- character classes (T21), hashes (T23), fallbacks

JA_WORD = "[\\x{3040}-\\x{30FF}\\x{4E00}-\\x{9FFF}々ー]"


def japanese_word_runs(c: Column) -> Column:
    """Runs of Japanese word characters."""
    return F.regexp_extract_all(text_or_empty(c), F.lit(f"({JA_WORD}+)"), 1)


def stable_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def canonical_json(value: object) -> str:
    """Sorted keys, compact, characters as they are."""
    import json

    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def first_filled(*columns: Column, default: str | None = None) -> Column:
    """The first text that is not blank."""
    out = F.coalesce(*[F.when(~is_blank(c), c) for c in columns])
    return F.coalesce(out, F.lit(default)) if default is not None else out


def reason_list(c: Column) -> Column:
    """Reasons as a list: null as empty."""
    return F.coalesce(c, F.array().cast("array<string>"))
