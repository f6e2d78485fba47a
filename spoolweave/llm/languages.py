"""Problem 9: languages of documents and of the stretches inside them.

N-gram filters: one Bloom filter per language, bit-sliced, so that one byte read a hash
function returns all languages that may contain an n-gram. Per sentence and language the
set bits are counted and corrected for the filters' false positives; the corrected shares
decide, and a change of language must be worth its cost (a Viterbi pass over the sentences
of a document), so foreign words inside a sentence change nothing.

The filters are built from at most TRAIN_DOCS labelled documents a language (the smallest
hashes of doc_id). An n-gram belongs to a language if its rate there is at least RATIO of
its best rate, which makes wrong labels in the sample harmless.

Defined cases: null or empty texts, and texts without letters, have no language and no
rows; a language without any labelled document cannot be found; sentences that tell
nothing go with the sentence before (or else after) them; a document delivered again gives
one set of rows; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolweave.functions import charmap as cm

LANGUAGES = ("ja", "en", "de", "fr", "es", "zh", "ko")
TRAIN_DOCS = 300
RATIO = 0.4
SLOT_BITS = 20
#: Cost of a change of language, in n-grams.
SWITCH = 9.0
MIN_GRAMS = 3
#: What a whole text needs for a sure answer.
TELL_SHARE, TELL_LEAD = 0.5, 0.12

#: Other notations of the seven languages.
NOTATIONS = {
    "ja": "ja jp jpn japanese japonais japanisch japonés 日本語",
    "en": "en eng english englisch anglais inglés",
    "de": "de deu ger german deutsch allemand alemán",
    "fr": "fr fra fre french français francais französisch francés",
    "es": "es spa spanish español espanol spanisch espagnol castellano",
    "zh": "zh zho chi cmn chinese mandarin 中文 chinesisch chinois chino",
    "ko": "ko kor korean 한국어 koreanisch coréen coreano",
}


def canonical_label(label: Column) -> Column:
    """The two-letter code a label stands for, its own folded text for another language, null for none."""
    folded = F.lower(F.trim(label))
    base = F.regexp_extract(folded, "^([^-_@. ]+)", 1)
    out = F.when(base == "", F.lit(None))
    for code, names in NOTATIONS.items():
        out = out.when(base.isin(*names.split()), F.lit(code))
    return out.when(base.isin("und", "unknown", "xx", "zxx", "mul", "none", "null", "na", "n/a", "?", "other", "auto"), F.lit(None)).otherwise(base)


SPACE, CUT, MARK = 0x20, 0x0A, 0x2E


@lru_cache(1)
def _class_table() -> np.ndarray:
    """Letters folded; digits and other marks to a space; sentence ends to CUT; dots to MARK."""
    fold, letter = cm.fold_table(True), cm.letter_table()
    table = np.full(cm.SPAN, SPACE, dtype=np.uint32)
    look = cm.look_table()
    for code in range(0x20000):
        if fold[code] != cm.DROP and letter[code] and not chr(code).isdigit():
            table[code] = fold[code]
        elif look[code] == cm.DROP:
            table[code] = cm.DROP
    table[cm.IDEOGRAPHS] = fold[cm.IDEOGRAPHS]
    for ch in "\n\r  。！？!?｡…":
        table[ord(ch)] = CUT
    for ch in ".．":
        table[ord(ch)] = MARK
    table[0] = 0
    return table


_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Grams:
    """N-grams of a batch of texts: their hashes, and the sentence and document they belong to."""

    def __init__(self, texts: list[str]) -> None:
        joined = cm.join(texts)
        if cm.has_jamo(joined) or any(unicodedata.combining(c) for c in set(joined)):
            joined = unicodedata.normalize("NFC", joined)
        codes = _class_table()[cm.codes(joined)]
        codes = codes[codes != cm.DROP]
        # a dot ends a sentence before a space only
        dot = codes == MARK
        ends = dot & (np.concatenate((codes[1:], [SPACE])) == SPACE)
        codes[dot] = SPACE
        codes[ends] = CUT
        is_doc = codes == 0
        is_cut = (codes == CUT) | is_doc
        self.n_docs = len(texts)
        doc = np.cumsum(is_doc)
        sentence = np.cumsum(is_cut)
        letter = ~is_cut & (codes != SPACE)
        plain = codes.copy()
        plain[~letter] = SPACE
        # runs of spaces count as one: drop a space after a space
        keep = letter | np.concatenate(([True], letter[:-1]))
        self.sentence_doc = np.zeros(int(sentence[-1]) + 1 if len(sentence) else 1, np.int64)
        if len(codes):
            self.sentence_doc[sentence] = doc
        self.letters = np.bincount(sentence[letter], minlength=len(self.sentence_doc))
        plain, sent = plain[keep].astype(np.uint64), sentence[keep]
        n = len(plain)
        pad = np.full(3, SPACE, np.uint64)
        p = np.concatenate((plain, pad))
        s = np.concatenate((sent, [-1, -1, -1]))
        with np.errstate(over="ignore"):
            two = (p[:-1] * _A) ^ (p[1:] * _B)
            two = two[: n + 2]
            two = (two ^ (two >> np.uint64(31))) * _A
            four = (two[:n] ^ (two[2 : n + 2] * _B)) * _A
            four ^= four >> np.uint64(33)
        wide = plain >= 0x2E80
        first_letter = plain != SPACE
        hashes = np.where(wide, two[:n] ^ np.uint64(0x5851F42D4C957F2D), four)
        inside2 = s[1 : n + 1] == sent
        inside4 = s[3 : n + 3] == sent
        ok = np.where(wide, inside2 & (p[1 : n + 1] >= 0x2E80), inside4 & (p[1 : n + 1] != SPACE) & (first_letter | (p[2 : n + 2] != SPACE)))
        ok &= np.where(wide, True, (p[1 : n + 1] < 0x2E80) & (p[2 : n + 2] < 0x2E80) & (p[3 : n + 3] < 0x2E80))
        self.hash = hashes[ok]
        self.sentence = sent[ok]


def slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(64 - SLOT_BITS)) & mask).astype(np.int64)


class Filters:
    """Bit-sliced Bloom filters of all languages: two tables with one bit a language in each slot."""

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        self.low, self.high = low, high
        bits = np.arange(len(LANGUAGES))
        #: false positive rate a language: both slots set by chance
        self.false = np.array([((low >> b) & 1).mean() * ((high >> b) & 1).mean() for b in bits])

    def languages(self, h: np.ndarray) -> np.ndarray:
        a, b = slots(h)
        return self.low[a] & self.high[b]

    def counts(self, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, language) corrected counts, and n-grams a sentence."""
        n = len(grams.sentence_doc)
        found = self.languages(grams.hash)
        size = np.bincount(grams.sentence, minlength=n).astype(float)
        out = np.zeros((n, len(LANGUAGES)))
        for b in range(len(LANGUAGES)):
            has = np.bincount(grams.sentence[(found >> b) & 1 == 1], minlength=n)
            out[:, b] = np.maximum(has - self.false[b] * size, 0) / (1 - self.false[b])
        return out, size


    def by_text(self, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        """(text, language) corrected counts, and n-grams a text."""
        if not grams.n_docs:
            return np.zeros((0, len(LANGUAGES))), np.zeros(0)
        counts, size = self.counts(grams)
        total = np.zeros((grams.n_docs, len(LANGUAGES)))
        np.add.at(total, grams.sentence_doc, counts)
        return total, np.bincount(grams.sentence_doc, weights=size, minlength=grams.n_docs)

    def tell(self, grams: Grams) -> np.ndarray:
        """Language of each text as a whole, -1 where it can't be told."""
        return told(*self.by_text(grams))


def told(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The language that holds at least TELL_SHARE of a text's n-grams and leads by TELL_LEAD of them, or -1."""
    if not len(counts):
        return np.zeros(0, np.int64)
    two = np.sort(counts, axis=1)[:, -2:]
    sure = (size >= MIN_GRAMS) & (two[:, 1] >= TELL_SHARE * size) & (two[:, 1] - two[:, 0] >= TELL_LEAD * size)
    return np.where(sure, counts.argmax(axis=1), -1)


def build_filters(rows: list[tuple[str, str]]) -> Filters:
    """Filters from (language, text) rows."""
    rate: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for lang in LANGUAGES:
        texts = [t for k, t in rows if k == lang]
        if not texts:
            continue
        h, n = np.unique(Grams(texts).hash, return_counts=True)
        if len(h):
            rate[lang] = (h, n / n.sum())
    every = np.unique(np.concatenate([h for h, _ in rate.values()])) if rate else np.zeros(0, np.uint64)
    table = np.zeros((len(every), len(LANGUAGES)))
    for lang, (h, r) in rate.items():
        table[np.searchsorted(every, h), LANGUAGES.index(lang)] = r
    member = (table > 0) & (table >= RATIO * table.max(axis=1, keepdims=True)) if len(every) else np.zeros((0, len(LANGUAGES)), bool)
    low = np.zeros(1 << SLOT_BITS, np.uint8)
    high = np.zeros(1 << SLOT_BITS, np.uint8)
    a, b = slots(every)
    for k in range(len(LANGUAGES)):
        np.bitwise_or.at(low, a[member[:, k]], np.uint8(1 << k))
        np.bitwise_or.at(high, b[member[:, k]], np.uint8(1 << k))
    return Filters(low, high)


def training_rows(documents: DataFrame, most: int = TRAIN_DOCS) -> list[tuple[str, str]]:
    """At most ``most`` labelled texts a language: those with the smallest hashes of doc_id."""
    labelled = documents.select("doc_id", "text", canonical_label(F.col("lang")).alias("k")).where(F.col("k").isin(*LANGUAGES) & (F.length("text") > 0))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    counts = {r[0]: r[1] for r in labelled.groupBy("k").count().collect()}
    keep = F.lit(False)
    for k, n in counts.items():
        keep = keep | ((F.col("k") == k) & (spread < int(min(1.0, 1.5 * most / n) * (1 << 30))))
    rows = labelled.where(keep).select("k", "text", spread.alias("s"), "doc_id").orderBy("s", "doc_id").limit(2 * most * len(LANGUAGES)).collect() if counts else []
    taken: dict[str, int] = {}
    out = []
    for r in rows:
        if taken.get(r[0], 0) < most:
            taken[r[0]] = taken.get(r[0], 0) + 1
            out.append((r[0], r[1]))
    return out


def decode(counts: np.ndarray, size: np.ndarray) -> list[int]:
    """Language of each sentence (-1 for none): best path with a cost for each change."""
    best = counts.max(axis=1)
    tells = (size >= MIN_GRAMS) & (best >= 0.3 * size)
    first = counts.argmax(axis=1)
    if not tells.any():
        if size.sum() > 0 and counts.sum() > 0:
            return [int(counts.sum(axis=0).argmax())] * len(size)
        return [-1] * len(size)
    known = first[tells]
    if (known == known[0]).all():
        return [int(known[0])] * len(size)
    gain = np.where(tells[:, None], counts - best[:, None], 0.0)
    score = gain[0].copy()
    back = []
    for row in gain[1:]:
        jump = int(score.argmax())
        move = score[jump] - SWITCH
        stay = score >= move
        back.append(np.where(stay, np.arange(len(score)), jump))
        score = np.maximum(score, move) + row
    at = int(score.argmax())
    path = [at]
    for b in reversed(back):
        at = int(b[at])
        path.append(at)
    return path[::-1]


def _segments(batches: Iterator[pa.RecordBatch], filters: Filters, key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        rows, no, lang, conf, size_out = [], [], [], [], []
        for a, b in cm.groups(texts):
            grams = Grams(texts[a:b])
            counts, size = filters.counts(grams)
            bounds = np.searchsorted(grams.sentence_doc, np.arange(b - a + 1))
            for d in range(b - a):
                lo, hi = int(bounds[d]), int(bounds[d + 1])
                letters = grams.letters[lo:hi]
                if not letters.any():
                    continue
                has = np.flatnonzero(letters)
                c, s = counts[lo:hi][has], size[lo:hi][has]
                path = decode(c, s)
                k = 0
                begin = 0
                for j in range(1, len(path) + 1):
                    if j == len(path) or path[j] != path[begin]:
                        k += 1
                        total, n = c[begin:j].sum(axis=0), s[begin:j].sum()
                        own = path[begin]
                        other = np.delete(total, own).max() if own >= 0 else 0.0
                        rows.append(a + d)
                        no.append(k)
                        lang.append(LANGUAGES[own] if own >= 0 else None)
                        conf.append(float(max(0.0, (total[own] - other) / n)) if own >= 0 and n else 0.0)
                        size_out.append(int(letters[has][begin:j].sum()))
                        begin = j
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(key).take(taken), batch.column("label").take(taken), pa.array(no, pa.int32()), pa.array(lang, pa.string()), pa.array(conf, pa.float64()), pa.array(size_out, pa.int64())],
            names=[key, "label", "seg_no", "seg_lang", "confidence", "letters"],
        )


def language_segments(documents: DataFrame, key: str = "doc_id", train: int = TRAIN_DOCS) -> DataFrame:
    """One row per stretch of one language: key, the label's language, seg_no, seg_lang, confidence, letters."""
    filters = build_filters(training_rows(documents, train))
    slim = documents.select(F.col(key), canonical_label(F.col("lang")).alias("label"), F.col("text").alias("__text")).where(F.length("__text") > 0)
    schema = f"`{key}` {dict(slim.dtypes)[key]}, label string, seg_no int, seg_lang string, confidence double, letters bigint"
    return slim.mapInArrow(lambda it: _segments(it, filters, key), schema)


def document_languages(segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: the language with most letters, its share of them, and its confidence by letters."""
    parts = segments.where("seg_lang is not null").groupBy(key, "seg_lang").agg(F.sum("letters").alias("n"), F.sum(F.col("confidence") * F.col("letters")).alias("w"))
    best = F.max(F.struct("n", "seg_lang", (F.col("w") / F.col("n")).alias("c")))
    rows = parts.groupBy(key).agg(best.alias("b"), F.sum("n").alias("all"), F.count("*").alias("languages"))
    return rows.select(key, F.col("b.seg_lang").alias("lang"), F.col("b.c").alias("confidence"), (F.col("b.n") / F.col("all")).alias("share"), "languages")


def mislabelled(documents: DataFrame, key: str = "doc_id", train: int = TRAIN_DOCS) -> DataFrame:
    """The stretches of documents without a label, with a wrong one, or in several languages."""
    filters = build_filters(training_rows(documents, train))
    slim = documents.select(F.col(key), canonical_label(F.col("lang")).alias("label"), F.col("text").alias("__text")).where(F.length("__text") > 0)
    schema = f"`{key}` {dict(slim.dtypes)[key]}, seg_no int, seg_lang string"

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in _segments(batches, filters, key):
            no, lang, label = (out.column(c).to_pylist() for c in ("seg_no", "seg_lang", "label"))
            first = 0
            keep: list[int] = []
            for i in range(1, len(no) + 1):
                if i == len(no) or no[i] == 1:
                    if i - first > 1 or label[first] != lang[first]:
                        keep += range(first, i)
                    first = i
            yield out.take(pa.array(keep, pa.int64())).select([key, "seg_no", "seg_lang"])

    return slim.mapInArrow(flag, schema).where("seg_lang is not null").distinct()
