"""Problem 3: one consistent form for texts that look the same.

Per text: invisible characters go, spaces and widths and one-character compatibility forms
(of all planes) become one, the rest is composed (NFC). Then letters that are drawn alike
across scripts are resolved: each such letter belongs to a class with a spelling per script,
with or without accents. The script sets of a token's letters are intersected; a token of
one possible script is spelled in it, a token of several (a whole-script confusable) in the
one most tokens of its sentence, or else of the text, are surely of, Latin first among
equals. Letters shared by kana and kanji take the script of the letters they stand among.

Spelling depends only on the classes of the letters, so texts that look the same get the
same form and no others do. The classes written here are fixed values; unicode_classes adds
those of the public Unicode confusables data that Spark's own ICU library holds.

Defined cases: null or empty texts have no form and no pairs; texts under 20 letters and
digits are left out of the pairs; equal code points make no pair; a redelivered row counts
once; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolweave.functions import charmap as cm
from spoolweave.session import cut

MIN_LETTERS = 20

# Letters drawn alike, target first. Latin targets, then the letters of
# Cyrillic, Greek, Armenian and the phonetic letters that share their shape.
LATIN_ALIKE = {
    "a": "аαɑ", "b": "Ьƅ", "c": "сϲᴄ", "d": "ԁ", "e": "еҽ", "g": "ɡցɢ", "h": "һհ", "i": "іιɩ", "j": "јյϳ", "k": "ᴋ", "l": "ӏ", "n": "ոո",
    "o": "оοօσᴏ", "p": "рρ", "q": "ԛզգ", "s": "ѕꜱ", "u": "սυᴜ", "v": "ѵνᴠ", "w": "ԝաᴡ", "x": "х", "y": "уүγʏ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "L": "Լ", "M": "МΜϺ", "N": "Ν",
    "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "S": "ЅՏ", "T": "ТΤ", "U": "Ս", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
}
# Katakana first, then the kanji of the same shape; hiragana where it shares one with katakana.
CJK_ALIKE = {
    "ロ": "口囗", "ニ": "二", "カ": "力", "エ": "工", "タ": "夕", "ト": "卜", "ハ": "八", "チ": "千", "ー": "一", "ノ": "丿", "ヌ": "又",
    "ム": "厶", "メ": "乂", "ヒ": "匕", "オ": "才", "ミ": "彡", "ヨ": "彐", "ホ": "朩",
    "ヘ": "へ", "ベ": "べ", "ペ": "ぺ", "リ": "り",
}
HIRAGANA_ALIKE = "へべぺり"


#: Letters beyond those above that share the shape of a Latin one: (code point, Latin letter's) pairs.
Classes = tuple[tuple[int, int], ...]


def unicode_classes(spark: SparkSession) -> Classes:
    """Letters of other alphabets that the Unicode confusables data draws like one Latin letter of the same case.

    Asked once on the driver, of the ICU library among Spark's own jars. Without its data pairs
    would be missing and the rest look whole, so a library that cannot be asked is an error.
    """
    latin = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    known = {o for others in (*LATIN_ALIKE.values(), *CJK_ALIKE.values()) for o in others} | set(CJK_ALIKE)
    others = [c for c in map(chr, range(0x250, 0x20000)) if ANY_FOREIGN.match(c) and unicodedata.category(c)[0] == "L" and c not in known and unicodedata.normalize("NFKC", c) == c]
    try:
        checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        shapes = checker.getSkeleton("\n".join((*latin, *others))).split("\n")
    except Exception as error:
        raise RuntimeError("the Unicode confusables data cannot be read: no com.ibm.icu.text.SpoofChecker answers in Spark's JVM") from error
    if len(shapes) != len(latin) + len(others):
        raise RuntimeError(f"the ICU library gave {len(shapes)} shapes for {len(latin) + len(others)} letters")
    by_shape: dict[tuple[str, bool], str] = {}
    for c, shape in zip(latin, shapes, strict=False):
        by_shape.setdefault((shape, c.isupper()), c)
    found = [(c, by_shape.get((shape, c.isupper()))) for c, shape in zip(others, shapes[len(latin) :], strict=True)]
    classes = tuple((ord(c), ord(to)) for c, to in found if to)
    if not classes:
        raise RuntimeError("the ICU library holds no confusables data: no letter shares its shape with a Latin one")
    return classes


@lru_cache(4)
def skeleton_table(classes: Classes = ()) -> np.ndarray:
    """Letter to the first letter of its class."""
    table = np.arange(cm.SPAN, dtype=np.uint32)
    for code, to in classes:
        table[code] = to
    for rep, others in (*LATIN_ALIKE.items(), *CJK_ALIKE.items()):
        for o in others:
            table[ord(o)] = ord(rep)
    return table


# script codes for neighbours of shared letters
NONE, KATA, HIRA, HAN, SHARED = 0, 1, 2, 3, 4


@lru_cache(1)
def script_table() -> np.ndarray:
    table = np.zeros(cm.SPAN, dtype=np.uint8)
    table[0x30A1:0x30FB] = KATA
    table[0x31F0:0x3200] = KATA
    table[0x3041:0x3097] = HIRA
    table[0x3400:0xA000] = HAN
    table[0x3005:0x3008] = HAN
    for rep in CJK_ALIKE:
        table[ord(rep)] = SHARED
    return table


@lru_cache(1)
def spellings() -> dict[str, np.ndarray]:
    """Class letter to its spelling by script, for letters that kana and kanji share."""
    size = 0x3100
    han = np.zeros(size, dtype=np.uint32)
    hira = np.zeros(size, dtype=np.uint32)
    for rep, others in CJK_ALIKE.items():
        if others[0] in HIRAGANA_ALIKE:
            hira[ord(rep)] = ord(others[0])
        else:
            han[ord(rep)] = ord(others[0])
    return {"han": han, "hira": hira}


def spell_cjk(codes: np.ndarray) -> np.ndarray:
    """Spell shared letters by the nearest decided letter of the same token, left before right."""
    script = script_table()[codes]
    shared = np.flatnonzero(script == SHARED)
    if not len(shared):
        return codes
    n = len(codes)
    decided = script != SHARED
    left = np.where(decided, np.arange(n), -1)
    np.maximum.accumulate(left, out=left)
    right = np.where(decided, np.arange(n), n)
    right = np.minimum.accumulate(right[::-1])[::-1]
    l_script = np.where(left[shared] >= 0, script[np.maximum(left[shared], 0)], NONE)
    r_script = np.where(right[shared] < n, script[np.minimum(right[shared], n - 1)], NONE)
    rep = codes[shared]
    table = spellings()
    # sets of the class: katakana with hiragana, or katakana with kanji
    with_hira = table["hira"][rep] > 0
    other = np.where(with_hira, table["hira"][rep], table["han"][rep])
    # within katakana a shared letter is katakana; else the other script of its class
    take_other = np.where(with_hira, (l_script != KATA) & ~((l_script == NONE) & (r_script == KATA)), (l_script != KATA) & (r_script != KATA) & ((l_script != NONE) | (r_script != NONE)))
    long_mark = rep == 0x30FC
    take_other = np.where(long_mark, (l_script == HAN) | (l_script != KATA) & (r_script == HAN) | (l_script == NONE) & (r_script == HIRA), take_other)
    out = codes.copy()
    out[shared] = np.where(take_other, other, rep)
    return out


#: Alphabets whose tokens keep their script; others give way to Latin where a letter is drawn like a Latin one.
SCRIPT_NAMES = ("Cyrillic", "Greek", "Armenian", "Coptic", "Cherokee", "Georgian")
SCRIPTS = tuple((name, regex.compile(f"\\p{{{name}}}")) for name in SCRIPT_NAMES)
FOREIGN = regex.compile("[" + "".join(f"\\p{{{n}}}" for n in SCRIPT_NAMES) + "]")
ANY_FOREIGN = regex.compile("(?![\\p{Latin}\\p{Han}\\p{Hiragana}\\p{Katakana}\\p{Hangul}\\p{Common}\\p{Inherited}])\\p{L}")
WORD = regex.compile("[\\p{L}\\p{M}]+")
SENTENCE = regex.compile("[^.!?。！？\n]+|[.!?。！？\n]+")
MARKED = regex.compile("\\p{Mn}")


@lru_cache(4)
def _by_script(classes: Classes = ()) -> dict[str, dict[str, str]]:
    """Script -> Latin class letter -> its letter in that script."""
    out: dict[str, dict[str, str]] = {name: {} for name in SCRIPT_NAMES}
    pairs = [(rep, o) for rep, others in LATIN_ALIKE.items() for o in others] + [(chr(to), chr(c)) for c, to in classes]
    for rep, o in pairs:
        for name, pattern in SCRIPTS:
            if pattern.match(o):
                out[name].setdefault(rep, o)
    return out


@lru_cache(4)
def _accented(classes: Classes = ()) -> dict[int, str]:
    """Accented letters of other alphabets to letter and accent, where the bare letter is in a class."""
    table = skeleton_table(classes)
    out = {}
    for c in (*range(0x370, 0x600), *range(0x1F00, 0x2000)):
        parts = unicodedata.normalize("NFD", chr(c))
        if len(parts) > 1 and table[ord(parts[0])] != ord(parts[0]):
            out[c] = parts
    return out


ACCENTED = regex.compile("[\u0370-\u05ff\u1f00-\u1fff]")


def script_sets(token: str, classes: Classes = ()) -> list[frozenset[str]]:
    """Resolved script set of each letter of a token of class letters; accents count with their letter."""
    by = _by_script(classes)
    out = []
    for ch in unicodedata.normalize("NFD", token):
        if not ch.isalpha():
            continue
        own = next((name for name, pattern in SCRIPTS if pattern.match(ch)), "Latin")
        out.append(frozenset((own,)) if own != "Latin" else frozenset(("Latin", *(n for n, m in by.items() if ch in m))))
    return out


def possible_scripts(token: str, classes: Classes = ()) -> frozenset[str]:
    """Scripts in which all letters of a token can be spelled; none for a token of mixed script."""
    sets = script_sets(token, classes)
    return frozenset.intersection(*sets) if sets else frozenset()


def spell_token(token: str, script: str = "", classes: Classes = ()) -> str:
    """A token of class letters in one script, by default the only possible one; Latin and mixed tokens stay as they are."""
    if not script:
        common = possible_scripts(token, classes)
        script = "Latin" if "Latin" in common or not common else min(common, key=SCRIPT_NAMES.index)
    table = _by_script(classes).get(script)
    if not table:
        return token
    return unicodedata.normalize("NFC", "".join(table.get(c, c) for c in unicodedata.normalize("NFD", token)))


def spell_text(text: str, classes: Classes = ()) -> str:
    """Each token of a text of class letters in the script of its sentence, where it can be of several."""
    if not FOREIGN.search(text):
        return text
    can = {w: possible_scripts(w, classes) for w in set(WORD.findall(text))}

    def votes(part: str) -> Counter[str]:
        return Counter(next(iter(can[w])) for w in WORD.findall(part) if len(can[w]) == 1)

    everywhere = votes(text)

    def spell(part: str) -> str:
        here = votes(part) or everywhere

        def one(m: regex.Match) -> str:
            common = can[m.group()]
            if not common or common == {"Latin"}:
                return m.group()
            return spell_token(m.group(), min(common, key=lambda s: (-here[s], s != "Latin", s)), classes)

        return WORD.sub(one, part)

    return "".join(spell(m.group()) for m in SENTENCE.finditer(text))


def forms(texts: list[str], classes: Classes = ()) -> list[str]:
    """The consistent form of each text."""
    out: list[str] = []
    plain = cm.looks(texts)
    table = skeleton_table(classes)
    for a, b in cm.groups(plain):
        joined = "\0".join(plain[a:b])
        if ACCENTED.search(joined):
            joined = joined.translate(_accented(classes))
        skeleton = table[cm.codes(joined)]
        whole = cm.text_of(spell_cjk(skeleton))
        if MARKED.search(whole):
            # an accent after a letter that became another one
            whole = unicodedata.normalize("NFC", whole)
        if FOREIGN.search(whole):
            out += [spell_text(t, classes) for t in whole.split("\0")]
        else:
            out += whole.split("\0")
    return out


def letters(text: str) -> int:
    codes = cm.codes(text)
    return int(cm.letter_table()[codes].sum())


KINDS = ("none", "form", "whole", "mixed")


def _script_of(ch: str) -> str:
    if regex.match("[\\p{Katakana}ー]", ch):
        return "Katakana"
    return next((n for n in ("Latin", "Han", "Hiragana", *SCRIPT_NAMES) if regex.match(f"\\p{{{n}}}", ch)), "")


def kinds(raw: str, form: str) -> str:
    """What was inconsistent in a text: 'mixed' or 'whole' script confusables, other 'form', or 'none'.

    A token whose letters changed was mixed if it held letters of the changed script and of
    the one it is spelled in, and whole if all its letters were of the other script.
    """
    if raw == form:
        return "none"
    seen = unicodedata.normalize("NFD", cm.looks([raw])[0])
    flat = unicodedata.normalize("NFD", form)
    if seen == flat or len(seen) != len(flat):
        return "form"
    kind = "form"
    for m in WORD.finditer(seen):
        now = flat[m.start() : m.end()]
        if m.group() == now:
            continue
        changed = {_script_of(x) for x, y in zip(m.group(), now, strict=True) if x != y}
        kept = {_script_of(x) for x, y in zip(m.group(), now, strict=True) if x == y and x.isalpha()}
        kind = max(kind, "mixed" if kept - changed - {""} else "whole", key=KINDS.index)
    return kind


def _hash(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def _prints(batches: Iterator[pa.RecordBatch], keys: list[str], least: int, classes: Classes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        fs = forms(texts, classes)
        codes = cm.codes("\0".join(fs))
        is_letter = cm.letter_table()[codes]
        counts = np.concatenate(([0], np.cumsum(is_letter)))
        ends = np.flatnonzero(codes == 0) if len(fs) > 1 else np.zeros(0, int)
        bounds = np.concatenate(([0], ends, [len(codes)]))
        n = counts[bounds[1:]] - counts[bounds[:-1]]
        keep = np.flatnonzero(n >= least)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(k).take(pa.array(keep)) for k in keys),
                pa.array([_hash(fs[i]) for i in keep], pa.binary()),
                pa.array([_hash(texts[i]) for i in keep], pa.binary()),
            ],
            names=[*keys, "form_id", "code_id"],
        )


def look_prints(df: DataFrame, column: str, keys: list[str], least: int = MIN_LETTERS) -> DataFrame:
    """keys, form_id and code_id: 128-bit prints of a text's consistent form and of its code points."""
    slim = df.select(*[F.col(k) for k in keys], F.col(column).alias("__text")).where(F.length("__text") >= least)
    schema = ", ".join(f"`{k}` {t}" for k, t in slim.dtypes if k != "__text") + ", form_id binary, code_id binary"
    classes = unicode_classes(df.sparkSession)
    return slim.mapInArrow(lambda it: _prints(it, keys, least, classes), schema)


def look_pairs(prints: DataFrame, group: list[str], key: str) -> DataFrame:
    """Pairs left_id < right_id of equal form and other code points within a group.

    The prints are written once, since texts are folded in Python. Forms with at least two
    spellings are found by a pre-aggregated minimum and maximum; spellings are paired with
    spellings, and only then with the ids that have them, so copies of one spelling never
    meet each other.
    """
    form = [*group, "form_id"]
    rows = cut(prints.select(*form, "code_id", key))
    varied = rows.groupBy(*form).agg(F.min("code_id").alias("lo"), F.max("code_id").alias("hi")).where("lo <> hi").select(*form)
    rows = rows.join(varied, form, "left_semi").distinct()
    spelled = rows.select(*form, "code_id").distinct()
    two = spelled.withColumnRenamed("code_id", "a").join(spelled.withColumnRenamed("code_id", "b"), form).where("a < b")
    left = rows.select(*form, F.col("code_id").alias("a"), F.col(key).alias("x"))
    right = rows.select(*form, F.col("code_id").alias("b"), F.col(key).alias("y"))
    pairs = two.join(left, [*form, "a"]).join(right, [*form, "b"]).where("x <> y")
    return pairs.select(*group, F.least("x", "y").alias("left_id"), F.greatest("x", "y").alias("right_id")).distinct()


def _form_rows(batches: Iterator[pa.RecordBatch], keys: list[str], classes: Classes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        fs = forms(texts, classes)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keys), pa.array(fs), pa.array([kinds(t, f) for t, f in zip(texts, fs, strict=True)])],
            names=[*keys, "form", "change"],
        )


def consistent_text(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """keys, the text's consistent form, and what kind of change it took."""
    slim = df.select(*[F.col(k) for k in keys], F.col(column).alias("__text")).where(F.col("__text").isNotNull())
    schema = ", ".join(f"`{k}` {t}" for k, t in slim.dtypes if k != "__text") + ", form string, change string"
    classes = unicode_classes(df.sparkSession)
    return slim.mapInArrow(lambda it: _form_rows(it, keys, classes), schema)
