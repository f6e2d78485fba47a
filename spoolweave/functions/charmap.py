"""Vectorised code-point maps: one table lookup per character over a whole Arrow batch.

Texts of a batch are joined with NUL, viewed as UTF-32 and mapped with numpy, so the cost
is a few nanoseconds a character instead of a Python call. NUL inside a text is dropped.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

SPAN = 0x110000
DROP = 0xFFFFFFFF
BATCH_CHARS = 2_000_000
#: Planes with letters of alphabets, and compatibility forms of Chinese characters; the ideographs between them stand for themselves.
MAPPED = (*range(0x20000), *range(0x2F800, 0x2FA1E))
IDEOGRAPHS = slice(0x20000, 0x323B0)
_JAMO = re.compile("[\u1100-\u11ff]")


def is_invisible(code: int) -> bool:
    """Characters that take no room: format characters, joiners, fillers, variation selectors."""
    if code in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0):
        return True
    if 0xFE00 <= code <= 0xFE0F or 0x180B <= code <= 0x180F or 0xE0000 <= code <= 0xE0FFF:
        return True
    return unicodedata.category(chr(code)) == "Cf"


def _look(code: int) -> int:
    ch = chr(code)
    if is_invisible(code) or code == 0:
        return DROP
    if unicodedata.category(ch) == "Zs" or ch == "\t":
        return 0x20
    kc = unicodedata.normalize("NFKC", ch)
    return ord(kc) if len(kc) == 1 else code


@lru_cache(1)
def look_table() -> np.ndarray:
    """Width, compatibility form of one character, kind of space; invisible characters dropped."""
    table = np.arange(SPAN, dtype=np.uint32)
    for code in MAPPED:
        if 0x4E00 <= code < 0xA000 or 0xAC00 <= code < 0xD7A4 or 0xD800 <= code < 0xF900:
            continue
        table[code] = _look(code)
    table[0xE0000:0xE1000] = DROP
    return table


@lru_cache(1)
def letter_table() -> np.ndarray:
    """True for letters and digits."""
    table = np.zeros(SPAN, dtype=bool)
    for code in range(0x20000):
        if not 0xD800 <= code < 0xE000:
            table[code] = chr(code).isalnum()
    table[IDEOGRAPHS] = True
    return table


@lru_cache(2)
def fold_table(marks: bool = False) -> np.ndarray:
    """Letters and digits folded by case and width; everything else dropped.

    Without ``marks``, accents and voicing marks are off whether composed or not, so either
    spelling folds alike (Hangul jamo excepted: compose those first). With ``marks`` they
    count; compose the text first.
    """
    look, letter = look_table(), letter_table()
    table = np.full(SPAN, DROP, dtype=np.uint32)
    table[IDEOGRAPHS] = np.arange(IDEOGRAPHS.start, IDEOGRAPHS.stop, dtype=np.uint32)
    for code in MAPPED:
        if 0xD800 <= code < 0xE000:
            continue
        seen = int(look[code])
        if seen == DROP or not letter[seen]:
            continue
        if 0x2E80 <= seen < 0xA000 and not 0x3040 <= seen < 0x3100 or 0xAC00 <= seen < 0xD7A4 or seen >= 0x20000:
            table[code] = seen
            continue
        base = (chr(seen) if marks else unicodedata.normalize("NFD", chr(seen))[0]).casefold()
        table[code] = ord(base[0]) if base else DROP
    return table


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def text_of(array: np.ndarray) -> str:
    return array.astype("<u4", copy=False).tobytes().decode("utf-32-le", "surrogatepass")


def groups(texts: list[str], most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts that together stay near ``most`` characters."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def join(texts: Iterable[str]) -> str:
    return "\0".join(t.replace("\0", "") if "\0" in t else t for t in texts)


def looks(texts: list[str]) -> list[str]:
    """Each text with width, compatibility forms, spaces and composition made one; NFC."""
    out: list[str] = []
    table = look_table().copy()
    table[0] = 0
    for a, b in groups(texts):
        mapped = table[codes(join(texts[a:b]))]
        out += unicodedata.normalize("NFC", text_of(mapped[mapped != DROP])).split("\0")
    return out


def has_jamo(text: str) -> bool:
    """Whether Hangul is spelled in jamo somewhere, so that it must be composed first."""
    return _JAMO.search(text) is not None


def folded(texts: list[str], marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All texts' folded letters as one array, and the offset of each text in it (n + 1)."""
    joined = join(texts)
    if marks or has_jamo(joined):
        joined = unicodedata.normalize("NFC", joined)
    raw = codes(joined)
    table = fold_table(marks).copy()
    table[0] = 0
    mapped = table[raw]
    mapped = mapped[mapped != DROP]
    stops = np.flatnonzero(mapped == 0)
    offsets = np.concatenate(([0], stops - np.arange(len(stops)), [len(mapped) - len(stops)])) if texts else np.zeros(1, int)
    return mapped[mapped != 0], offsets.astype(np.int64)
