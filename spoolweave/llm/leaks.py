"""Problem 7: held-out items leaking into documents.

A prefix-filtered set join. Items and documents are folded to letters (case, width,
punctuation, spacing, invisible characters, stamps at line starts aside) and seen as sets
of k-letter shingles. Items' shingles are ordered by their rarity in the corpus; a document
that holds the required part of an item must share one of the item's rarest shingles (its
prefix), so only those are looked up. Candidates pass a length bound and a positional bound
(enough shared seeds on neighbouring diagonals), and each is then verified exactly: the
shared seeds are joined to runs of equal letters, and the best chain of runs in order, with
small gaps, is found by dynamic programming.

The corpus is read twice, for the rarities and for the join, however many items there are.
Items of up to BLOCK_LETTERS letters in all, a proven bound, travel with the tasks; more
items go through a shuffle: shingles of documents that a bitmap of fixed size lets through
meet the items' shingles by key, and only documents with such shingles are moved. Both ways
give the same rows.

Items under WHOLE_BELOW letters must stand whole, since half of them tells nothing; others
by the share held. Shingles are never longer than half of their item.

Defined cases: null or empty texts match nothing, items without letters neither; documents
and items without an id are left out; the same item id given twice, or a document delivered
again, gives one row; equal items each get their rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolweave.functions import charmap as cm
from spoolweave.llm import lexicon as lx
from spoolweave.llm.lookalike import skeleton_table
from spoolweave.session import cut

#: Letters of a shingle, by the letters that must be held: a letter of a word-writing script tells more than one of an alphabet.
WIDE, NARROW = ((15, 12), (0, 6)), ((36, 24), (15, 12), (0, 6))
#: Shingles that align item and document in the verification.
SEED = 6
HELD = 0.5
WHOLE_BELOW = 12
#: Prefix hits asked for (the prefix is longer by as many shingles).
PREFIX_HITS = 16
#: Letters of items that travel with the tasks (some 100 bytes of tables each).
BLOCK_LETTERS = 300_000
STAMPS = re.compile(f"(?m)^[ \\t]*{lx.STAMP}[ \\t]*")
FILTER_BITS = 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(1)
def _table() -> np.ndarray:
    fold = cm.fold_table().copy()
    fold[0] = 0
    kept = fold != cm.DROP
    fold[kept] = skeleton_table()[fold[kept]]
    return fold


def fold_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of the texts without their stamps, look-alike letters made one."""
    joined = cm.join([STAMPS.sub(" ", t) if ":" in t else t for t in texts])
    if cm.has_jamo(joined):
        joined = unicodedata.normalize("NFC", joined)
    mapped = _table()[cm.codes(joined)]
    mapped = mapped[mapped != cm.DROP]
    stops = np.flatnonzero(mapped == 0)
    at = np.concatenate(([0], stops - np.arange(len(stops)), [len(mapped) - len(stops)])).astype(np.int64)
    return mapped[mapped != 0], at


def _both(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = (x ^ (y * _A)) * _B
    out ^= out >> np.uint64(31)
    return out


def shingles(letters: np.ndarray, lengths: Iterable[int] = (SEED, 12, 24)) -> dict[int, np.ndarray]:
    """64-bit codes of the letters from each position, by shingle length; long ones from two halves."""
    out: dict[int, np.ndarray] = {}
    with np.errstate(over="ignore"):
        one = letters.astype(np.uint64) * _A
        one ^= one >> np.uint64(29)
        last, size = one, 1
        for k in range(1, SEED + 1):
            if k > 1:
                last = _both(last[:-1], one[k - 1 :]) if len(one) >= k else np.zeros(0, np.uint64)
            out[k] = last
        size = SEED
        while size < max(lengths, default=0):
            last = _both(last[:-size], last[size:]) if len(last) > size else np.zeros(0, np.uint64)
            size *= 2
            out[size] = last
    return {k: out[k] for k in {*lengths, SEED}}


def shingle_length(letters: np.ndarray, held: float) -> int:
    """Shingle length of an item: the longest that fits in what must be held of it."""
    if len(letters) < SEED:
        return len(letters)
    need = needed(len(letters), held)
    steps = NARROW if (letters < 0x2E80).mean() > 0.5 else WIDE
    return next(k for least, k in steps if need >= least)


def needed(n: int, held: float) -> int:
    """Letters of an item of n letters that a document must hold in one passage."""
    return n if n < WHOLE_BELOW else int(np.ceil(held * n))


def required(n: int, k: int, held: float) -> int:
    """Shingles of an item that a holding document shares at the least.

    The needed letters stand in one passage, in which a change spoils as many shingles as a
    shingle has letters; at most one change for 1.4 shingle lengths is allowed for.
    """
    passage = needed(n, held) - k + 1
    return max(1, passage - int(k * np.ceil(passage / (1.4 * k))))


class Items:
    """Shingles of a block of items, with the prefix that a holding document must hit."""

    def __init__(self, rows: list[tuple[int, str]], held: float = HELD) -> None:
        rows = sorted(rows)
        letters, at = fold_texts([r[1] or "" for r in rows])
        own = [(r[0], letters[at[n] : at[n + 1]]) for n, r in enumerate(rows) if at[n + 1] > at[n]]
        self.ids = [i for i, _ in own]
        self.letters = [x for _, x in own]
        self.held = held
        self.k = [shingle_length(x, held) for x in self.letters]
        self.lengths = sorted(set(self.k))
        self.grams = [shingles(x, (k,)) for x, k in zip(self.letters, self.k, strict=True)]
        self.codes = {k: np.unique(np.concatenate([g[k] for g, own_k in zip(self.grams, self.k, strict=True) if own_k == k])) for k in self.lengths}
        self.filters = {k: bit_filter(c) for k, c in self.codes.items()}
        self.seeds = []
        for g in self.grams:
            order = np.argsort(g[SEED], kind="stable")
            self.seeds.append((g[SEED][order], order))

    def set_prefixes(self, rarity: dict[int, dict[int, int]]) -> None:
        """Keep, per item, its rarest shingles up to the length at which a holder must hit them."""
        owner: dict[int, dict[int, list[int]]] = {k: {} for k in self.lengths}
        least = []
        for i, (g, k) in enumerate(zip(self.grams, self.k, strict=True)):
            need = required(len(self.letters[i]), k, self.held)
            least.append(min(PREFIX_HITS, need))
            known = rarity.get(k, {})
            distinct = sorted(set(g[k].tolist()), key=lambda c: (known.get(c, 0), c))
            for c in distinct[: max(1, len(distinct) - need + least[-1])]:
                owner[k].setdefault(c, []).append(i)
        self.least = np.array(least, dtype=np.int64)
        self.prefix, self.owner_at, self.owner_of, self.prefix_filter = {}, {}, {}, {}
        for k, own in owner.items():
            self.prefix[k] = np.array(sorted(own), dtype=np.uint64)
            lists = [own[int(c)] for c in self.prefix[k]]
            self.owner_at[k] = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
            self.owner_of[k] = np.array([i for x in lists for i in x], dtype=np.int64)
            self.prefix_filter[k] = bit_filter(self.prefix[k])


def bit_filter(codes: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << FILTER_BITS, bool)
    table[(codes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return table


def hits(grams: np.ndarray, codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of grams that are among the sorted codes, and their places there."""
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    may = np.flatnonzero(table[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    place = np.searchsorted(codes, grams[may])
    place[place == len(codes)] = 0
    real = codes[place] == grams[may]
    return may[real], place[real]


def candidates(items: Items, grams: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
    """(document, item) pairs with enough prefix hits, for all documents of a batch at once."""
    pairs = []
    m = max(len(items.ids), 1)
    for k in items.lengths:
        where, place = hits(grams[k], items.prefix[k], items.prefix_filter[k])
        if not len(where):
            continue
        doc = np.searchsorted(at, where, side="right") - 1
        inside = where + k <= at[doc + 1]
        doc, place = doc[inside], place[inside]
        # a shingle said twice in a document counts once
        once = np.unique(doc.astype(np.int64) * len(items.prefix[k]) + place)
        doc, place = once // len(items.prefix[k]), once % len(items.prefix[k])
        lo, hi = items.owner_at[k][place], items.owner_at[k][place + 1]
        n = hi - lo
        owner = items.owner_of[k][np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        pairs.append(np.repeat(doc, n) * m + owner)
    if not pairs:
        return np.zeros((0, 2), np.int64)
    found, count = np.unique(np.concatenate(pairs), return_counts=True)
    found = found[count >= items.least[found % m]]
    return np.stack((found // m, found % m), axis=1)


GAP = 30
DRIFT = 16
#: Width of a diagonal band; a passage lies in two neighbouring ones.
BAND = 48


def equal_runs(ip: np.ndarray, dp: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs (item start, document start, letters) of the shared seeds, in document order."""
    order = np.lexsort((ip, dp - ip))
    ip, dp = ip[order], dp[order]
    new = np.concatenate(([True], (ip[1:] - ip[:-1] != dp[1:] - dp[:-1]) | (ip[1:] - ip[:-1] > SEED) | (dp[1:] - ip[1:] != dp[:-1] - ip[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(ip)])) - 1
    return sorted(zip(ip[first].tolist(), dp[first].tolist(), (ip[last] - ip[first] + SEED).tolist(), strict=True), key=lambda r: (r[1], r[0]))


def held_letters(item: np.ndarray, doc: np.ndarray, runs: list[tuple[int, int, int]]) -> int:
    """Most letters of the item that one passage of the document holds.

    A passage is a chain of runs, in order in both texts, with gaps of at most GAP letters
    that drift by at most DRIFT; of a gap as long on both sides its equal letters count as
    well. The best chain is found by dynamic programming over the runs.
    """
    best = [0] * len(runs)
    for j, (a, b, n) in enumerate(runs):
        best[j] = n
        for i in range(j - 1, -1, -1):
            x, y, m = runs[i]
            if b - y > len(item) + GAP + DRIFT:
                break  # beyond an item's length no chain goes on
            if not (a > x and b > y):
                continue
            # what the runs share counts once
            over = max(x + m - a, y + m - b, 0)
            da, db = a + over - x - m, b + over - y - m
            if over >= n or da > GAP or db > GAP or abs(da - db) > DRIFT:
                continue
            same = int((item[x + m : a + over] == doc[y + m : b + over]).sum()) if da == db and da else 0
            best[j] = max(best[j], best[i] + same + n - over)
    return max(best, default=0)


def _positions_of(items: Items, i: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item positions, document positions) of seeds the item and the document share."""
    codes, order = items.seeds[i]
    lo = np.searchsorted(codes, grams, side="left")
    lo[lo == len(codes)] = 0
    at = np.flatnonzero(codes[lo] == grams)
    lo = lo[at]
    n = np.searchsorted(codes, grams[at], side="right") - lo
    return order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)], np.repeat(at, n)


def verify(items: Items, i: int, letters: np.ndarray, seeds: np.ndarray) -> int:
    """Letters of item i that the document holds in one passage, or 0 if under what is needed."""
    n = len(items.letters[i])
    need = needed(n, items.held)
    if n < SEED:
        return n  # the shingle is the item
    if len(letters) < need - need // 8:  # length bound: gaps may hold letters of their own only
        return 0
    ip, dp = _positions_of(items, i, seeds)
    # changes are few: a third of the seeds of what is needed remain
    least = max(1, (need - SEED + 1) // 3)
    if len(ip) < least or len(np.unique(ip)) < least:
        return 0
    # positional bound: enough seeds on neighbouring diagonals, as one passage with few changes has
    diagonal = (dp - ip + n) // BAND
    count = np.bincount(diagonal)
    near = count + np.concatenate((count[1:], [0]))
    if near.max() < least:
        return 0
    keep = np.flatnonzero(near >= least)
    inside = np.zeros(len(count) + 3, bool)
    for shift in (-1, 0, 1, 2):
        inside[np.maximum(keep + shift, 0)] = True
    inside = inside[diagonal]
    held = held_letters(items.letters[i], letters, equal_runs(ip[inside], dp[inside]))
    return held if held >= need else 0


def _count(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
    total = {k: np.zeros(len(c), np.int64) for k, c in items.codes.items()}
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        for a, b in cm.groups(texts):
            letters, at = fold_texts(texts[a:b])
            grams = shingles(letters, items.lengths)
            for k in items.lengths:
                size = len(items.codes[k])
                where, place = hits(grams[k], items.codes[k], items.filters[k])
                if not len(where):
                    continue
                doc = np.searchsorted(at, where, side="right") - 1
                inside = where + k <= at[doc + 1]
                once = np.unique(doc[inside].astype(np.int64) * size + place[inside])
                total[k] += np.bincount(once % size, minlength=size)
    for k, counts in total.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k] * len(some), pa.int32()), pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], names=["k", "place", "docs"])


def _join(batches: Iterator[pa.RecordBatch], items: Items, key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        rows, found, held, size = [], [], [], []
        for a, b in cm.groups(texts):
            letters, at = fold_texts(texts[a:b])
            grams = shingles(letters, items.lengths)
            for d, i in candidates(items, grams, at).tolist():
                lo, hi = int(at[d]), int(at[d + 1])
                h = verify(items, i, letters[lo:hi], grams[SEED][lo : max(hi - SEED + 1, lo)])
                if h:
                    rows.append(a + d)
                    found.append(items.ids[i])
                    held.append(h)
                    size.append(len(items.letters[i]))
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(key).take(taken), pa.array(found, pa.int64()), pa.array(held, pa.int32()), pa.array(size, pa.int32())], names=[key, "item_id", "held", "letters"]
        )


def _schema(docs: DataFrame, key: str) -> str:
    return f"`{key}` {dict(docs.dtypes)[key]}, item_id bigint, held int, letters int"


def _by_closure(docs: DataFrame, rows: list[tuple[int, str]], key: str, held: float) -> DataFrame:
    """Few items: their tables travel with the tasks, documents stay where they are."""
    block = Items(rows, held)
    if not block.ids:
        return docs.sparkSession.createDataFrame([], _schema(docs, key))
    counts = docs.select("__text").mapInArrow(lambda it: _count(it, block), "k int, place bigint, docs bigint").groupBy("k", "place").agg(F.sum("docs").alias("docs"))
    rarity: dict[int, dict[int, int]] = {k: {} for k in block.lengths}
    for k, place, n in counts.collect():  # as many rows as the block has shingles, at most
        rarity[k][int(block.codes[k][place])] = n
    block.set_prefixes(rarity)
    return docs.mapInArrow(lambda it: _join(it, block, key), _schema(docs, key))


# --- many items: by shuffle ---------------------------------------------------------------

#: Bits of the bitmap that decides which shingles of documents are moved: 8 MB, whatever the items.
SLOT_BITS = 26


def _own_code(codes: np.ndarray, k: int) -> np.ndarray:
    """Codes of different shingle lengths kept apart."""
    with np.errstate(over="ignore"):
        return (codes ^ np.uint64(k) * _B) * _A


def _item_shingles(batches: Iterator[pa.RecordBatch], held: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("item_id").to_pylist(), batch.column("text").to_pylist()
        for a, b in cm.groups(texts):
            letters, at = fold_texts(texts[a:b])
            for i in range(b - a):
                own = letters[at[i] : at[i + 1]]
                if not len(own):
                    continue
                k = shingle_length(own, held)
                codes = np.unique(_own_code(shingles(own, (k,))[k], k)).view(np.int64)
                need = required(len(own), k, held)
                ask = min(PREFIX_HITS, need)
                n = len(codes)
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": pa.array([ids[a + i]] * n, pa.int64()),
                        "k": pa.array([k] * n, pa.int32()),
                        "code": pa.array(codes),
                        "ask": pa.array([ask] * n, pa.int32()),
                        "prefix": pa.array([max(1, n - need + ask)] * n, pa.int32()),
                    }
                )


def _bitmap(codes: DataFrame) -> np.ndarray:
    """The slots that some code falls into; at most 2 ** SLOT_BITS bits come to the driver."""
    slot = F.shiftrightunsigned("code", 64 - SLOT_BITS) + 1  # the bitmap functions count from 1
    rows = codes.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect()
    table = np.zeros((1 << SLOT_BITS) + 32768, bool)
    for bucket, bits in rows:
        start = (bucket - 1) * 32768
        table[start : start + 32768] = np.unpackbits(np.frombuffer(bytes(bits), np.uint8), bitorder="little")
    return np.packbits(table)


def _passing(grams: np.ndarray, k: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and codes of the shingles whose slot is set."""
    codes = _own_code(grams, k)
    slot = (codes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    at = np.flatnonzero((bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)
    return at, codes[at].view(np.int64)


def _document_shingles(texts: list[str], lengths: list[int], bits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(document, its distinct shingles that pass the bitmap), documents without any left out."""
    for a, b in cm.groups(texts):
        letters, at = fold_texts(texts[a:b])
        docs, codes = [], []
        grams = shingles(letters, lengths)
        for k in lengths:
            where, code = _passing(grams[k], k, bits)
            doc = np.searchsorted(at, where, side="right") - 1
            inside = where + k <= at[doc + 1]
            docs.append(doc[inside])
            codes.append(code[inside])
        doc, code = np.concatenate(docs), np.concatenate(codes)
        order = np.argsort(doc, kind="stable")
        doc, code = doc[order], code[order]
        some, first = np.unique(doc, return_index=True)
        for d, x, y in zip(some.tolist(), first, np.append(first[1:], len(doc)), strict=False):
            yield a + d, np.unique(code[x:y])


def _by_shuffle(docs: DataFrame, items: DataFrame, key: str, held: float) -> DataFrame:
    """Many items: shingles meet by key. Documents are read twice and moved only if they hold shingles of a prefix."""
    own = cut(items.mapInArrow(lambda it: _item_shingles(it, held), "item_id bigint, k int, code bigint, ask int, prefix int"))
    lengths = sorted(r[0] for r in own.select("k").distinct().collect())  # at most eight
    every = _bitmap(own)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [c for _, c in _document_shingles(batch.column("__text").to_pylist(), lengths, every)]
            codes, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], names=["code", "docs"])

    counts = docs.select("__text").mapInArrow(seen, "code bigint, docs bigint").groupBy("code").agg(F.sum("docs").alias("docs"))
    ranked = own.join(counts, "code", "left").groupBy("item_id", "ask", "prefix").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "code"))).alias("c"))
    prefix = cut(ranked.select("item_id", "ask", F.explode(F.expr("slice(c, 1, prefix)")).alias("c")).select("item_id", "ask", F.col("c.code").alias("code")))
    rare = _bitmap(prefix)

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_document_shingles(batch.column("__text").to_pylist(), lengths, rare))
            taken = pa.array([d for d, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(key).take(taken), batch.column("__text").take(taken), pa.array([c for _, c in found], pa.list_(pa.int64()))], names=[key, "__text", "codes"])

    held_by = cut(docs.mapInArrow(hit, f"`{key}` {dict(docs.dtypes)[key]}, __text string, codes array<bigint>").dropDuplicates([key]))
    pairs = held_by.select(key, F.explode("codes").alias("code")).join(prefix, "code").groupBy(key, "item_id").agg(F.count("*").alias("n"), F.min("ask").alias("ask")).where("n >= ask").select(key, "item_id")
    full = pairs.join(held_by.select(key, "__text"), key).join(items.withColumnRenamed("text", "__item"), "item_id")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("item_id").to_pylist(), batch.column("__text").to_pylist()
            known = sorted(set(zip(ids, batch.column("__item").to_pylist(), strict=True)))
            # an id may stand for several texts, so items are told apart by their number here
            block = Items([(n, t) for n, (_, t) in enumerate(known)], held)
            number = {pair: n for n, pair in enumerate(known)}
            place = {n: i for i, n in enumerate(block.ids)}
            out = []
            for r, (i, text, item) in enumerate(zip(ids, texts, batch.column("__item").to_pylist(), strict=True)):
                letters, _ = fold_texts([text])
                x = place[number[(i, item)]]
                h = verify(block, x, letters, shingles(letters, ())[SEED])
                if h:
                    out.append((r, h, len(block.letters[x])))
            taken = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(taken), batch.column("item_id").take(taken), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.int32())],
                names=[key, "item_id", "held", "letters"],
            )

    return full.select(key, "item_id", "__text", "__item").mapInArrow(check, _schema(docs, key))


def leaked_items(documents: DataFrame, items: DataFrame, key: str = "doc_id", held: float = HELD, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """One row per document and item it holds: letters held in one passage, letters of the item."""
    docs = documents.select(F.col(key), F.col("text").alias("__text")).where((F.length("__text") > 0) & F.col(key).isNotNull())
    known = items.where("item_id is not null and length(text) > 0").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    size = known.agg(F.coalesce(F.sum(F.length("text") + 16), F.lit(0))).first()[0]
    if size <= block_letters:
        found = _by_closure(docs, [(r[0], r[1]) for r in known.collect()], key, held)
    else:
        found = _by_shuffle(docs, known, key, held)
    return found.groupBy(key, "item_id").agg(F.max("held").alias("held"), F.max("letters").alias("letters"))
