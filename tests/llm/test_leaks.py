import random

import pytest

from spoolweave.llm import leaks


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 9))) for _ in range(n))


def wide(rng, n):
    return "".join(rng.choice("春夏秋冬山川海空花鳥風月雪雨雲星森林田畑道橋町村") for _ in range(n))


def case(kind, rng, item):
    """(document, leaked)"""
    n = len(item)
    filler = words(rng, 60)
    if kind == "whole":
        return filler + " " + item + " " + filler, True
    if kind == "case":
        return filler + item.upper().replace(" ", " ") + filler, True
    if kind == "part":
        return filler + item[: int(n * 0.7)] + filler, True
    if kind == "stamped":
        step = 25
        return filler + "\n" + "\n".join(f"00:00:{i // step:02d} {item[i : i + step]}" for i in range(0, n, step)), True
    if kind == "altered":
        text = list(item)
        for i in range(20, n, 45):
            text[i] = "z"
        return filler + "".join(text) + filler, True
    if kind == "third":
        return filler + item[: int(n * 0.3)] + filler, False
    if kind == "scattered":
        return filler.join((item[: n // 3], item[n // 3 : 2 * n // 3])) + filler, False
    return filler, False


KINDS = ["whole", "case", "part", "stamped", "altered", "third", "scattered", "none"]


@pytest.mark.parametrize("held", ["narrow", "wide"])
def test_leaks(spark, held):
    rng = random.Random(5)
    items = [(i, words(rng, 40) if held == "narrow" else wide(rng, 180)) for i in range(6)]
    docs, want = [], set()
    for d in range(96):
        i, text = items[d % 6]
        doc, leaked = case(KINDS[d % 8], rng, text)
        docs.append((d, doc))
        if leaked:
            want.add((d, i))
    docs += [docs[0], (900, None), (901, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id")
    it = spark.createDataFrame([*items, (50, None), (51, ""), (52, "tiny")], "item_id long, text string")
    assert {tuple(r) for r in leaks.leaked_items(df, it).select("doc_id", "item_id").collect()} == want
    assert leaks.leaked_items(df, it.limit(0)).count() == 0 and leaks.leaked_items(df.limit(0), it).count() == 0


def test_many_items_give_the_same(spark):
    """The way by shuffle and the way by closure find the same rows."""
    rng = random.Random(6)
    items = [(i, words(rng, rng.choice((1, 2, 4, 30)))) for i in range(12)] + [(100 + i, wide(rng, rng.choice((3, 8, 20, 90)))) for i in range(8)] + [(3, words(rng, 30)), (200, "..."), (201, None)]
    docs = [(d, case(KINDS[d % 8], rng, items[d % 20][1])[0]) for d in range(80)] + [(5, None), (None, items[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    few, many = ({tuple(r) for r in leaks.leaked_items(df, it, block_letters=n).collect()} for n in (1_000_000, 100))
    assert few == many and len(few) > 20


def test_short_items(spark):
    docs = [(1, "They asked: the capital is PARIS, France? Yes."), (2, "The capital is unknown."), (3, "capital: Paris!"), (4, "東京都。"), (5, "東の京")]
    items = [(1, "The capital is Paris, France"), (2, "Paris"), (3, "東京"), (4, "unknown cap"), (5, "!")]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r)[:2] for r in leaks.leaked_items(df, it).collect()}
    # half of 23 letters are 12: "thecapitalis"
    assert got == {(1, 1), (2, 1), (1, 2), (3, 2), (4, 3)} | ({(5, 3)} if "東京" in "東の京" else set())


def test_best_chain_equals_brute_force():
    """Against every chain of runs, tried one by one."""
    rng = random.Random(8)

    def brute(item, doc, runs):
        def grow(last, total):
            best = total
            for a, b, n in runs:
                x, y, m = last
                over = max(x + m - a, y + m - b, 0)
                da, db = a + over - x - m, b + over - y - m
                if a > x and b > y and over < n and da <= leaks.GAP and db <= leaks.GAP and abs(da - db) <= leaks.DRIFT:
                    same = sum(item[x + m + t] == doc[y + m + t] for t in range(da)) if da == db else 0
                    best = max(best, grow((a, b, n), total + same + n - over))
            return best

        return max((grow(r, r[2]) for r in runs), default=0)

    for _ in range(60):
        item = leaks.np.array([rng.randrange(3) for _ in range(60)])
        doc = leaks.np.array([rng.randrange(3) for _ in range(90)])
        runs = sorted({(rng.randrange(40), rng.randrange(60), rng.randrange(6, 15)) for _ in range(6)}, key=lambda r: (r[1], r[0]))
        assert leaks.held_letters(item, doc, runs) == brute(item, doc, runs)
