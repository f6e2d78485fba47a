import difflib
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spoolweave.functions import similarity as sm
from spoolweave.operators import alignment


def words(seed, n=60):
    rng = random.Random(seed)
    return [("".join(rng.choice("abcあい ") for _ in range(rng.randint(0, 14))), "".join(rng.choice("abcあい ") for _ in range(rng.randint(0, 14)))) for _ in range(n)]


def test_ratio_and_bound(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("abcd", "bcde"), ("private", "primate"), ("", ""), ("a", ""), ("aabbc", "abbbd"), *words(1)]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", sm.sequence_ratio(F.col("a"), F.col("b")).alias("r"), sm.overlap_bound(F.col("a"), F.col("b")).alias("u")).collect()
    for x in rows:
        want = 1.0 if not x.a and not x.b else 0.0 if not x.a or not x.b else difflib.SequenceMatcher(None, x.a, x.b, autojunk=False).ratio()
        ca, cb = Counter(x.a), Counter(x.b)
        bound = 1.0 if not x.a and not x.b else 0.0 if not x.a or not x.b else 2 * sum((ca & cb).values()) / (len(x.a) + len(x.b))
        assert x.r == pytest.approx(want) and x.u == pytest.approx(bound) and x.r <= x.u + 1e-12
    assert rows[0].r == 0.25 and rows[1].r == 0.5 and rows[6].u == 0.6


def test_agreement(spark):
    df = spark.createDataFrame([("", "", ""), ("abc", "", ""), ("abc", "abd", ""), ("abc", "abc", "xyz")], "a string, b string, c string")
    got = [r[0] for r in df.select(sm.agreement([F.col(x) for x in "abc"])).collect()]
    assert got == pytest.approx([0.0, 1.0, 2 / 3, 1 / 3])


def test_anchor_mismatch(spark):
    a = "最初に図書館で新しい地図を見直しました"
    df = spark.createDataFrame([(a, a), ("余計な言葉が" + a, a), (a + "余計な言葉", a), ("短い", a)], "c string, a string")
    assert [r[0] for r in df.select(sm.anchor_mismatch(F.col("c"), F.col("a"))).collect()] == [False, True, True, False]


def test_prefix_and_result(spark):
    df = spark.createDataFrame([(["abcd", "abx", "abcd"],), (["ab", "abc"],), (["ab", "xy"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(sm.majority_prefix(F.col("t"))).collect()] == ["abcd", "abc", "xy", ""]
    df = spark.createDataFrame([("same start here and more", "same start here but not"), ("abc", "xyz"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(sm.matches_result(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def test_containment(spark):
    df = spark.createDataFrame([("あ、い", ["うあいえ"]), ("か", ["うあいえ"])], "f string, c array<string>")
    assert [r[0] for r in df.select(sm.contained_in_any(F.col("f"), F.col("c"))).collect()] == [True, False]


def test_matching_runs_are_those_of_the_matcher():
    rng = random.Random(5)
    for n in range(400):
        letters = rng.choice(["ab", "abcdefgh", "あいうab"])
        a = "".join(rng.choice(letters) for _ in range(rng.randint(0, 90)))
        b = "".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) if n % 2 else "".join(c if rng.random() > 0.1 else rng.choice(["", "x", c + c]) for c in a)
        found = difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
        assert alignment.equal_runs(a, b) == [(i, k, j - i) for tag, i, j, k, _ in found if tag == "equal"]


def test_long_similar_texts_take_time_by_length():
    rng = random.Random(6)
    a = "".join(rng.choice("abcdefghijkl") for _ in range(20_000))
    b = "".join(c if rng.random() > 0.02 else rng.choice(["", "x", c + c]) for c in a)
    began = time.process_time()
    matched = sum(n for _, _, n in alignment.equal_runs(b, a))
    assert matched > 0.97 * len(a) and time.process_time() - began < 5


def test_ratios_to_many_stretches_share_their_parts():
    rng = random.Random(7)
    for letters in ("ab", "abcdefghijkl"):
        a, b = ("".join(rng.choice(letters) for _ in range(n)) for n in (25, 60))
        many = sm.Matched(a, b)
        for x in range(0, 60, 3):
            for y in range(x, 61):
                assert many.ratio(x, y) == (difflib.SequenceMatcher(None, a, b[x:y], autojunk=False).ratio() if x < y else 0.0)
    assert sm.Matched("", "abc").ratio(0, 2) == 0.0 and sm.Matched("bc", "abc").ratio(1, 3) == 1.0
    # every run is one character: no nesting by the length of the text
    a, b = "".join(chr(0x4E00 + i) for i in range(3000)), "".join(chr(0x4E00 + i) + "x" for i in range(3000))
    assert sm.Matched(a, b).ratio(0, 6000) == 2 * 3000 / 9000
