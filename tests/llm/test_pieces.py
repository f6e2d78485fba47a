import random

import pytest

from spoolweave.llm import pieces as pc


def brute(lengths, limit):
    out, i = [], 0
    while True:
        j = i
        while j + 1 < len(lengths) and sum(lengths[i : j + 2]) <= limit:
            j += 1
        out.append((i, j))
        if j == len(lengths) - 1:
            return out
        i = j if j > i and lengths[j] + lengths[j + 1] <= limit else j + 1


@pytest.mark.parametrize("seed", range(40))
def test_cut_equals_brute(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 30, 120, 199, 200, 201, 390, 400, 401, 900]) for _ in range(rng.randint(1, 30))]
    assert pc.cut_pieces(lengths) == brute(lengths, 400)


def test_inside():
    text = "First part, second part. " * 40 + "x" * 900
    cuts = pc.cut_inside(text)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text) and all(b - a <= 400 for a, b in cuts)
    assert all(x[1] == y[0] for x, y in zip(cuts, cuts[1:], strict=False))
    assert all(y[0] == x[1] - 30 for x, y in zip(*(lambda c: (c, c[1:]))(pc.cut_inside(text, overlap=30)), strict=False))


def test_blocks(spark):
    units = [("e", f"s{i}", float(i), "w" * n) for i, n in enumerate([150, 150, 150, 500, 10])]
    units += [units[0], ("e", "s9", 0.0, None)]
    u = spark.createDataFrame(units, "episode_id string, sentence_id string, start_sec double, text string").selectExpr("*", "'b' as block_id")
    blocks = [("e", "b1", "x" * 900, ["s2", "s0", "s1", "s0", "s3", "s4", "gone", None]), ("e", "b2", "x" * 400, ["s3"]), ("e", "b3", None, ["s3"]), ("e", "b4", "y" * 500, None)]
    b = spark.createDataFrame([*blocks, blocks[0]], "episode_id string, block_id string, text string, sentence_ids array<string>").selectExpr("*", "1 as size")
    got = sorted(map(tuple, pc.block_pieces(b, u).collect()))
    assert got == [("e", "b1", 1, "s0", "s1", 300), ("e", "b1", 2, "s1", "s2", 300), ("e", "b1", 3, "s3", "s3", 500), ("e", "b1", 4, "s4", "s4", 10)]
    parts = sorted(map(tuple, pc.long_sentence_parts(b, u).collect()))
    assert parts == [("e", "b1", "s3", 1, 0, 400), ("e", "b1", "s3", 2, 360, 500)]
    assert pc.block_pieces(b.limit(0), u).count() == 0
