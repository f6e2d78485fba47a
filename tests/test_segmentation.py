import random

import pytest
from pyspark.sql import functions as F

from spoolweave.operators import ordered as od
from spoolweave.operators import joins as jn
from spoolweave.operators import segmentation as sg

UNITS = "episode_id string, sentence_id string, start_sec double, end_sec double, text string, char_start int, char_end int, stability_score double, boundary_hints array<struct<type:string>>"


def make(rows):
    return [(e, s, a, b, f"<{s}>", 0, 1, 0.7, [("short_response_period",)] if h else None) for e, s, a, b, h in rows]


def brute_blocks(rows):
    """Blocks by the rules: at most five units and 25 s, closed from two units and 8 s, hints break."""
    out = []
    for e in sorted({r[0] for r in rows}):
        units = sorted((r for r in rows if r[0] == e), key=lambda r: (r[2], r[1]))
        groups, i = [], 0
        while i < len(units):
            g = [units[i]]
            i += 1
            while i < len(units) and not (len(g) >= 2 and (g[-1][4] or units[i][4])):
                long = units[i][3] - g[0][2]
                if len(g) + 1 > 5 or (long > 25 and len(g) >= 2):
                    break
                g.append(units[i])
                i += 1
                if long >= 8:
                    break
            groups.append(g)
        k = 0
        for g in groups:
            split = len(g) > 1 and g[-1][3] - g[0][2] > 25
            for part in [[u] for u in g] if split else [g]:
                k += 1
                out.append((e, f"block_{k:06d}", [u[1] for u in part], split))
    return out


@pytest.mark.parametrize("width", [10.0, 60.0, 1e9])
def test_blocks_equal_brute_force(spark, width):
    rng = random.Random(2)
    rows = []
    for e in ("a", "b"):
        t = 0.0
        for i in range(90):
            d = rng.choice([0.5, 1.0, 3.0, 6.0, 20.0])
            rows.append((e, f"s{i:03d}", t, t + d, rng.random() < 0.15))
            t += d if rng.random() < 0.8 else 0.0
    units = spark.createDataFrame(make(rows) + make(rows[:5]), UNITS)
    got = sg.merge_blocks(units, width=width).select("episode_id", "block_id", "sentence_ids", "is_sub_block").collect()
    assert sorted(map(tuple, got)) == sorted(brute_blocks(rows))


def test_block_cases(spark):
    even = [("e", f"s{i}", 3.0 * i, 3.0 * i + 3, False) for i in range(4)]
    short = [("f", f"s{i}", float(i), i + 1.0, False) for i in range(7)]
    long = [("g", "s0", 0.0, 20.0, False), ("g", "s1", 20.0, 40.0, False)]
    got = {}
    for r in sg.merge_blocks(spark.createDataFrame(make(even + short + long), UNITS)).collect():
        got.setdefault(r.episode_id, []).append((r.block_id, r.sentence_ids, r.is_sub_block, r.parent_sentence_ids))
    assert [len(x[1]) for x in sorted(got["e"])] == [3, 1] and [len(x[1]) for x in sorted(got["f"])] == [5, 2]
    assert sorted(got["g"]) == [("block_000001", ["s0"], True, ["s0", "s1"]), ("block_000002", ["s1"], True, ["s0", "s1"])]


def test_chunks(spark):
    df = spark.createDataFrame([(1, "あ。い！う"), (2, "。。"), (3, " \n"), (4, None), (5, "a。 　。b")], "k int, t string")
    rows = [(r.k, r.chunk_no, r.text, r.char_start, r.char_end) for r in sg.sentence_chunks(df, "t", ["k"]).orderBy("k", "chunk_no").collect()]
    assert rows[:5] == [(1, 1, "あ。", 0, 2), (1, 2, "い！", 2, 4), (1, 3, "う", 4, 5), (2, 1, "。", 0, 1), (2, 2, "。", 1, 2)]
    assert [r for r in rows if r[0] == 5] == [(5, 1, "a。", 0, 2), (5, 2, " 　。", 2, 5), (5, 3, "b", 5, 6)]
    inline = df.select("k", F.explode(sg.chunks(F.col("t"))).alias("c")).select("k", "c.*").orderBy("k", "char_start").collect()
    assert [tuple(r) for r in inline] == [(k, t, a, b) for k, _, t, a, b in rows]


def test_units_join_fragments(spark):
    text = "はい。うん\nそう。あ"
    runs = F.lit(None).cast("array<struct<text:string,audioTimeRange:struct<startSeconds:double,endSeconds:double>,transcriptionConfidence:double>>")
    df = spark.createDataFrame([("e", text, 1, "f")], "episode_id string, full_text string, has_snapshots int, source_file string")
    df = df.withColumn("timeline", sg.char_timeline(F.col("full_text"), runs, F.lit(0.0), F.lit(10.0)))
    rows = sg.sentence_units(df).orderBy("char_start").collect()
    assert "".join(r.text for r in rows) == text and [r.sentence_id for r in rows] == ["sent_000001", "sent_000002"]
    assert rows[-1].text.endswith("あ") and rows[-1].end_sec == pytest.approx(10.0) and rows[0].stability_score == 0.85 and rows[0].confirmed_snapshot_indexes == [0]


@pytest.mark.parametrize("width", [1.0, 100.0])
def test_clamp(spark, width):
    rows = [("e", "a", 0.0, 5.0), ("e", "b", 4.0, 6.0), ("e", "c", 5.5, 5.8), ("e", "d", 20.0, 19.0)]
    df = spark.createDataFrame(rows, "episode_id string, id string, start_sec double, end_sec double")
    got = {r.id: (r.start_clamped, round(r.end_clamped, 6)) for r in sg.clamp_times(df, "episode_id", "id", ["start_sec", "id"], width).collect()}
    assert got == {"a": (0.0, 5.0), "b": (5.0, 6.0), "c": (6.0, 6.1), "d": (20.0, 20.1)}


def test_short_chunks(spark):
    rows = [("e", "c1", 0.0, 2.0, "x" * 10), ("e", "c2", 2.0, 10.0, "y" * 30), ("e", "c3", 10.0, 18.0, "z" * 100), ("e", "c4", 18.0, 26.0, "w" * 30)]
    df = spark.createDataFrame(rows, "episode_id string, chunk_id string, start_sec double, end_sec double, text string")
    got = [(r.head, r.chunks, len(r.text)) for r in sg.merge_short_chunks(df, 5.0).orderBy("start_sec").collect()]
    assert got == [("c1", 2, 40), ("c3", 1, 100), ("c4", 1, 30)]


def test_fold_equals_sequential(spark):
    rng = random.Random(3)
    rows = [(k, float(i), rng.randint(-3, 3)) for k in ("a", "b", "c") for i in range(60)]
    df = od.with_blocks(spark.createDataFrame(rows, "k string, t double, v int"), "t", 7.0)

    def fold(pdf, state):
        s, out = int(state or 0), []
        for v in pdf["v"]:
            s = min(5, max(-5, s + int(v)))
            out.append(s)
        return pdf[["t"]].assign(s=out), s

    got = {(r.k, r.t): r.s for r in od.forgetful_fold(df, ["k"], ["t"], fold, "t double, s int", "int").collect()}
    for k in ("a", "b", "c"):
        s = 0
        for kk, t, v in rows:
            if kk == k:
                s = min(5, max(-5, s + v))
                assert got[(k, t)] == s


def test_fold_runs_until_nothing_is_stale(spark, monkeypatch):
    monkeypatch.setattr(od, "ROUNDS", 2, raising=False)
    df = od.with_blocks(spark.createDataFrame([("a", float(i), 1) for i in range(12)], "k string, t double, v int"), "t", 2.0)

    def total(pdf, state):
        out = pdf["v"].cumsum() + int(state or 0)
        return pdf[["t"]].assign(s=out), int(out.iloc[-1])

    got = {r.t: r.s for r in od.forgetful_fold(df, ["k"], ["t"], total, "t double, s int", "int").collect()}
    assert got == {float(i): i + 1 for i in range(12)}


@pytest.mark.parametrize("seed", range(4))
def test_clamp_function_equals_the_walk(seed):
    rng = random.Random(seed)
    rows = sg.pd.DataFrame([(s := rng.choice([1.0, 5.0, 5.05, 9.0, 40.0]) * i / 3, s + rng.choice([-2.0, 0.0, 0.05, 0.1, 3.0, 30.0])) for i in range(40)], columns=["start_sec", "end_sec"])
    f = sg._clamp_function(rows)
    for before in [rng.uniform(-5, 700) for _ in range(60)] + rows["end_sec"].tolist():
        assert sg._clamped_end(*f, before) == pytest.approx(sg._clamp(rows, before)[1][-1], abs=1e-9)


def test_clamp_with_a_wild_end(spark):
    """One end far ahead pushes every later row, over many blocks, in one pass."""
    rows = [("e", f"b{i:03d}", i * 400.0, 1e6 if i == 1 else i * 400.0 + 5.0) for i in range(60)]
    df = spark.createDataFrame(rows, "episode_id string, block_id string, start_sec double, end_sec double")
    got = {r.block_id: (r.start_clamped, r.end_clamped) for r in sg.clamp_times(df, "episode_id", "block_id", ["start_sec", "block_id"]).collect()}
    starts, ends = sg._clamp(sg.pd.DataFrame([r[2:] for r in rows], columns=["start_sec", "end_sec"]), None)
    assert [got[r[1]] for r in rows] == [(pytest.approx(s), pytest.approx(e)) for s, e in zip(starts, ends, strict=True)]


def test_intervals_with_wild_ends(spark):
    rng = random.Random(2)
    left = [("e", i, (a := rng.uniform(0, 900)), a + rng.choice([2.0, 40.0, 500.0, 1e9])) for i in range(40)]
    right = [("e", i, (a := rng.uniform(0, 900)), a + rng.choice([-1.0, 1.0, 70.0, 4e10])) for i in range(40)]
    a = spark.createDataFrame(left, "k string, l_id int, l_start double, l_end double")
    b = spark.createDataFrame(right, "k string, r_id int, r_start double, r_end double")
    want = sorted((x[1], y[1]) for x in left for y in right if y[3] >= y[2] and y[3] >= x[2] - 0.3 and y[2] <= x[3] + 0.3)
    assert sorted((r.l_id, r.r_id) for r in jn.interval_overlap(a, b, ["k"], 30.0, 0.3).collect()) == want
    assert jn.interval_overlap(a.limit(0), b, ["k"], 30.0).count() == 0
