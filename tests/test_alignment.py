import difflib
import random

import numpy as np
import pytest

from spoolweave.operators import alignment as al
from spoolweave.operators import spans as sp


def test_align():
    out = al.align_texts("abXcd", "abcd")
    assert [(a["engine_start"], a["engine_end"], a["anchor_start"], a["anchor_end"]) for a in out["anchors"]] == [(0, 2, 0, 2), (3, 5, 2, 4)]
    assert out["global_alignment_score"] == out["coverage_ratio"] == 0.8


def test_project():
    assert al.project([], 3, 5).tolist() == [0, 2, 4] and al.project([(1, 4)], 3, 5).tolist() == [2, 4, 6] and al.project([], 0, 5).tolist() == []
    assert al.project([(0, 0), (2, 4), (2, 3)], 4, 9).tolist() == [0, 2, 4, 6]


def test_runs_equal_opcodes():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 30))) for _ in "xy")
        want = [(i, k, j - i) for tag, i, j, k, _ in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if tag == "equal"]
        assert al.equal_runs(a, b) == want


def text(rng, n):
    return "".join(rng.choice("あいうえおかきくけこさしすせそたちつてとなにぬねの山川海空花") for _ in range(n))


def plain_search(target, asr, start, end, radius):
    """The search without bounds or a first look: every pair in order, best by score, length, drift, start."""
    s = sp.Search(target, asr, start, end, radius)
    best, stop = None, False

    def visit(pairs):
        nonlocal best, stop
        for x, y in pairs:
            c = asr[x:y]
            if stop or not c:
                continue
            fit = 1 - min(1.0, abs(len(c) - s.size) / max(s.size, len(c), 1))
            edge = 0.82 if x <= s.left or y >= s.right else 1.0
            v = max(0.0, min(1.0, 0.7 * difflib.SequenceMatcher(None, target, c, autojunk=False).ratio() + (0.2 * fit + 0.1 * edge)))
            key = (-v, abs(len(c) - s.size), abs(x - start) + abs(y - end), x)
            if best is None or key < best[:4]:
                best = (*key, y)
                stop = v >= 0.96 and 0.75 <= len(c) / s.size <= 1.35

    visit(s.first_pairs().tolist())
    if s.coarse and not stop and best:
        s.best = best
        visit(s.near_pairs().tolist())
    return best


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_plain_search(seed):
    rng = random.Random(seed)
    size = rng.choice([12, 30, 60, 130])
    target = text(rng, size)
    noisy = "".join(c if rng.random() > 0.15 else rng.choice("xyz") for c in target)
    asr = text(rng, 50) + noisy + text(rng, 60)
    start = 50 + rng.randint(-12, 12)
    search = sp.Search(target, asr, start, start + size, 40)
    search.run()
    assert search.best == plain_search(target, asr, start, start + size, 40)


def test_refine_finds_the_span():
    rng = random.Random(9)
    body = text(rng, 40)
    anchor, engine = sp.Artifact.of(body), sp.Artifact.of(text(rng, 30) + "、" + body + "。" + text(rng, 30))
    out = sp.refine(anchor, engine, 0, 40, 33, 74, 36)
    assert body[2:-2] in out["text"] and out["usable_for_agreement"] and out["local_alignment_score"] > 0.9
    assert sp.refine(anchor, sp.Artifact.of(""), 0, 40, 0, 5, 32)["unusable_reason"] == "empty_asr_text"


def test_cheap_span():
    a, b, score = sp.cheap_span("abcdefgh", "xxxxabcdefghyyyy", 6, 14)
    assert (a, b) == (4, 12) and score == 1.0 and sp.cheap_span("ab", "", 1, 2) == (1, 2, 0.0)


def test_difference():
    assert sp.difference("子どもです。", "子供です") == ("none", 1.0)
    assert sp.difference("遠藤さんです", "円道さんです")[0] == "critical"
    assert sp.difference("長い文章の中の核家族の話をしました", "長い文章の中の核家の話をしました")[0] == "soft_domain"
    assert sp.difference("まったく別", "ちがうこと")[0] == "semantic"


def test_tables(spark):
    rng = random.Random(4)
    body = text(rng, 260)
    texts = spark.createDataFrame([("e", "apple", body), ("e", "qwen", body[:100] + "x" + body[100:]), ("e", "whisper", text(rng, 200)), ("f", "apple", None), ("f", "qwen", "a")], "episode_id string, source string, raw_text string")
    aligned = al.align_engines(texts)
    rows = {(r.episode_id, r.engine): r for r in aligned.collect()}
    assert rows[("e", "qwen")].global_alignment_score == pytest.approx(260 / 261) and len(rows[("e", "qwen")].anchor_to_engine) == 260
    assert rows[("f", "qwen")].coverage_ratio == 0.0
    blocks = spark.createDataFrame([("e", f"b{i}", i * 52, i * 52 + 52) for i in range(5)], "episode_id string, block_id string, char_start int, char_end int")
    got = {(r.block_id, r.source): r for r in sp.block_candidates(blocks, texts, aligned, swapped=False).collect()}
    assert len(got) == 10 and got[("b2", "whisper")].skipped and got[("b2", "whisper")].unusable_reason == ["global_alignment_low"]
    assert body[106:154] in got[("b2", "qwen")].text and got[("b2", "qwen")].usable_for_agreement
    assert np.isfinite([r.local_alignment_score for r in got.values()]).all()


def test_chunks_read_what_whole_texts_hold(spark):
    """Searching by small chunks of blocks finds what searching whole texts finds, and what is moved grows with the text."""
    rng = random.Random(11)
    body = text(rng, 1500)
    engine = "".join(c if rng.random() > 0.1 else rng.choice(["", "x", c + c]) for c in body)
    texts = spark.createDataFrame([("e", "apple", body), ("e", "qwen", engine), ("e", "whisper", engine[::2])], "episode_id string, source string, raw_text string")
    aligned = al.align_engines(texts)
    blocks = spark.createDataFrame([("e", f"b{i:02d}", i * 50, i * 50 + 50) for i in range(30)] + [("e", "none", 1400, 1400)], "episode_id string, block_id string, char_start int, char_end int")
    for swapped in (True, False):
        whole, parts = (sorted(map(str, sp.block_candidates(blocks, texts, aligned, swapped=swapped, chunk_chars=n).collect())) for n in (1_000_000, 100))
        assert whole == parts and len(whole) == 62


def plain_cheap_span(target, asr, start, end, radius=24):
    """The cheap look without bounds: every span in order, the first of the best by score and drift."""
    n, size = len(asr), max(len(target), 1)
    right, least = min(n, end + radius), max(1, int(size * 0.75))
    best = None
    for s in range(max(0, start - radius), min(right, n - 1) + 1, 2):
        for e in dict.fromkeys(min(n, s + k) for k in range(least, max(least, int(size * 1.35)) + 1, 2)):
            if s < e <= right:
                ratio = difflib.SequenceMatcher(None, target, asr[s:e], autojunk=False).ratio() if target else 0.0
                fit = 1.0 - min(1.0, abs(e - s - size) / max(size, e - s, 1))
                key = (-max(0.0, min(1.0, 0.82 * ratio + 0.18 * fit)), abs(s - start) + abs(e - end))
                if best is None or key < best[:2]:
                    best = (*key, s, e)
    return (best[2], best[3], -best[0]) if best else (start, end, 0.0)


def test_cheap_span_equals_plain_look_with_few_ratios(monkeypatch):
    rng = random.Random(12)
    taken, ratio = [], sp.ratio_value
    monkeypatch.setattr(sp, "ratio_value", lambda a, b: taken.append(1) or ratio(a, b))
    looked = 0
    for _ in range(40):
        body = text(rng, rng.choice([0, 1, 5, 30, 60]))
        noisy = "".join(c if rng.random() > 0.05 else rng.choice(["", "x", c + c]) for c in body)
        asr = text(rng, rng.choice([0, 7, 60])) + noisy + text(rng, rng.choice([0, 3, 60]))
        start = rng.randint(0, len(asr) + 3)
        for target in (body, noisy, text(rng, 9), "abab"):
            assert sp.cheap_span(target, asr, start, start + len(target)) == plain_cheap_span(target, asr, start, start + len(target))
    taken.clear()
    for _ in range(20):
        body = text(rng, 60)
        asr = text(rng, 60) + body[:30] + "x" + body[31:] + text(rng, 60)
        looked += 1
        assert sp.cheap_span(body, asr, 57, 117)[2] > 0.95
    assert len(taken) < 30 * looked
