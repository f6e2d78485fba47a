from collections import Counter

import pytest

from spoolweave.llm import mixing

TARGETS = [("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 3), ("absent", 0.4, 2), (None, 0.1, 1)]
TSCHEMA = "source string, target_weight double, max_repeats int"


def docs():
    rows = [(i, f"a text about number {i} and some more words {i * 7}", "Big" if i % 3 else " BIG ") for i in range(600)]
    rows += [(1000 + i, f"middle sized text {i} with a tail", "mid") for i in range(150)]
    rows += [(2000 + i, f"small source text {i} goes here", "SMALL") for i in range(60)]
    rows += [(3000, rows[0][1], "big"), rows[5], (3001, None, "big"), (3002, "", "mid"), (3003, "no source", None), (3004, "other", "unlisted")]
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame(docs(), "doc_id long, text string, source string").selectExpr("*", "1 as tokens", "2 as place"), spark.createDataFrame(TARGETS, TSCHEMA)


def test_mix(spark, frames):
    got = mixing.mix_sources(*frames).collect()
    texts = {r[0]: r[1] for r in docs()}
    assert len({r.doc_id for r in got}) == len(got) == len({texts[r.doc_id] for r in got})
    caps = {"big": 1, "mid": 2, "small": 3}
    assert all(1 <= r.repeats <= caps[r.source] for r in got)
    assert all(r.tokens == mixing.token_count(texts[r.doc_id]) for r in got)
    size = Counter()
    for r in got:
        size[r.source] += r.tokens * r.repeats
    total = sum(size.values())
    for s, w in (("big", 0.5), ("mid", 0.3), ("small", 0.2)):
        assert abs(size[s] / total - w) < 0.005
    # some source is used to its cap
    assert any(min(r.repeats for r in got if r.source == s) == caps[s] and len([r for r in got if r.source == s]) == n for s, n in (("big", 600), ("mid", 150), ("small", 60)))
    # the same again
    assert sorted(map(tuple, mixing.mix_sources(*frames).collect())) == sorted(map(tuple, got))


@pytest.mark.parametrize("total", [500, 2000, 10**9])
def test_total(frames, total):
    rows = {r.source: r for r in mixing.mix_shares(*frames, total=total).collect()}
    size = sum(r.tokens for r in rows.values())
    largest = sum(r.tokens for r in mixing.mix_shares(*frames).collect())
    assert abs(size - min(total, largest)) <= 3 * 12  # half a text a source
    for s, w in (("big", 0.5), ("mid", 0.3), ("small", 0.2)):
        assert abs(rows[s].tokens - w * size) <= 24


def test_shares_and_empty(spark, frames):
    rows = {r.source: r for r in mixing.mix_shares(*frames).collect()}
    assert rows["absent"].tokens == 0 and abs(sum(r.share for r in rows.values()) - 1) < 1e-9
    assert mixing.mix_sources(frames[0].limit(0), frames[1]).count() == 0
    assert mixing.mix_sources(frames[0], frames[1].limit(0)).count() == 0


def test_no_source_is_left_out_for_their_number(spark):
    n = 10_040
    targets = spark.createDataFrame([(f"s{i}", 1.0, 1) for i in range(n)], TSCHEMA)
    documents = spark.createDataFrame([(i, f"text {i}", f"S{i}") for i in range(n)], "doc_id long, text string, source string")
    assert mixing.document_sizes(documents, targets).count() == n
