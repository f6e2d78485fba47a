import random

import pytest

from spoolweave.functions import charmap as cm
from spoolweave.llm import repetition as rep


def share(text):
    s = "".join(c for c in text.casefold() if c.isalnum())
    covered, seen = [False] * len(s), set()
    for i in range(len(s) - 7):
        g = s[i : i + 8]
        if g in seen:
            covered[i : i + 8] = [True] * 8
        seen.add(g)
    return sum(covered), len(s)


def texts():
    rng = random.Random(1)
    out = ["", "a", "abcdefgh", "ああああああああああ", "Sure, " * 20, "x" * 9, "abcdefgh abcdefgh", "１２３ 一二三 " * 9, "word " * 5000]
    for _ in range(300):
        piece = "".join(rng.choice("abc éか, ") for _ in range(rng.randint(0, 40)))
        out.append(piece + piece[: rng.randint(0, 40)] * rng.randint(0, 3))
    return out


def test_exact_share():
    for t in texts():
        letters, at = cm.folded([t], marks=True)
        s, n = share(__import__("unicodedata").normalize("NFKC", t))
        assert (rep.repeated_letters(letters), len(letters)) == (s, n), t


@pytest.mark.parametrize("order", [list(rep.RULES), list(rep.RULES)[::-1]])
def test_cascade_is_sound(order):
    for t in texts():
        letters, _ = cm.folded([t], marks=True)
        n = len(letters)
        assert rep.prevails(letters, order) == (n > 8 and rep.repeated_letters(letters) * 2 >= n), t


def test_plan_is_by_rejections_per_cost_of_what_is_left(monkeypatch):
    """With made-up rules and a made-up clock the order can be told by hand."""
    cost = {"cheap": 1.0, "dear": 50.0, "same": 2.0, "idle": 0.1}
    now = [0.0]

    def rule(name, test):
        def run(x):
            now[0] += cost[name]
            return test(len(x))

        return run

    monkeypatch.setattr(rep, "RULES", {"dear": rule("dear", lambda n: n < 9), "same": rule("same", lambda n: n < 4), "cheap": rule("cheap", lambda n: n < 5), "idle": rule("idle", lambda n: False)})
    sample = [rep.np.zeros(n) for n in range(1, 13)]
    steps = rep.plan_rules(sample, lambda: now[0])
    # "same" rejects nothing that "cheap" has left, and "idle" nothing at all
    assert [(s.rule, s.seen, s.rejected) for s in steps] == [("cheap", 12, 4), ("dear", 8, 4)]


def test_table(spark):
    rows = [("e", "b1", "qwen", "so on and so on " * 9), ("e", "b1", "qwen", "so on and so on " * 9), ("e", "b2", "apple", None), (None, "b3", None, "no no no no no no no"), ("e", "b4", "apple", "one plain remark")]
    df = spark.createDataFrame(rows, "episode_id string, block_id string, source string, text string").selectExpr("*", "1 as letters")
    keys = ["episode_id", "block_id", "source"]
    assert sorted(map(tuple, rep.repetitive(df, "text", keys).collect()), key=str) == sorted([("e", "b1", "qwen"), (None, "b3", None)], key=str)
    shares = {r.block_id: r for r in rep.repetition_shares(df, "text", keys).collect()}
    assert len(shares) == 4 and shares["b2"].share == 0.0 and shares["b1"].prevails
    assert [r.place for r in rep.cascade(df, "text", keys).collect()] == list(range(1, rep.cascade(df, "text", keys).count() + 1))
    assert rep.repetitive(df.limit(0), "text", keys).count() == 0
