import itertools
from types import SimpleNamespace

import pytest

from spoolweave.llm import lookalike as la


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Take 798 ﾏｲｸ", "Ｔａｋｅ ７９８ マイク", True),
        ("Іch ɡlaubе", "Ich glaube", True),
        ("café", "café", True),
        ("タ方、窓ロに", "夕方、窓口に", True),
        ("⼭あい", "山あい", True),
        ("a b", "a b", True),
        ("so​ft­ly", "softly", True),
        ("각", "각", True),
        ("vе\u0301rifié", "vérifié", True),
        ("No\u0451l", "Noël", True),
        ("𝐇𝐞𝐥𝐥o 𝟐𝟎", "Hello 20", True),
        ("cop oca a Россия он", "сор оса а Россия он", True),
        ("\U0002f804字", "你字", True),
        ("ещё всё", "ещe всe", False),
        ("cafe", "café", False),
        ("Take", "take", False),
        ("a  b", "a b", False),
        ("が", "か", False),
        ("ok.", "ok.!", False),
    ],
)
def test_forms(a, b, same):
    fa, fb = la.forms([a, b])
    assert (fa == fb) == same
    assert la.forms([fa]) == [fa]  # stable


def test_spelling():
    assert la.forms(["データ"]) == ["データ"] and la.forms(["夕方"]) == ["夕方"] and la.forms(["ロ"]) == ["ロ"]
    assert la.forms(["москва"]) == ["москва"]  # a word of one foreign script keeps it
    for text in ("сор оса а Россия он", "Ещё раз: всё её. А он?", "Ναι, το ξέρω. Άρα ναι.", "Он сказал. The fair was over."):
        assert la.forms([text]) == [text]  # words of either script stay with their sentence
    assert la.forms(["cop oca a Россия он"]) == ["сор оса а Россия он"] and la.forms(["Тhe сор саmе in"]) == ["The cop came in"]
    assert la.kinds("сор", "cop") == "whole" and la.kinds("ﾏｲｸ", la.forms(["ﾏｲｸ"])[0]) == "form" and la.kinds("窓ロ", la.forms(["窓ロ"])[0]) == "mixed"
    assert la.script_sets("moc") and la.spell_token("ab") == "ab"
    assert la.kinds("tеst", la.forms(["tеst"])[0]) == "mixed" and la.kinds("plain", "plain") == "none"


def test_unicode_classes(spark):
    classes = la.unicode_classes(spark)
    assert len(classes) > 100 and all(chr(to).isascii() and chr(to).isalpha() for _, to in classes)
    assert la.forms(["Ꭺ map"], classes) == ["A map"] and la.forms(["A map"], classes) == ["A map"]


class _Jvm:
    """Spark's JVM with another package com."""

    def __init__(self, jvm, com):
        self._all, self.com = jvm, com

    def __getattr__(self, name):
        return getattr(self._all, name)


def _answering(shapes):
    checker = SimpleNamespace(getSkeleton=shapes)
    builder = SimpleNamespace(build=lambda: checker)
    return SimpleNamespace(ibm=SimpleNamespace(icu=SimpleNamespace(text=SimpleNamespace(SpoofChecker=SimpleNamespace(Builder=lambda: builder)))))


@pytest.mark.parametrize(
    ("com", "message"),
    [
        (None, "cannot be read"),  # no such library
        (_answering(lambda text: 1 / 0), "cannot be read"),
        (_answering(lambda text: text + "\nx"), "shapes for"),
        (_answering(lambda text: text), "no confusables data"),
    ],
)
def test_no_classes_is_an_error(spark, monkeypatch, com, message):
    sc = spark.sparkContext
    df = spark.createDataFrame([("e", "s1", "There were 12 ways to Ꭺ copy the map."), ("e", "s2", "There were 12 ways to A copy the map.")], "episode_id string, sentence_id string, text string")
    whole = la.look_pairs(la.look_prints(df, "text", ["episode_id", "sentence_id"]), ["episode_id"], "sentence_id").collect()
    assert [tuple(r) for r in whole] == [("e", "s1", "s2")]
    monkeypatch.setattr(sc, "_jvm", _Jvm(sc._jvm, com or sc._jvm.absent))
    for of in (la.look_prints, la.consistent_text):
        with pytest.raises(RuntimeError, match=message):
            of(df, "text", ["episode_id", "sentence_id"])


def test_pairs(spark):
    base = "There were 12 ways to copy the map."
    rows = [
        ("e", "s1", base), ("e", "s1", base), ("e", "s2", base.replace("e", "е")), ("e", "s3", base.replace(" ", " ")), ("e", "s4", base),
        ("e", "s5", base.upper()), ("f", "s1", base), ("e", "s6", None), ("e", "s7", ""), ("e", "s8", "shоrt"), ("e", "s9", "short"), (None, "s1", base),
    ]
    df = spark.createDataFrame(rows, "episode_id string, sentence_id string, text string").selectExpr("*", "1 as form_id2")
    got = {tuple(r) for r in la.look_pairs(la.look_prints(df, "text", ["episode_id", "sentence_id"]), ["episode_id"], "sentence_id").collect()}
    forms = dict(zip([r[:2] for r in rows], la.forms([r[2] or "" for r in rows]), strict=False))
    want = set()
    for x, y in itertools.product(rows, rows):
        if x[0] == y[0] == "e" and x[1] < y[1] and x[2] and y[2] and x[2] != y[2] and forms[x[:2]] == forms[y[:2]] and la.letters(forms[x[:2]]) >= 20:
            want.add(("e", x[1], y[1]))
    assert got == want and len(want) == 5
