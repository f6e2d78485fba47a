"""Golden cases of the text functions."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spoolweave.functions import numeric as nm
from spoolweave.functions import tables as tb
from spoolweave.functions import text as tx


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'array<string>' if isinstance(v, list) else 'int'}" for k, v in values.items()))
    return row.select(column.alias("out")).first()[0]


@pytest.mark.parametrize(
    ("raw", "match", "index"),
    [
        ("ＤＮＡ、 8050！", "dna8050", [0, 1, 2, 5, 6, 7, 8]),
        ("Straße", "strasse", [0, 1, 2, 3, 4, 4, 5]),
        ("㍿A", "株式会社a", [0, 0, 0, 0, 1]),
        ("コーヒー", "コーヒー", [0, 1, 2, 3]),
        ("…½", "12", [1, 1]),
        ("", "", []),
    ],
)
def test_match_text(raw, match, index):
    assert tx.match_value(raw) == match and tx.raw_index_value(raw).tolist() == index


def test_display_text():
    assert tx.display_value("a  　 b") == "a b" and tx.match_value("a  　 b") == "ab" and tx.display_value("…½") == "...1⁄2"


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=30))
def test_match_text_against_definition(raw):
    want, index = [], []
    for i, ch in enumerate(unicodedata.normalize("NFC", raw)):
        for c in unicodedata.normalize("NFKC", ch).casefold():
            if not c.isspace() and unicodedata.category(c)[0] not in "PS":
                want.append(c)
                index.append(i)
    assert tx.match_value(raw) == "".join(want) and tx.raw_index_value(raw).tolist() == index


def test_artifact_and_spans(spark):
    df = spark.createDataFrame([("ab㍿c",), (None,)], "t string").select(F.struct(*tx.text_artifact(F.col("t"))).alias("a"))
    rows = df.select("a.*", tx.raw_span(F.col("a.raw_index"), F.lit(1), F.lit(4)).alias("s"), tx.norm_span(F.col("a.raw_index"), F.lit(2), F.lit(3)).alias("n"), tx.raw_span(F.col("a.raw_index"), F.lit(9), F.lit(12)).alias("z")).collect()
    assert rows[0].match_norm_text == "ab株式会社c" and tuple(rows[0].s) == (1, 3) and tuple(rows[0].n) == (2, 6) and tuple(rows[0].z) == (0, 0)
    assert rows[1].match_norm_text is None


@pytest.mark.parametrize(
    ("text", "shown", "hints"),
    [("はい、一体", "はい。一体", 1), ("はい。", "はい。", 0), ("聞いたことないですか", "聞いたことないです。か", 1), ("はい", "はい", 0), ("うん　 そう", "うん。そう", 1), ("違います", "違います", 0), (None, "", 0)],
)
def test_boundary_hint(spark, text, shown, hints):
    out = one(spark, tx.boundary_hint(F.col("t")), t=text)
    assert (out.display_text, len(out.boundary_hints)) == (shown, hints)
    if hints:
        assert out.boundary_hints[0].type == tb.HINT_TYPE and out.boundary_hints[0].confidence == 0.85


def test_conversation_display(spark):
    out = one(spark, tx.conversation_display(F.col("t")), t="なるほど一体8050問題はい")
    assert out.display_text == "なるほど。一体8050問題。はい" and out.inserted_period_count == 2 and out.boundary_hint_used_count == 2


def test_corrections_in_order(spark):
    out = one(spark, tx.corrected(F.col("t")), t="太路立った各家族")
    assert out.text == "退路を断った核家族" and [r["from"] for r in out.applied] == ["各家族", "太路", "退路立った"]
    assert one(spark, tx.corrected(F.col("t")), t=None).text == ""


def test_tokens_and_terms(spark):
    out = one(spark, tx.tokens(F.col("t")), t="８０５０と3.5 DNA カメラ 核家族")
    assert out.numbers == ["3.5", "８０５０"] and out.latin == ["DNA"] and out.katakana == ["カメラ"] and "核家族" in out.kanji
    assert one(spark, tx.digit_runs(F.col("t")), t="８０５０と3.5") == ["3", "5", "８０５０"]
    assert one(spark, tx.terms_in(F.col("t")), t="八野dna") == ["DNA", "矢野"]
    assert one(spark, tx.phrase_counts(F.col("t")), t="各家族各家族") == {"各家族": 2}


def test_fragments(spark):
    out = one(spark, tx.fragment_suggestion(F.col("t"), F.col("a")), t="ね。これは本当です、よ", a="これは")
    assert out.text == "これは本当です" and len(out.reasons) == 2
    assert one(spark, tx.fragment_suggestion(F.col("t"), F.col("a")), t="ね。これは", a="ね。これは").text == "ね。これは"
    assert one(spark, tx.trailing_cut(F.col("t")), t="話は続く依") and not one(spark, tx.trailing_cut(F.col("t")), t="")
    assert one(spark, tx.suspect_edge(F.col("t")), t=" ね。それで") and not one(spark, tx.suspect_edge(F.col("t")), t="それで")


def test_patterns(spark):
    hits = one(spark, tx.pattern_hits(F.col("t")), t="あ" * 40 + "に対して" + "い" * 40)
    assert hits[0].pattern_id == "に対して" and len(hits[0].context) == 28 * 2 + 4
    for text, level in (("", "human_required"), ("倒ブレット", "human_required"), ("、そして", "machine_note"), ("話の中", "machine_note"), ("ふつうの文。", None)):
        assert one(spark, tx.pattern_level(F.col("t")), t=text) == level


def test_time_text(spark):
    assert one(spark, nm.format_time(F.col("x")), x=59.9996) == "00:01:00,000" and one(spark, nm.format_time(F.col("x")), x=-1.0) == "00:00:00,000"
    assert one(spark, nm.parse_time(F.col("t")), t="01:02:03,450") == 3723.45
    assert tuple(one(spark, nm.proportional_time(F.lit(0.0), F.lit(10.0), F.lit(2), F.lit(4), F.lit(20)), t="x")) == (1.0, 2.0)


def test_small_things(spark):
    assert tx.canonical_json({"b": 1, "a": "あ"}) == '{"a":"あ","b":1}'
    assert one(spark, tx.first_filled(F.col("a"), F.col("b"), default="(missing)"), a=" ", b=None) == "(missing)"
    assert one(spark, tx.no_punct(F.col("t")), t="「あ、い」 (う)-え") == "あいうえ" and one(spark, tx.anchor_norm(F.col("t")), t="あ、い。 う") == "あいう"
    assert one(spark, tx.surface_norm(F.col("t")), t="子どもができる") == "子供が出来る"
    assert one(spark, tx.strip(F.col("t")), t="　a\x1c") == "a"
