"""Risk flags, selection and cleanup on small tables."""

import pytest
from pyspark.sql import functions as F

from spoolweave.functions import tables as tb
from spoolweave.operators import fusion as fu
from spoolweave.operators import risk
from spoolweave.plans import pipeline, queries

BLOCK = "episode_id string, block_id string, sentence_ids array<string>, text string, start_sec double, end_sec double, stability_score double"
CAND = "episode_id string, block_id string, source string, text string, local_alignment_score double, alignment_score double, usable_for_agreement boolean, boundary_contamination boolean, span_drift_start int, span_drift_end int, skipped boolean"
HINT = "episode_id string, sentence_id string, start_sec double, end_sec double, text string, display_text string, boundary_hints array<struct<type:string>>"


def blocks(spark, rows):
    return spark.createDataFrame([("e", b, [f"s{b}"], t, s, e, 0.85) for b, t, s, e in rows], BLOCK)


def cands(spark, rows):
    return spark.createDataFrame([("e", b, src, t, loc, loc, True, False, 0, 0, False) for b, src, t, loc in rows], CAND)


def four(b, text, **other):
    return [(b, s, other.get(s, (text, 0.95))[0], other.get(s, (text, 0.95))[1]) for s in tb.SOURCES]


def test_grades(spark):
    rows = [(0.88, 0.88, False, "A"), (0.75, 0.75, False, "B"), (0.9, 0.9, True, "C"), (0.4, 0.45, False, "C"), (0.25, 0.0, False, "D"), (0.1, 0.9, False, "E")]
    df = spark.createDataFrame(rows, "a double, g double, r boolean, want string")
    assert all(r[0] == r[1] for r in df.select("want", risk.quality_grade(F.col("a"), F.col("g"), F.col("r"), F.lit(False))).collect())
    assert df.select(risk.quality_grade(F.lit(1.0), F.lit(1.0), F.lit(False), F.lit(True))).first()[0] == "E"


def test_number_tests_differ(spark):
    df = spark.createDataFrame([("8050", "なし"), ("８０５０", "8050"), ("a", "b")], "a string, b string")
    assert [r[0] for r in df.select(risk.numbers_differ(F.col("a"), F.col("b"))).collect()] == [True, True, False]


def test_normalized_flags(spark):
    rows = [
        ("soft_domain", 0.88, 0.82, ["domain_error_phrase"], False),
        ("soft_domain", 0.88, 0.82, ["numeric_disagreement"], True),
        ("none", 1.0, 0.95, None, False),
        ("surface", 0.9, 0.5, [], True),
        ("odd", None, None, ["large_span_drift"], True),
    ]
    df = spark.createDataFrame(rows, "k string, r double, l double, f array<string>, want boolean")
    got = df.select("want", risk.normalized_flags(F.col("k"), F.col("r"), F.col("l"), F.col("f")).alias("n")).collect()
    assert all(r.want == r.n.needs_review for r in got)
    assert got[0].n.risk_flags == ["domain_error_phrase", "soft_domain_difference"] and got[3].n.risk_flags == ["surface_difference"] and got[4].n.difference_type == "semantic"


def test_flags(spark):
    text = "今日は図書館で新しい地図を三十分ほど見直しました。"
    b = blocks(spark, [("b1", text, 0.0, 9.0), ("b2", text + "8050", 9.0, 9.1), ("b3", text, 10.0, 40.0)])
    c = cands(spark, four("b1", text) + four("b2", text + "8050", qwen=(text + "9", 0.5)) + four("b3", text, whisper=("ね。各家族", 0.6)))
    rows = {r.block_id: r for r in risk.flagged_blocks(b, c).collect()}
    assert rows["b1"].risk_flags == [] and not rows["b1"].needs_review and rows["b1"].alignment_quality == "A"
    assert {"numeric_disagreement", "qwen_alignment_low", "critical_term_disagreement", "span_too_short"} <= set(rows["b2"].risk_flags)
    assert {"domain_error_phrase", "span_too_long"} <= set(rows["b3"].risk_flags)


@pytest.mark.parametrize(
    ("text", "source", "before", "after", "want"),
    [
        ("はなしました！図書館です！", "apple", ("は", ""), ("", ""), "はなしました！図書館です！"),
        ("よ、図書館の地図です！", "qwen", ("本当よ、", ""), ("", ""), "図書館の地図です！"),
        ("ます！大きな図書館の地図です！", "qwen", ("あります！", ""), ("", ""), "大きな図書館の地図です！"),
        ("大きな図書館の地図です！次", "qwen", ("", ""), ("次の話", ""), "大きな図書館の地図です！"),
        ("それ大きな図書館の地図です！", "qwen", ("それ", ""), ("", ""), "それ大きな図書館の地図です！"),
        ("", "qwen", ("a", "a"), ("a", "a"), ""),
    ],
)
def test_clean_edges(text, source, before, after, want):
    assert fu.clean_edges(text, source, False, before, after)["clean_text"] == want


def test_validation_reverts():
    out = fu.clean_edges("ます！大きな図書館の地図でした", "qwen", False, ("あります！", ""), ("", ""))
    assert out["failed"] and out["clean_text"] == "ます！大きな図書館の地図でした" and out["reasons"] == []


@pytest.mark.parametrize("width", [5.0, 1e9])
def test_final_blocks(spark, width):
    good = "大きな図書館の地図を見ました！"
    b = blocks(spark, [("b1", good, 0.0, 9.0), ("b2", "次の話" + good, 8.0, 8.5), ("b3", "各家族の長い話をここでしました！", 20.0, 28.0), ("b4", good, 30.0, 31.0)])
    c = cands(
        spark,
        four("b1", good)
        + four("b2", good, qwen=("ました！" + good, 0.97), apple=(good, 0.2), nemotron=(good, 0.2), whisper=(good, 0.2))
        + four("b3", "核家族の長い話をここでしました！", qwen=("各家族の長い話をここでしました！", 0.97))
        + four("b4", "はい", apple=("はい", 0.9)),
    )
    units = spark.createDataFrame([("e", f"sb{i}", 0.0, 1.0, "x", None, None) for i in (1, 2, 3, 4)], HINT)
    rows = {r.block_id: r for r in fu.final_blocks(risk.flagged_blocks(b, c), units, width=width).collect()}
    assert rows["b1"].selected_source == "qwen" and rows["b1"].final_text == good
    assert rows["b2"].final_text == good and rows["b2"].cleanup_reasons == ["leading_fragment_removed"]
    assert rows["b3"].selection_method == "deterministic_domain_error_avoidance" and rows["b3"].final_text.startswith("核家族") and "domain_error_avoided" in rows["b3"].final_risk_flags
    assert (rows["b2"].start_sec, rows["b2"].end_sec) == (9.0, 9.1)
    sentences = fu.final_sentences(fu.final_blocks(risk.flagged_blocks(b, c), units, width=width), units).collect()
    assert sorted(r.sentence_id for r in sentences) == ["sb1", "sb2", "sb3", "sb4"]


def test_downgrade(spark):
    cut = "大きな図書館の地図を見ました、し"
    b = blocks(spark, [("b1", "大きな図書館の地図を見ました！", 0.0, 9.0)])
    c = cands(spark, four("b1", "大きな図書館の地図を見ました！", qwen=(cut, 0.80), apple=("大きな図書館の地図を見ました！", 0.79), nemotron=("", 0.0), whisper=("", 0.0)))
    row = fu.selected(risk.flagged_blocks(b, c)).first()
    assert row.ranked_source in ("qwen", "apple") and row.selected_source == "apple"


def test_nulls_and_empty(spark):
    b = blocks(spark, [("b1", None, None, None)])
    c = spark.createDataFrame([("e", "b1", "qwen", None, None, None, None, None, None, None, None)], CAND)
    units = spark.createDataFrame([], HINT)
    row = fu.final_blocks(risk.flagged_blocks(b, c), units).first()
    assert row.final_text == "" and row.alignment_quality == "E"
    assert fu.final_blocks(risk.flagged_blocks(b.limit(0), c), units).count() == 0


def test_metrics(spark):
    text = "大きな図書館の地図を見ました！"
    df = risk.compare(risk.wide_blocks(blocks(spark, [("b1", text, 0.0, 9.0)]), cands(spark, four("b1", text, whisper=("", 0.1)))))
    row = fu.agreement_metrics(df).first()
    assert row.apple_whisper_similarity == 0.0 and row.apple_nemotron_similarity == 1.0 and row.qwen_boundary_tainted


def test_natural_text(spark):
    rows = [("大きな図書館の地図です", "大きな図書館の地図です", True), ("大きな図書館の地図です", "別の長い話をしました", False), ("倒ブレット大きな図書館", "倒ブレット大きな図書館", False), ("短い", "短い", False), ("", "", False)]
    df = spark.createDataFrame(rows, "t string, c string, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", fu.natural_text(F.col("t"), F.col("t"), [F.col("c")])).collect())


def test_flags_are_normalised_before_selection(spark):
    # values read from normalize_block_candidate_flags and the selection after it
    text = "大きな図書館の地図を見ました！"
    other = "遠い港町で船の写真を眺めていたね！"
    b = spark.createDataFrame([("e", i, [f"s{i}"], text, s, s + 9.0, 0.2) for i, s in (("b1", 0.0), ("b2", 10.0), ("b3", 20.0))], BLOCK)
    c = cands(spark, four("b1", text, whisper=(text, 0.5)) + four("b2", text, qwen=(other, 0.95)) + four("b3", text, qwen=(text, 0.5)))
    raw = {r.block_id: r for r in risk.flagged_blocks(b, c).collect()}
    assert raw["b1"].risk_flags == ["apple_unstable", "whisper_alignment_low"] and "soft_domain_difference" in raw["b2"].risk_flags
    run = pipeline.run_fusion(spark.createDataFrame([], HINT), b, c)
    want = {"b1": ([], False), "b2": (["qwen_apple_disagreement"], True), "b3": ([], True)}
    for rows in (run.flagged, run.finals):
        assert {r.block_id: (r.risk_flags, r.needs_review) for r in rows.collect()} == want
    assert {r.block_id: r.final_risk_flags for r in run.finals.collect()} == {k: v[0] for k, v in want.items()}
    assert {r.block_id: (r.needs_review_reason, r.auto_accepted) for r in run.flagged.collect()} == {"b1": ([], True), "b2": (["qwen_apple_disagreement"], False), "b3": ([], False)}


def test_final_blocks_query_takes_normalised_flags(spark, tmp_path):
    text = "大きな図書館の地図を見ました！"
    spark.createDataFrame([("e", "b1", ["s1"], text, 0.0, 9.0, 0.2)], BLOCK).write.parquet(str(tmp_path / "alignment_block.parquet"))
    cands(spark, four("b1", text, whisper=(text, 0.5))).write.parquet(str(tmp_path / "block_candidate.parquet"))
    spark.createDataFrame([], HINT).write.parquet(str(tmp_path / "sentence_unit.parquet"))
    assert queries.f_final_blocks(spark, str(tmp_path)).first().final_risk_flags == []
