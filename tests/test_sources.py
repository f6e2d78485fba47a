"""Files in, artifacts out, and the whole run."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from spoolweave.functions import tables as tb
from spoolweave.operators import joins, reports, validation
from spoolweave.operators import ordered as od
from spoolweave.plans import pipeline
from spoolweave.sources import episodes, sinks
from spoolweave.streaming import incremental

TEXT = ["最初に図書館で新しい地図を見ました。", "はい、次に港で名簿を調べました。", "それから橋の横で雲の写真を数えました。", "夕方に古い放送室で話を聞きました。", "最後に長い手紙を読みました。"]


def archive(data):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("notes.txt", "x")
        z.writestr("a.json", json.dumps(data))
    return buf.getvalue()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("in")
    for e in ("ep1", "ep2"):
        segments = [{"index": i, "startSeconds": 5.0 * i, "endSeconds": 5.0 * i + 5, "text": t} for i, t in enumerate(TEXT)]
        (d / f"{e}.MacOS-SpeechAnalyzer.json").write_text(json.dumps({"segments": segments if e == "ep1" else []}), encoding="utf-8")
        (d / f"{e}.MacOS-SpeechAnalyzer.txt").write_text("".join(TEXT), encoding="utf-8")
        whole = "".join(TEXT)
        (d / f"{e}.qwen3-asr-1.7b.txt").write_text(whole.replace("古い", "ふるい"), encoding="utf-8")
        (d / f"{e}.mlx-nemotron-3.5-asr-0.6b.txt").write_text(whole.replace("。", ""), encoding="utf-8")
        (d / f"{e}.whisper-small.txt").write_text(whole, encoding="utf-8")
    results = [{"text": {"text": t, "runs": [{"text": c, "audioTimeRange": {"startSeconds": 5.0 * i + k * 0.1, "endSeconds": 5.0 * i + k * 0.1 + 0.1}} for k, c in enumerate(t)]}, "startSeconds": 5.0 * i, "endSeconds": 5.0 * i + 5} for i, t in enumerate(TEXT)]
    (d / "ep1.MacOS-SpeechAnalyzer.raw_apple.json.zip").write_bytes(archive({"results": results}))
    (d / "ep1.MacOS-SpeechAnalyzer.raw_volatile_apple.json.zip").write_bytes(archive([{"results": results[:2]}, {"results": results}]))
    (d / "readme.md").write_text("x")
    return str(d)


def test_listing(spark, folder):
    files = episodes.list_files(spark, folder)
    kinds = {(r.episode_id, r.kind) for r in files.collect()}
    assert len(kinds) == 12 and ("ep1", "volatile_zip") in kinds and ("ep2", "whisper") in kinds
    assert episodes.list_files(spark, folder, "ep2").select("episode_id").distinct().count() == 1
    assert episodes.missing_inputs(files).count() == 0
    assert episodes.missing_inputs(files.where("kind <> 'qwen'")).first().missing == ["qwen"]
    names = spark.createDataFrame([("a.llm.json",), ("b.tar.zip",), ("c.md",)], "n string")
    assert [r[0] for r in names.select(episodes.episode_key(F.col("n"))).collect()] == ["a", "b.tar", None]


def test_archives():
    assert episodes.first_results(archive({"results": [{"text": "a"}]})) == [{"text": "a"}] and episodes.first_results(archive([1])) == [1] and episodes.first_results(None) == []
    assert episodes.first_results(archive({"x": 1})) == [] and episodes.snapshot_texts(archive([{"text": "a"}, {"text": {"text": "b"}}])) == ["ab"]


def test_timeline(spark, folder):
    rows = {r.episode_id: r for r in episodes.anchor_timeline(episodes.list_files(spark, folder, content=True)).collect()}
    whole = "".join(TEXT)
    assert rows["ep1"].full_text == rows["ep2"].full_text == whole and len(rows["ep1"].timeline) == len(rows["ep2"].timeline) == len(whole)
    assert rows["ep1"].has_snapshots == 2 and rows["ep2"].has_snapshots == 0
    assert rows["ep1"].timeline[1].start_sec == pytest.approx(0.1) and rows["ep2"].timeline[-1].end_sec == pytest.approx(len(whole) / 20)


def test_whole_run(spark, folder, tmp_path):
    run = pipeline.run_episodes(spark, folder)
    finals = run.finals.orderBy("episode_id", "start_sec").collect()
    assert {r.episode_id for r in finals} == {"ep1", "ep2"} and all(r.final_text for r in finals)
    assert validation.unassigned_sentences(run.blocks, run.units).count() == 0 and validation.doubly_assigned(run.blocks).count() == 0
    checks = validation.check_blocks(run.blocks, run.units).collect()
    assert not any(c.text_mismatch or c.time_mismatch or c.missing for c in checks)
    target = str(tmp_path / "out")
    counts = pipeline.write_run(run, target, folder)
    assert counts["final_blocks"] == len(finals)
    lines = [r[0] for r in spark.read.text(target + "/transcript").select("value").collect()]
    assert len(lines) == len(finals) and all(x.startswith("- [") for x in lines)
    with pytest.raises(FileExistsError):
        sinks.guard_output(spark, folder, target)
    with pytest.raises(ValueError):
        sinks.guard_output(spark, folder, folder + "/sub")
    with pytest.raises(RuntimeError):
        validation.check_outputs(spark, target, {"final_blocks": 10_000})
    again = pipeline.run_fusion(run.units, run.blocks, run.candidates)
    assert sorted(map(str, again.finals.collect())) == sorted(map(str, run.finals.collect()))


def test_modes(spark, folder):
    only = pipeline.run_episodes(spark, folder, "ep1", mode="qwen-only").candidates
    assert {r.skip_reason for r in only.where("source = 'whisper'").collect()} == {"qwen_only_mode"}
    staged = pipeline.run_episodes(spark, folder, "ep1", swapped=False, mode="staged")
    rows = staged.candidates.collect()
    blocks = {r.block_id for r in staged.blocks.collect()}
    assert {(r.block_id, r.source) for r in rows} == {(b, s) for b in blocks for s in ("apple", "qwen", "nemotron", "whisper")}
    with pytest.raises(ValueError):
        pipeline.run_episodes(spark, folder, "ep1", mode="other")


def test_unit_checks(spark):
    u = spark.createDataFrame([("e", "s1", "ab", 0, 2), ("e", "s2", "xd", 1, 3), ("e", "s3", "long one", 3, 11)], "episode_id string, sentence_id string, text string, char_start int, char_end int")
    t = spark.createDataFrame([("e", "abdlong one")], "episode_id string, full_text string")
    rows = {r.sentence_id: r for r in validation.check_units(u, t, width=2).collect()}
    assert rows["s2"].overlap and rows["s2"].mismatch and not rows["s1"].mismatch and rows["s1"].very_short and not rows["s3"].overlap
    s = validation.unit_summary(validation.check_units(u, t)).first()
    assert (s.units, s.overlaps, s.mismatches, s.very_short_sentence_count, s.min_sentence_length, s.max_sentence_length) == (3, 1, 1, 2, 2, 8)


def test_reports(spark):
    df = spark.createDataFrame([("e", 1, "a", ["x", "y"], 1.0), ("e", 2, "b", ["y"], 2.0), ("e", 3, "a", None, 4.0)], "k string, i int, v string, l array<string>, n double")
    assert [tuple(r) for r in reports.most_common(df, "v", ["i"]).collect()] == [("a", 2), ("b", 1)]
    assert {tuple(r) for r in reports.list_counts(df, "l").collect()} == {("x", 1), ("y", 2)}
    assert reports.top_counts(df, "v", 1).first().name == "a" and reports.top_rows(df, [], [F.desc("n")], 1).first().i == 3
    assert {r.i for r in reports.top_rows(df, ["v"], [F.desc("n")], 1).collect()} == {2, 3}
    assert tuple(reports.split_totals(df, F.col("v") == "a", "n", ["k"]).first()) == ("e", 5.0, 2.0)
    assert df.select(reports.dominant(F.create_map(F.lit("p"), F.lit(1), F.lit("q"), F.lit(3), F.lit("r"), F.lit(9)), ("r",))).first()[0] == "q"
    assert sinks.markdown_counts(reports.value_counts(df, "v").where("name = 'a'"), "t").first().line == "- a: 2"


def test_joins(spark):
    left = spark.createDataFrame([("e", 1, 0.0, 100.0), ("e", 2, 50.0, 51.0), ("e", 3, 5.0, 4.0)], "k string, l_id int, l_start double, l_end double")
    right = spark.createDataFrame([("e", i, 10.0 * i, 10.0 * i + 12) for i in range(12)] + [("f", 99, 0.0, 9.0)], "k string, r_id int, r_start double, r_end double")
    got = {(r.l_id, r.r_id) for r in joins.interval_overlap(left, right, ["k"], 7.0).collect()}
    want = {(a.l_id, b.r_id) for a in left.collect() for b in right.collect() if a.k == b.k and a.l_end >= a.l_start and b.r_end >= a.l_start and b.r_start <= a.l_end}
    assert got == want
    df = spark.createDataFrame([("e", float(i), v) for i, v in enumerate([None, 2.0, None, None, 8.0, None])], "k string, t double, v double").withColumn("id", F.col("t"))
    for width in (1.0, 2.0, 50.0):
        rows = joins.interpolated(od.with_blocks(df, "t", width), ["k"], "t", "id", "v", "f").orderBy("t").collect()
        assert [r.f for r in rows] == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0]
    texts = spark.createDataFrame([(["a", "ab", "ab", "x"],), ([],)], "t array<string>")
    assert [tuple(r[0]) for r in texts.select(joins.rewrites(F.col("t"))).collect()] == [(2, 1), (0, 0)]
    assert texts.select(joins.stability_score(F.lit(0), F.lit(0))).first()[0] == pytest.approx(0.82)


def test_stream(spark, tmp_path):
    rows = [("e", f"b{i}", "critical" if i % 2 else "none", 0.9, ["numeric_disagreement"] if i % 3 == 0 else [], {"local_alignment_score": 0.95, "alignment_score": 0.9}, f"2025-01-01T00:0{i}:00Z") for i in range(6)]
    src = tmp_path / "src"
    src.mkdir()
    names = [f.split()[0] for f in incremental.BLOCK_ROW.split(", ")]
    stream = incremental.read_rows(spark, str(src))
    for part in (rows[:3], rows[3:]):
        (src / f"{part[0][1]}.json").write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in part))
        incremental.start(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.json(str(tmp_path / "out"))
    assert got.count() == 6 and got.where("needs_review").count() == 4
    batch = spark.read.schema(incremental.BLOCK_ROW).json(str(src))
    assert incremental.normalise(batch).count() == 6
    q = incremental.flag_counts(stream).writeStream.format("memory").queryName("flags").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("flags").agg(F.sum("count")).first()[0] == 3 + 3 + 2


def test_anchor_sources_are_read_once(spark, tmp_path):
    """Archive, final segments with gaps, fallback text and nothing; the contents pass through the plan once."""
    part = {"index": 0, "startSeconds": 1.0, "endSeconds": None, "text": "か\u3099あ", "confidence": None}
    files = {
        "a" + tb.RAW_ZIP_SUFFIX: archive({"results": [{"text": "abc", "startSeconds": 0, "endSeconds": 3}, 7]}),
        "a" + tb.FINAL_JSON_SUFFIX: json.dumps({"segments": [part]}).encode(),
        "b" + tb.RAW_ZIP_SUFFIX: archive({"x": 1}),
        "b" + tb.VOLATILE_ZIP_SUFFIX: archive([]),
        "b" + tb.FINAL_JSON_SUFFIX: json.dumps({"segments": [part, {"text": None}, None]}).encode(),
        "c" + tb.FALLBACK_TEXT_SUFFIX: "か\u3099い".encode(),
        "d" + tb.ENGINE_SUFFIX["qwen"]: b"q",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    df = episodes.anchor_timeline(episodes.list_files(spark, str(tmp_path), content=True))
    rows = {r.episode_id: r for r in df.collect()}
    assert {k: r.full_text for k, r in rows.items()} == {"a": "abc", "b": "があ", "c": "がい", "d": ""}
    assert {k: r.has_snapshots for k, r in rows.items()} == {"a": 0, "b": 1, "c": 0, "d": 0} and rows["d"].timeline is None and rows["c"].source_file is None
    assert [x.start_sec for x in rows["a"].timeline] == [0.0, 1.0, 2.0] and rows["c"].timeline[-1].end_sec == 0.1
    assert rows["b"].timeline[0].confidence == tb.DEFAULT_CONFIDENCE and rows["b"].timeline[0].start_sec == 1.0 and len(rows["b"].timeline) == 3
    plan = df.where("length(full_text) > 0 and source_file is not null").select("full_text", F.size("timeline"), "has_snapshots")._jdf.queryExecution().executedPlan().toString()
    above = plan.split("SortAggregate")[0]
    assert above.count("MapInPandas") == 1 and "ArrowEvalPython" not in above
