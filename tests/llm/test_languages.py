import pytest

from spoolweave.llm import languages as lg

SAMPLES = {
    "en": "Because the road was blocked, we printed the new map in the library. The courier stored the list of members near the harbour. They told us that the budget had shrunk.",
    "de": "Weil die Straße gesperrt war, haben wir die neue Karte in der Bibliothek gedruckt. Der Bote hat die Mitgliederliste am Hafen gespeichert. Das Geld wurde knapp.",
    "fr": "Comme la route était fermée, nous avons imprimé la nouvelle carte dans la bibliothèque. Le coursier a rangé la liste des membres près du port. Le budget avait baissé.",
    "es": "Como la carretera estaba cerrada, hemos impreso el mapa nuevo en la biblioteca. El mensajero ha guardado la lista de socios cerca del puerto. El presupuesto había bajado.",
    "ja": "道が混んでいたので、図書館で新しい地図を印刷しました。配達の青年は港で会員の名簿を保存しました。予算が減ったという話を聞きました。",
    "zh": "因为路上太堵，所以我们在图书馆打印了新的地图。送信的小伙子在码头保存了名单。听说预算减少了。",
    "ko": "길이 막혀서 우리는 도서관에서 새 지도를 인쇄했습니다. 우체국 청년은 항구에서 명단을 보관했습니다. 예산이 줄었습니다.",
}
SCHEMA = "doc_id long, text string, lang string"


def rows():
    out, i = [], 0
    for k, t in SAMPLES.items():
        for n in range(12):
            out.append((i, " ".join([t] * (1 + n % 3)), {"ja": "ja-JP"}.get(k, k) if n else "en"))
            i += 1
    return out


def test_found(spark):
    extra = [
        (900, SAMPLES["de"], None), (901, SAMPLES["de"], "fr"), (902, SAMPLES["de"] + "\n" + SAMPLES["ja"] + " " + SAMPLES["en"], "de"),
        (903, SAMPLES["en"], "English"), (904, "12:30 …", None), (905, "", None), (906, None, "de"), (907, SAMPLES["fr"], "  "), (908, SAMPLES["es"], "it"),
        (909, SAMPLES["ja"][:26] + "“The road was new”" + SAMPLES["ja"][26:], "jpn"), (900, SAMPLES["de"], None),
    ]
    df = spark.createDataFrame(rows() + extra, SCHEMA).selectExpr("*", "1 as label", "2 as seg_no")
    got = {}
    for r in lg.mislabelled(df).collect():
        got.setdefault(r.doc_id, []).append((r.seg_no, r.seg_lang))
    wrong = {i: k for i, (k, n) in enumerate((k, n) for k in SAMPLES for n in range(12)) if n == 0 and k != "en"}
    want = {i: [(1, k)] for i, k in wrong.items()} | {900: [(1, "de")], 901: [(1, "de")], 902: [(1, "de"), (2, "ja"), (3, "en")], 907: [(1, "fr")], 908: [(1, "es")]}
    assert {k: sorted(v) for k, v in got.items()} == want
    segments = lg.language_segments(df).where("doc_id = 902").collect()
    assert all(0 < r.confidence <= 1 and r.letters > 20 for r in segments)
    whole = {r.doc_id: r for r in lg.document_languages(lg.language_segments(df).distinct()).collect()}
    assert whole[902].languages == 3 and 0 < whole[902].share < 1 and whole[901].lang == "de" and whole[901].share == 1.0 and 904 not in whole


def test_false_positives_are_corrected():
    f = lg.build_filters([(k, t) for k, t in SAMPLES.items()])
    grams = lg.Grams(["zq xj vw kkq wzx jjq"])
    counts, size = f.counts(grams)
    assert (counts <= size[:, None]).all() and counts.sum() <= size.sum()
    assert (f.false < 0.01).all()


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert lg.mislabelled(df).count() == 0


@pytest.mark.parametrize(("label", "want"), [("ja-JP", "ja"), ("ENG", "en"), ("Spanish", "es"), ("", None), (None, None), ("und", None), ("it", "it"), (" - ", None)])
def test_labels(spark, label, want):
    df = spark.createDataFrame([(label,)], "lang string")
    assert df.select(lg.canonical_label(df.lang)).first()[0] == want
