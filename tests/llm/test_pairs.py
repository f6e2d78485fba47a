import numpy as np
import pytest

from spoolweave.llm import crf, languages, pairs

HEAD = "Pick the transcript candidate that reads best."
TEXTS = [
    "The courier stored the new map near the lighthouse. Later the printer rewrote the price list in the music room.",
    "I'm sorry we could not help the ferry crew that night, they said. The road was blocked for the whole of the week.",
    "隣の建築士は港で新しい地図を調べました。夕方、若い研究員は水位の記録を図書館で見直しました。",
    "Der Drucker hat die neue Karte in der alten Bibliothek gezählt. Am Ende war alles ruhiger als gedacht.",
    "Le libraire a imprimé la nouvelle carte dans les archives. Nous avons trié la liste des membres ce matin.",
]


def prompt(text):
    return HEAD + "".join(f"\n{e}: {text}" for e in ("apple", "qwen", "nemotron", "whisper"))


ROWS = [(i, prompt(t + f" No. {i} of the list.")) for i, t in enumerate(TEXTS * 12)]
#: Speech in the languages of the texts, as labelled documents hold it.
TALK = [
    ("en", "The courier stored the map. They said the road was blocked for the whole week, and the ferry crew could not help that night. What a day! I think it was fine, to be honest."),
    ("en", "Later the printer rewrote the price list in the music room near the lighthouse. Because nobody noticed, we measured the water level again."),
    ("ja", "隣の建築士は港で新しい地図を調べました。夕方、若い研究員は水位の記録を図書館で見直しました。そうですね、回線が細かったと思います。"),
    ("de", "Der Drucker hat die neue Karte in der alten Bibliothek gezählt. Am Ende war alles ruhiger als gedacht. Wir haben die Liste der Mitglieder im Archiv sortiert."),
    ("fr", "Le libraire a imprimé la nouvelle carte dans les archives. Nous avons trié la liste des membres ce matin. Heureusement, tout était assez compliqué."),
    ("es", "El librero ha ordenado el letrero de la muestra en la hoja azul. Como llovía sin parar, hemos reescrito el guion del episodio en la azotea."),
] * 4


@pytest.fixture(scope="module")
def model():
    return pairs.fit_pairs(ROWS, TALK)


@pytest.mark.parametrize(
    ("text", "answer", "want"),
    [
        (0, TEXTS[0], None),
        (1, TEXTS[1], None),
        (0, TEXTS[0][:40], "truncated"),
        (2, TEXTS[2][:25] + "…", "truncated"),
        (2, TEXTS[2][:-1], None),
        (0, HEAD.upper(), "copied_prompt"),
        (2, "申し訳ありませんが、お答えできません。", "refusal"),
        (3, "Unfortunately I must decline, since the audio is not available to me.", "refusal"),
        (0, TEXTS[4], "other_language"),
        (2, TEXTS[3], "other_language"),
        (0, '{"selected_source":"qwen","final_text":"' + TEXTS[0][:50], "truncated"),
        (0, '{"final_text": "' + TEXTS[0] + '", "confidence": 0.9}', None),
    ],
)
def test_defects(model, text, answer, want):
    head, cands = pairs.split_prompt(prompt(TEXTS[text]))
    assert model.defects([(head, cands, pairs.unwrap(answer))]) == [want]


@pytest.mark.parametrize(
    "answer",
    [
        "I won't be answering that one.",
        "That falls outside what I do, please ask someone else.",
        "No comment on this from me.",
        "Non mi è possibile dare una risposta a questa domanda.",
        "Infelizmente não posso ajudar com este pedido.",
        "Helaas kan ik u hier niet bij helpen.",
        "К сожалению, я не могу помочь с этой просьбой.",
        "Bohužel na to nemohu odpovědět.",
        "回答は差し控えます。",
        "Da muss ich passen.",
    ],
)
def test_refusals_not_learnt_from(model, answer):
    assert answer not in pairs.REFUSAL_SEEDS
    for t in TEXTS:
        head, cands = pairs.split_prompt(prompt(t))
        assert model.defects([(head, cands, answer)]) == ["refusal"]


def test_speakers_decline_as_well(model):
    for t in ("Désolée, nous ne pouvions pas aider ce soir-là.", "그날은 도와드릴 수 없었습니다.", "Lo siento, no pudimos ayudar aquella noche."):
        head, cands = pairs.split_prompt(prompt(t))
        assert model.defects([(head, cands, t), (head, cands, t.lower().replace(".", "")), (head, cands, "N/A")]) == [None, None, "empty"]
    head, cands = pairs.split_prompt(prompt("Lo siento, no pudimos ayudar aquella noche."))
    assert model.defects([(head, cands, TEXTS[2])]) == ["other_language"]


def test_batch_equals_one_by_one(model):
    every = [(*pairs.split_prompt(prompt(t)), a) for t in TEXTS for a in (*TEXTS, "", "No.", HEAD, TEXTS[0][:30], "Entschuldigung, dazu sage ich nichts.", TEXTS[1] * 40)]
    assert model.defects(every) == [model.defects([p])[0] for p in every]


def test_viterbi_all_equals_viterbi():
    rng = np.random.default_rng(1)
    field = crf.Crf(rng.normal(size=(5, 4)), rng.normal(size=(4, 4)), rng.normal(size=4))
    xs = [rng.normal(size=(n, 5)) for n in (3, 1, 7, 2, 2, 0, 5)]
    first = np.concatenate(([0], np.cumsum([len(x) for x in xs])))
    got = field.viterbi_all(np.concatenate(xs), first)
    assert got.tolist() == [t for x in xs if len(x) for t in field.viterbi(x)]


def test_held_out_tags():
    """Fitted on half of the prompts, and scored on clauses made from the other half."""
    m = pairs.fit_pairs(ROWS[::2], TALK)
    prompts = [pairs.split_prompt(p) for _, p in ROWS[1::2]]
    made = pairs.training_pairs(prompts, pairs.REFUSAL_SEEDS, pairs.PLACEHOLDERS, m.tongue, pairs.random.Random(3))
    batch = pairs.Batch([x[:3] for x in made], m.tongue, m.speech)
    tags = m.field.viterbi_all(batch.x, np.searchsorted(batch.row, np.arange(len(made) + 1)))
    assert np.mean(tags == np.array([t for x in made for t in x[3]])) > 0.95


def test_empty_answers(model):
    head, cands = pairs.split_prompt(prompt(TEXTS[0]))
    for x in ("", " 　\n", "N/A", "(なし)", "「」", '""', "​", "…", "null", "-"):
        assert model.defects([(head, cands, x)]) == ["empty"]
    assert model.defects([(head, cands, TEXTS[0])]) == [None]


def test_without_prompts_or_documents():
    m = pairs.fit_pairs([], [])
    assert m.defects([("", [], ""), ("", [], "I cannot help with this request."), ("", [], "The map was blue.")]) == ["empty", None, None]
    assert languages.told(np.zeros((0, 7)), np.zeros(0)).tolist() == []


def test_table(spark):
    rows = [
        (1, prompt(TEXTS[0]), True, "apple", TEXTS[0]), (2, prompt(TEXTS[0]), True, "no_change", ""), (3, prompt(TEXTS[0]), True, "qwen", None), (3, prompt(TEXTS[0]), True, "qwen", None),
        (4, prompt(TEXTS[0]), False, None, None), (5, None, True, "apple", "I cannot help with this request."), (6, prompt(TEXTS[2]), True, "apple", TEXTS[2][:20]), (7, "", True, None, TEXTS[0] * 300),
    ] + [(100 + i, p, True, "apple", pairs.split_prompt(p)[1][0]) for i, p in ROWS]
    df = spark.createDataFrame(rows, "request_id long, prompt_text string, success boolean, selected_source string, final_text string").selectExpr("*", "1 as defect")
    talk = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(TALK)], "doc_id long, text string, lang string")
    assert sorted(map(tuple, pairs.broken_pairs(df, talk).collect())) == [(3, "empty"), (5, "refusal"), (6, "truncated")]
    assert pairs.broken_pairs(df.limit(0), talk).count() == 0
