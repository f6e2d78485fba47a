import random

import numpy as np
import pytest

from spoolweave.llm import sentences as st

CASES = [
    "そうですね。|最初に、回線が細かったという話を聞きました。",
    "J. K. Tavko of Veld & Co. Ltd. sent a map for 1,200.50 a month. |They moved to Veld & Co. |What a day!",
    "Mr. Ilddle Jr. and Prof. Fenildo compared the maps vs. the list.",
    "Le Dr. Nelmit cite l'art. 4, al. 2, etc. dans sa note. |« Comme il pleuvait. » |Oui.",
    "Mme Brissa a lu « Attendez. On reprend. » puis elle est partie.",
    "Dr. Zureth hat am 3. Mai ca. 2,5 Mio. Zeilen gezählt. |„Das war alles.“ |Wir sammeln Karten usw. |Danach nicht.",
    "El Sr. Morova anotó aprox. 3,5 % en la pág. 45. |«¿Es sencillo?», preguntó la guía. |¡Vamos!",
    "Dr.カゼリナは「本当にずいぶん高価？」と聞き返しました。|「もう帰ろう。」と言いました！？|次です。",
    "港の係員は、その時刻を確認することができませんでしたと話しています。",
    "名簿を隠しました\n|ちなみに、静かだと感じます ところで便利です".replace(" と", " |と"),
    "地味です高価ですところで橋で並べました".replace("高", "|高").replace("とこ", "|とこ"),
    "“先等一下。马上回来。”山村老师说完就走了。|No.49里写着（注意。）三个字。",
    "我觉得特别精确  |因为声音太小，所以测量了",
    '"정말입니까?" 하고 물었습니다. |"길이 막혀서 정리했습니다." |이것은 v46.0입니다.',
    "[00:03:33] (笑) えっと、うん。|窓口に行きました[音楽]。",
    "Well... the courier never stored it, i.e. nobody did. |Ｍｒ. Ｍｏｒｏｖａ left at 5 p.m. with us.",
    "The owner left at 5 p.m. |Before that, she came at 3.30 p.m. with maps.",
    "[Host]\nThe road was blocked. |(laughter) |Yes.".replace("(laughter) |", "(laughter) ").replace("blocked. |", "blocked. ").replace("Yes", "|Yes"),
]


@pytest.mark.parametrize("case", CASES)
def test_cases(case):
    text = case.replace("|", "")
    want, at = [], 0
    for piece in case.split("|")[:-1]:
        at += len(piece)
        want.append(at)
    assert st.sentence_starts(text)[1:] == want


def test_chunk_functions_equal_the_walk():
    rng = random.Random(3)
    symbols = [[rng.randrange(st.SYMBOLS) for _ in range(rng.choice((0, 1, 5, 40)))] for _ in range(30)]
    nxt, _ = st.transducer()
    for row, fn in zip(symbols, st.chunk_functions(symbols), strict=True):
        for s in range(st.STATES):
            state = s
            for y in row:
                state = nxt[state][y]
            assert fn[s] == state


def test_nothing():
    assert st.sentence_starts(None) == st.sentence_starts("") == st.sentence_starts("(笑) えっと… [00:00:01]") == []


def test_prefix_scan_equals_sequential():
    rng = np.random.default_rng(0)
    fns = rng.integers(0, st.STATES, (37, st.STATES)).astype(np.int16)
    done = st.compose_scan(fns)
    for s in range(st.STATES):
        state = s
        for k in range(len(fns)):
            state = fns[k][state]
            assert done[k][s] == state


def long_text(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(CASES).replace("|", "") + rng.choice(["", " ", "\n", "  "]) for _ in range(n))


@pytest.mark.parametrize("seed", range(12))
def test_chunk_size_changes_nothing(seed):
    text = long_text(seed, 5 + 25 * seed)
    whole = st.sentence_starts(text, len(text) + 1)
    assert whole
    for size in (8, 64, 300, 1000, 16_384):
        assert st.sentence_starts(text, size) == whole


def test_length_changes_nothing():
    """A passage is split alike alone, many times over, and in a batch with others."""
    pair = "Dr. Zureth sagte: „Das war alles.“ Wir sammeln Karten usw. Danach nicht. "
    one = st.sentence_starts(pair)
    many = st.sentence_starts(pair * 500)
    assert many == [k * len(pair) + p for k in range(500) for p in one]
    assert st.batch_starts([pair, None, pair * 500, ""]) == [one, [], many, []]
    han = "我觉得特别精确  因为声音太小，所以测量了  "
    count = len(st.sentence_starts(han * 400))
    assert count == 800
    # kana at the end turn the Chinese rules off around them only
    assert len(st.sentence_starts(han * 400 + "です")) >= count - 8


def test_long_texts_over_many_tasks(spark):
    text = long_text(4, 120)
    rows = [("e", "long", text), ("e", "long", text), ("e", "short", "One. Two."), (None, None, text[:5000]), ("e", "none", None)]
    df = spark.createDataFrame(rows, "episode_id string, sentence_id string, t string").selectExpr("*", "'x' as sentence_no")
    got = {}
    for r in st.split_sentences(df, "t", ["episode_id", "sentence_id"], spread=600, far_chunk=300).collect():
        got.setdefault((r.episode_id, r.sentence_id), []).append((r.sentence_no, r.char_pos))
    want = {k: st.sentence_starts(t) for k, t in ((r[:2], r[2]) for r in rows) if t}
    assert {k: [p for _, p in sorted(v)] for k, v in got.items()} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t string")
    assert st.split_sentences(df, "t", ["k"]).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("行きます 「はい」と言った", [0, 5]),
        ("他来了.「好」", [0, 4]),
        ("他来了.）我走", [0, 5]),
        ("他来了︒我走", [0, 4]),
        ("Wir kauften Brot usw.Danach gingen wir", [0, 21]),
    ],
)
def test_shortcut_drops_no_boundary(text, want):
    assert st.sentence_starts(text) == st.sentence_starts(text + " ")[: len(want)] == want


def test_chunks_follow_the_rules_of_the_whole_text(spark):
    han = "今日去北京 明天回上海 后天休息。" * 60
    latin = "Well done! it was fine. and then they left? yes. " * 30
    quoted = "Sie sagte „" + "wir sammeln alte Karten und " * 11 + "mehr.“ Danach gingen wir. "
    rows = [(1, "これはペンです。" + han + latin), (2, "안녕하세요. " + latin + han), (3, quoted * 12)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = {}
    for r in st.split_sentences(df, "text", ["id"], spread=100, far_chunk=64).collect():
        got.setdefault(r.id, []).append(r.char_pos)
    assert {k: sorted(v) for k, v in got.items()} == {k: st.sentence_starts(t) for k, t in rows}
