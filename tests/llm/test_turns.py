"""Problem 1 against a sequential brute force, and the grammar on its own."""

import random

import pytest

from spoolweave.llm import turns
from spoolweave.llm.lookalike import forms

UNITS = (
    "episode_id string, sentence_id string, start_sec double, end_sec double, text string, "
    "boundary_hints array<struct<type:string,char_pos_in_raw:int,token:string,insert:string,reason:string,confidence:double,applies_to:array<string>>>"
)
ROSTER = "episode_id string, speaker_id string, display_name string, speaker_role string"
PEOPLE = {"e1": [("a", "Fenko", "host"), ("b", "Tavssa", "guest")], "e2": [("a", "ソヨラ", "host"), ("b", "ヒヅベエ", "guest"), ("c", "コハミチ", "narrator")]}


def hint(confidence, reason="possible_speaker_change"):
    return [("short_response_period", 2, "x", ".", reason, confidence, ["display_text"])]


@pytest.mark.parametrize(
    ("text", "label", "said"),
    [
        ("Fenko— What a day!", "fenko", True),
        ("[00:01:39] Vashko｜[aplausos]", "vashko", False),
        ("00:02:00.995 ゲスト - はい。", "ゲスト", True),
        (">> ﾄﾓﾗ: そうですね。", "トモラ", True),
        ("- ヒヅベエさん: んー。", "ヒヅベエ", False),
        ("（笑） 【拍手】", None, False),
        ("((crosstalk)) Uh…", None, False),
        ("Nelmit, you could go.", None, True),
        ("네.", None, True),
        ("", None, False),
    ],
)
def test_grammar(text, label, said):
    keys, speech, _, _ = turns.parse_unit(forms([text])[0])
    assert (label in keys if label else not keys or text[0] in "（("), keys
    assert speech == said


def test_clean_text():
    assert turns.parse_unit(forms(["<Hapeth> Euh, je pense [musique] que oui."])[0])[2] == "je pense que oui."


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("[music [laughter] fades] hello", "hello"),
        ("((music (loud [very]) fades)) hello", "hello"),
        ("[door slams] Well, yes.", "Well, yes."),
        ("(sound of rain)", ""),
        ("Yes. (sound of rain) No.", "Yes. No."),
        ("(拍手喝采) はい", "はい"),
        ("The map (the old blue one) was lost.", "The map (the old blue one) was lost."),
        ("地図は（実はこれがかなり複雑。）便利です。", "地図は(実はこれがかなり複雑。)便利です。"),
        ("♪ music ♪ *coughs* well", "well"),
        ("an [unclosed bracket stays", "an [unclosed bracket stays"),
        ("[applause] [Fenko] (laughs) hi", "hi"),
        ("[" * 3000 + "deep", "[" * 3000 + "deep"),
        ("[" * 60 + "deep" + "]" * 60 + " ok", "ok"),
    ],
)
def test_notes_by_shape_and_place(text, clean):
    _, said, body, own = turns.parse_unit(forms([text])[0])
    assert (said, body, own) == (bool(clean), clean, "")


def brute(units, people):
    """Turns by walking each episode in order."""
    out = []
    seen = {}
    for u in units:
        seen.setdefault((u[0], u[1]), u)
    for e, persons in people.items():
        keys = {}
        for i, name, role in persons:
            for word in turns.ROLE_WORDS[role].split():
                keys[turns.key_of(word.casefold())] = i
        for i, name, _ in persons:
            keys[name.casefold()[0]] = i
            keys[name.casefold()] = i
        who, turn = None, None
        for u in sorted((u for u in seen.values() if u[0] == e), key=lambda u: (u[2], u[1])):
            label, said, _, own = turns.parse_unit(forms([u[4] or ""])[0])
            named = next((keys[k] for k in label if k in keys), None)
            if named:
                who = named
            elif who and len(persons) == 2 and any(h[4] == "possible_speaker_change" and (h[5] or 0) >= 0.7 for h in u[5] or []):
                who = next(i for i, _, _ in persons if i != who)
            if who is None or not (said or (own and not named)):
                continue
            if turn and turn[1] == who:
                turn[3] = u[1]
            else:
                turn = [e, who, u[1], u[1]]
                out.append(turn)
    return sorted(map(tuple, out))


def make(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for e in PEOPLE:
        names = [p[1] for p in PEOPLE[e]]
        for i in range(n):
            kind = rng.random()
            text = rng.choice(["Right.", "はい。", "A longer remark about maps.", "[music]", "Uh…", None, ""])
            if kind < 0.25:
                text = rng.choice(["{}: ", "[{}] ", "{} - ", ">> {}: "]).format(rng.choice([*names, "Host", "ゲスト", "Nobody", names[0][0]])) + (text or "")
            h = rng.choice([None, [], hint(0.85), hint(0.5), hint(0.9, "long_pause")])
            start = float(rng.choice([i * 7, i * 7, i * 7 + 400]))
            rows.append((e, f"s{i:04d}", start, None if rng.random() < 0.1 else start + rng.choice([3.0, -1.0]), text, h))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [20.0, 90.0, 1e9])
def test_turns_equal_brute_force(spark, block):
    rows = make(3)
    units = spark.createDataFrame(rows, UNITS).selectExpr("*", "1 as block", "'x' as speaker_id")
    roster = spark.createDataFrame([(e, *p) for e, ps in PEOPLE.items() for p in ps], ROSTER)
    got = turns.speaker_turns(units, roster, block_seconds=block).collect()
    assert sorted(map(tuple, got)) == brute(rows, PEOPLE)


def test_turns_with_text_and_empty(spark):
    units = spark.createDataFrame([("e1", "s1", 0.0, 2.0, "Fenko: Uh, hello there.", None), ("e1", "s2", 3.0, 1.0, "And more.", None)], UNITS)
    roster = spark.createDataFrame([("e1", "a", "Fenko", "host"), ("e1", "b", "Tavssa", None)], ROSTER)
    row = turns.speaker_turns(units, roster, text_too=True).collect()[0]
    assert (row.clean_text, row.start_sec, row.end_sec, row.units) == ("hello there. And more.", 0.0, 3.0, 2)
    assert turns.speaker_turns(units.limit(0), roster).count() == 0
    assert turns.speaker_turns(units, roster.limit(0)).count() == 0
