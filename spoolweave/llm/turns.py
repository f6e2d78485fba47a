"""Problem 1: transcript units into clean, ordered speaker turns.

Each unit's text is parsed by a recursive parsing-expression grammar (annotations that nest,
time stamps, speaker labels in many spellings, fillers, speech); the parse tree gives the
label, the clean utterance and whether anything was said. An annotation is told by its
shape and place, not by its words: a bracket, with up to 64 brackets in each other, that holds no
sentence; round brackets of more than two words only apart from a sentence (see _is_note).
Labels are matched with the roster of the episode; a bracketed name the roster does not
know is an annotation, one before a colon or dash is speech.

The speaker at a unit is the state of a small automaton: a label sets it, a change hint
flips it (episodes of two speakers), everything else keeps it. Its effects compose, so the
running state is computed in blocks of recording time: running windows inside a block, a
scan over one summary row a block for the state carried in, and the same for turns that
cross blocks. No task holds a whole episode.

Defined cases: null text, or nothing left but labels, stamps, fillers and notes: the unit
is dropped, its label still holds. Units before the first label have no known speaker and
are left out. A unit delivered again counts once. Equal start times are ordered by
sentence_id; a unit without a start, an id or an episode is left out. A name that fits two
speakers is no label. Episodes without a roster give
nothing; empty tables give none. end_sec that is null or before start_sec is ignored for
the turn's end. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spoolweave.llm import lexicon as lx
from spoolweave.llm.lookalike import forms
from spoolweave.llm.peg import check, choice, lazy, node, opt, seq, star, tok
from spoolweave.session import cut

BLOCK_SECONDS = 600.0
MIN_HINT = 0.7
CHANGE_REASON = "possible_speaker_change"

#: Role words of a label, folded; also what the words mean in each language of the tables.
ROLE_WORDS = {
    "host": "host mc presenter moderator moderation moderatorin gastgeber gastgeberin animatrice animateur hôte hôtesse présentateur présentatrice "
    "anfitrión anfitriona presentador presentadora locutor locutora 司会 司会者 ホスト 聞き手 進行 主持 主持人 사회자 진행자 호스트 interviewer",
    "guest": "guest gast invité invitée invitado invitada ゲスト 語り手 話し手 嘉宾 来宾 客人 손님 게스트 출연자",
    "narrator": "narrator narr. narr narration sprecher sprecherin erzähler erzählerin narrateur narratrice narrador narradora ナレーター ナレーション 語り 旁白 解说 해설 내레이터 나레이터",
}
ROLE_OF = {word: role for role, words in ROLE_WORDS.items() for word in words.split()}
HONORIFIC = re.compile("(?:さん|さま|様|氏|くん|君|ちゃん|先生|老师|先生|女士|님|씨)$")

_space = tok("", "[ \\t\\n]+")
_stamp = tok("stamp", lx.STAMP)
_open, _close = tok("", lx.OPEN), tok("", lx.CLOSE)
_inner = tok("", "[^\\[\\](){}<>（）［］【】〈〉〔〕｛｝＜＞。！？!?\n]+")
_bracket = seq(_open, star(choice(lazy(lambda: _bracket), _inner)), _close)
_note_word = re.compile(f"{lx.OPEN}+[ ♪♫〜~]*(?:{lx.WORDS})[ ♪♫〜~]*{lx.CLOSE}+", re.I)
_before = re.compile("(?:^|[。！？!?.…\\])>）］】〉〕♪♫]|\\d)\\s*$")
_after = re.compile("[\\s。、．，.,!?！？…]*$")


def _is_note(text: str, a: int, b: int) -> bool:
    """Whether the bracket text[a:b] is an annotation: square, pointed or doubled, or a word or two, or apart from a sentence."""
    inner = text[a + 1 : b - 1]
    words = len(inner.split())
    if words > 8 or sum(map(str.isalnum, inner)) > 40 or re.search("[.…]\\s*$", inner):
        return False
    if text[a] not in "(（" or inner[:1] in "(（" or _note_word.fullmatch(text, a, b):
        return True
    wide = sum(c >= "\u2e80" for c in inner)
    if words <= 2 and wide <= 4:
        return True
    return _before.search(text, max(a - 8, 0), a) is not None or _after.match(text, b) is not None


_note = choice(node("note", check(_bracket, _is_note)), tok("note", "♪[^♪\n。]{0,30}♪|[♪♫][〜~]?|\\*[^*\n]{1,24}\\*|※[^※\n。]{1,12}※"))
_name = "([^\\s:|—–\\[\\]()<>【】〈〉《》{}、。,!?「」『』“”\"※*♪/-][^\\s:|—–\\[\\]()<>【】〈〉《》{}、。,!?「」『』“”\"※*♪/-]{0,23})"
_bracketed = tok("bracketed", f"[\\[(<【〈《]\\s?{_name}\\s?[\\])>】〉》]")
_arrow = tok("name", f">>\\s*{_name}\\s*:")
_dash = tok("name", f"[-–—]\\s+{_name}\\s*:")
_plain = tok("name", f"{_name}(?:\\s?[:|]|\\s?[—–](?=\\s|\\S)|\\s-\\s)")
LABEL = node("label", choice(_arrow, _dash, _plain))
#: What may stand before a label; a bracketed name is a label if the roster knows it, and else an annotation.
MARKS = star(choice(_space, _stamp, _bracketed, _note))
FILLER = tok("filler", f"(?<![\\w]){lx.FILLER}(?![\\w])[、,…\\.。]*")
WORDS = tok("text", "[\\w'’]+")
OTHER = tok("text", ".|\\n")
BODY = node("body", star(choice(_note, _stamp, FILLER, _space, WORDS, OTHER)))
#: A dash may stand between a stamp and what follows; a label after it has its own rule.
UNIT = seq(MARKS, opt(LABEL), MARKS, BODY)


def role_key(label: str | None) -> str | None:
    """The key under which a roster's labels hold the speaker of a role, if the label is a role word."""
    role = _ROLES.get(label) if label is not None else None
    return f"#{role}" if role else None


def key_of(name: str) -> str:
    """The spelling-free key of a label or a display name (already in consistent form)."""
    return HONORIFIC.sub("", name.casefold().strip()).strip()


_ROLES = {key_of(f): role for f, role in zip(forms(list(ROLE_OF)), ROLE_OF.values(), strict=True)}
SPEECH = re.compile("[^\\W_]")
SPACES = re.compile("[ \\t\\n]+")
TIDY = re.compile("^[\\s、,;:—–-]+|(?<=[\\s])(?=[、。,.!?])")
SIMPLE = re.compile("[\\[(<【〈《♪*※:|—–>\\d-]|" + lx.FILLER, re.I)


def parse_unit(text: str) -> tuple[list[str], bool, str, str]:
    """(label keys, speech without the label, clean text without the label, text that is speech if the keys name nobody)."""
    _, tree = UNIT(text, 0)
    keys, own, parts, said = [], "", [], False
    for name, value, a, b in tree:
        if name == "label":
            # names before a colon or dash go first; they are speech if nobody has them
            keys.insert(0, key_of(value[0][1].group(1)))
            own = text[a:b]
        elif name == "bracketed":
            keys.append(key_of(value.group(1)))
        elif name == "body":
            for kind, _, x, y in value:
                if kind == "text":
                    piece = text[x:y]
                    parts.append((x, piece))
                    said = said or SPEECH.search(piece) is not None
    clean, last = [], None
    for x, piece in parts:
        if last is not None and x > last and not piece.startswith(("、", "。", ",", ".", "!", "?")):
            clean.append(" ")
        clean.append(piece)
        last = x + len(piece)
    body = TIDY.sub("", SPACES.sub(" ", "".join(clean))).strip()
    return [k for k in keys if k], said, body, own


def _parse(batches: Iterator[pa.RecordBatch], text_too: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        keys, said, worded, clean, own = [], [], [], [], []
        for form in forms(texts):
            k, s, c, o = parse_unit(form)
            keys.append([x for key in k for x in (key, role_key(key)) if x])
            said.append(s)
            worded.append(bool(o))
            if text_too:
                clean.append(c)
                own.append(o)
        columns = {
            "episode_id": batch.column("episode_id"),
            "sentence_id": batch.column("sentence_id"),
            "start_sec": batch.column("start_sec"),
            "hinted": batch.column("hinted"),
            "label_keys": pa.array(keys, pa.list_(pa.string())),
            "said": pa.array(said, pa.bool_()),
            "worded": pa.array(worded, pa.bool_()),
        }
        if text_too:
            columns |= {"end_sec": batch.column("end_sec"), "clean": pa.array(clean, pa.string()), "own": pa.array(own, pa.string())}
        yield pa.RecordBatch.from_pydict(columns)


def parsed_units(units: DataFrame, text_too: bool = False) -> DataFrame:
    """Labels, speech flags and hints of the units, one row a delivered row."""
    hinted = F.exists("boundary_hints", lambda h: (h["reason"] == CHANGE_REASON) & (h["confidence"] >= MIN_HINT))
    slim = units.select("episode_id", "sentence_id", "start_sec", "end_sec", "text", F.coalesce(hinted, F.lit(False)).alias("hinted"))
    types = dict(slim.dtypes)
    schema = f"episode_id {types['episode_id']}, sentence_id {types['sentence_id']}, start_sec double, hinted boolean, label_keys array<string>, said boolean, worded boolean"
    if text_too:
        schema += ", end_sec double, clean string, own string"
    slim = slim.withColumn("start_sec", F.col("start_sec").cast("double")).withColumn("end_sec", F.col("end_sec").cast("double"))
    return slim.mapInArrow(lambda it: _parse(it, text_too), schema)


def _label_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        names = forms([n or "" for n in batch.column("display_name").to_pylist()])
        for e, s, name, role in zip(batch.column("episode_id").to_pylist(), batch.column("speaker_id").to_pylist(), names, batch.column("speaker_role").to_pylist(), strict=True):
            key = key_of(name)
            if key:
                out.append((e, s, key, 0))
                out.append((e, s, key[0], 2))
                for i in range(len(key) - 1):
                    swapped = key[:i] + key[i + 1] + key[i] + key[i + 2 :]
                    if swapped != key:
                        out.append((e, s, swapped, 3))
            role = (role or "").strip().casefold()
            if role in ROLE_WORDS:
                out.append((e, s, f"#{role}", 1))
        yield pa.RecordBatch.from_pydict(
            {n: pa.array([o[i] for o in out], t) for i, (n, t) in enumerate((("episode_id", pa.string()), ("speaker_id", pa.string()), ("label_key", pa.string()), ("rank", pa.int32())))}
        )


def roster_labels(roster: DataFrame) -> DataFrame:
    """Per episode: the speakers, and a map from label key to speaker.

    A key belongs to the speaker who has it at the best rank (name, role word, initial,
    name with two letters swapped); shared at that rank it names nobody.
    """
    clean = roster.select("episode_id", "speaker_id", "display_name", "speaker_role").where("episode_id is not null and speaker_id is not null").distinct()
    keys = clean.mapInArrow(_label_keys, "episode_id string, speaker_id string, label_key string, rank int").distinct()
    best = keys.groupBy("episode_id", "label_key").agg(F.min(F.struct("rank", "speaker_id")).alias("lo"), F.min(F.struct("rank", F.expr("-hash(speaker_id)"), "speaker_id")).alias("hi"))
    ranked = keys.join(best.select("episode_id", "label_key", F.col("lo.rank").alias("rank")).hint("merge"), ["episode_id", "label_key", "rank"])
    one = ranked.groupBy("episode_id", "label_key").agg(F.min("speaker_id").alias("speaker_id"), F.max("speaker_id").alias("other")).where("speaker_id = other")
    maps = one.groupBy("episode_id").agg(F.map_from_entries(F.collect_list(F.struct("label_key", "speaker_id"))).alias("labels"))
    people = clean.groupBy("episode_id").agg(F.array_sort(F.collect_set("speaker_id")).alias("speakers"))
    return people.join(maps.hint("merge"), "episode_id")


def _flipped(speaker, times, speakers):
    """The speaker after so many passes to the other one (two speakers)."""
    other = F.when(speaker == speakers[0], speakers[1]).otherwise(speakers[0])
    return F.when(times % 2 == 1, other).otherwise(speaker)


def spoken_units(units: DataFrame, roster: DataFrame, text_too: bool = False, block_seconds: float = BLOCK_SECONDS) -> DataFrame:
    """Units with something said, their speaker, and the time block they lie in."""
    block = F.floor(F.col("start_sec") / block_seconds)
    # parsed once: the copy is read by the labels' join, the carried states and the turns
    parsed = cut(parsed_units(units, text_too).withColumn("block", block))
    rows = parsed.repartition("episode_id", "block").dropDuplicates(["episode_id", "block", "sentence_id"])
    blocks = parsed.select("episode_id", "block").distinct().join(roster_labels(roster).hint("merge"), "episode_id")
    # a sort-merge join: the maps pack so well that their size in a shuffle says little of their size in memory
    rows = rows.join(blocks.hint("merge"), ["episode_id", "block"])
    named = F.filter(F.transform("label_keys", lambda k: F.col("labels")[k]), lambda x: x.isNotNull())
    rows = rows.withColumn("label", F.get(named, F.lit(0))).drop("labels", "label_keys")
    flip = F.col("label").isNull() & F.col("hinted") & (F.size("speakers") == 2)
    run = Window.partitionBy("episode_id", "block").orderBy("start_sec", "sentence_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("flips", F.sum(flip.cast("int")).over(run)).withColumn(
        "set_by", F.last(F.when(F.col("label").isNotNull(), F.struct("label", F.col("flips").alias("at"))), ignorenulls=True).over(run)
    )
    ends = rows.groupBy("episode_id", "block").agg(
        F.max_by("set_by", F.struct("start_sec", "sentence_id")).alias("last_set"), F.max("flips").alias("n"), F.first("speakers").alias("sp")
    )
    # scan over one row a block: the speaker carried into each block
    before = Window.partitionBy("episode_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("episode_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("total", F.sum("n").over(through)).withColumn(
        "final", F.when(F.col("last_set").isNotNull(), F.struct(_flipped(F.col("last_set.label"), F.col("n") - F.col("last_set.at"), F.col("sp")).alias("who"), "total"))
    )
    ends = ends.withColumn("from", F.last("final", ignorenulls=True).over(before))
    carry = ends.select("episode_id", "block", _flipped(F.col("from.who"), F.col("total") - F.col("n") - F.col("from.total"), F.col("sp")).alias("carried"))
    # the carried states grow with the recordings, so they are never broadcast
    rows = rows.join(carry.hint("merge"), ["episode_id", "block"])
    speaker = F.when(F.col("set_by").isNotNull(), _flipped(F.col("set_by.label"), F.col("flips") - F.col("set_by.at"), F.col("speakers"))).otherwise(
        _flipped(F.col("carried"), F.col("flips"), F.col("speakers"))
    )
    # a candidate label that names nobody is speech, if it is no bracket
    said = F.col("said") | (F.col("label").isNull() & F.col("worded"))
    rows = rows.withColumn("speaker_id", speaker).where(said & F.col("speaker_id").isNotNull())
    if text_too:
        rows = rows.withColumn("clean", F.when(F.col("label").isNull() & F.col("worded"), F.concat_ws(" ", F.trim("own"), "clean")).otherwise(F.col("clean")))
    return rows


def speaker_turns(units: DataFrame, roster: DataFrame, text_too: bool = False, block_seconds: float = BLOCK_SECONDS) -> DataFrame:
    """One row per turn: speaker, first and last sentence (and, with text_too, times and clean text)."""
    rows = spoken_units(units, roster, text_too, block_seconds)
    order = Window.partitionBy("episode_id", "block").orderBy("start_sec", "sentence_id")
    rows = rows.withColumn("new", F.coalesce(F.lag("speaker_id").over(order) != F.col("speaker_id"), F.lit(True)).cast("int"))
    rows = rows.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    place = F.struct("start_sec", "sentence_id")
    aggs = [F.min(place).alias("a"), F.max(place).alias("b"), F.first("speaker_id").alias("speaker_id")]
    if text_too:
        valid = F.when(F.col("end_sec") >= F.col("start_sec"), F.col("end_sec"))
        aggs += [
            F.max(F.coalesce(valid, F.col("start_sec"))).alias("end_sec"),
            F.count("*").alias("units"),
            F.array_sort(F.collect_list(F.struct("start_sec", "sentence_id", "clean"))).alias("said"),
        ]
    runs = rows.groupBy("episode_id", "block", "run").agg(*aggs)
    runs = runs.withColumn("runs", F.max("run").over(Window.partitionBy("episode_id", "block")))
    inner = runs.where("run > 1 and run < runs").withColumn("turn", F.lit(None).cast("struct<block:bigint,run:bigint>"))
    # only the first and last run of a block can go on in another block
    across = Window.partitionBy("episode_id").orderBy("block", "run")
    starts = (F.col("run") > 1) | F.coalesce(F.lag("speaker_id").over(across) != F.col("speaker_id"), F.lit(True))
    edge = runs.where("run = 1 or run = runs").withColumn("starts", starts)
    edge = edge.withColumn("turn", F.last(F.when(F.col("starts"), F.struct("block", "run")), ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merge = [F.min("a").alias("a"), F.max("b").alias("b"), F.first("speaker_id").alias("speaker_id")]
    columns = ["episode_id", "a", "b", "speaker_id"]
    if text_too:
        merge += [F.max("end_sec").alias("end_sec"), F.sum("units").alias("units"), F.array_sort(F.flatten(F.collect_list("said"))).alias("said")]
        columns += ["end_sec", "units", "said"]
    edge = edge.groupBy("episode_id", "turn").agg(*merge)
    turns = inner.select(*columns).unionByName(edge.select(*columns))
    out = ["episode_id", "speaker_id", F.col("a.sentence_id").alias("first_sentence_id"), F.col("b.sentence_id").alias("last_sentence_id")]
    if text_too:
        out += [F.col("a.start_sec").alias("start_sec"), "end_sec", "units", F.array_join(F.transform("said", lambda s: s["clean"]), " ").alias("clean_text")]
    return turns.select(*out)
