"""Problem 6: prompt and response pairs that are broken, and how.

A response is cut into clauses, and a conditional random field tags each clause as answer,
refusal, echo, foreign, unfinished or empty. The letters under each tag decide the pair's
defect: one of empty, refusal, copied_prompt, other_language, truncated (in this order).

No list of wordings decides anything. The field sees how much of a clause stands in the
candidates and in the instruction, how much of the candidate is left after the answer,
whether the clause's language (n-gram filters of problem 9, learnt from a bounded sample of
labelled documents) is one of the candidates', whether it has letters at all, and a speech
score: the mean log-odds of its hashed n-grams between refusals and transcript speech. The
tables of n-grams behind the score are fitted crosswise (a training clause is scored by a
table that saw neither it nor its prompt), so the field learns how far to trust the score on
wording it has not seen, and that a clause which says something of its own, in a language of
the candidates or in one the filters don't know, is a refusal.

The field is fitted on at most TRAIN_ROWS prompts (the smallest hashes of request_id); the
clauses are labelled by construction, from whole candidates (answer), cut candidates
(unfinished), instructions (echo), refusals of many languages (refusal), other rows'
candidates in another language (foreign), and blanks, marks and placeholders (empty).
Everything else covers every row, a whole Arrow batch at a time.

Defined cases: rows without success are left out; a null or blank answer is empty unless
the source is no_change; a null prompt has no instruction and no candidates, so only empty
and refusal can be told; without any prompt to learn from only empty can; without labelled
documents languages are told by script at most; a
redelivered row counts once; extra columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolweave.functions import charmap as cm
from spoolweave.llm import crf, languages
from spoolweave.llm.lookalike import forms

TRAIN_ROWS = 500
LABELS = ("answer", "refusal", "echo", "foreign", "unfinished", "empty")
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED, EMPTY = range(6)
OPEN_SHARE = 0.2
MOST_CLAUSES = 8  # of a training sequence; tagging takes all clauses

ENGINES = "apple|qwen|nemotron|whisper"
CANDIDATE = regex.compile(f"(?:^|\\n)(?=(?:{ENGINES}): ?)")
OWN_NAME = regex.compile(f"(?:{ENGINES}): ?")
CLAUSE = regex.compile("[^。！？!?.…\\n]+(?:[。！？!?…\\n]+|\\.+(?=\\s|$)|\\.)?|[。！？!?.…\\n]+")
WORD = regex.compile("[^\\W_]")

#: What stands for no answer; to learn from, beside blanks and marks.
PLACEHOLDERS = (
    "n/a null none nil nan empty blank undefined なし 無し 空 該当なし 回答なし 无 空白 没有 없음 없습니다 keine kein aucun aucune ninguno ninguna nada rien nichts tbd todo"
).split()
BLANKS = ("", " ", "…", "---", "「」", "\n", '""')
#: Refusals to learn from, by language; the field is to tell others by what they share with these and by what they lack.
REFUSAL_SEEDS = (
    "I cannot help with this request.", "I'm sorry, but I am unable to provide an answer for this.", "Unfortunately I must decline to answer.", "As a language model I can't assist with that request.",
    "I will not answer this question.", "Sorry, that is not something I am able to do.", "I am afraid I have nothing to say about it.", "I would rather not choose.",
    "申し訳ありませんが、お答えできません。", "この依頼には対応できません。", "恐れ入りますが、ご要望にはお応えいたしかねます。", "お手伝いできません。回答を控えます。", "ごめんなさい、それは私には判断できないことです。", "確信が持てないので、選ぶことはできません。",
    "Es tut mir leid, das kann ich leider nicht beantworten.", "Dazu darf ich keine Auskunft geben.", "Ich bin nicht in der Lage, diese Anfrage zu bearbeiten.", "Das möchte ich lieber nicht entscheiden.",
    "Je suis désolé, je ne peux pas répondre à cette demande.", "Il m'est impossible de choisir.", "Je préfère ne pas donner de réponse.", "Cela dépasse mes capacités.",
    "Lo siento, no puedo ayudar con esta solicitud.", "No me es posible responder a eso.", "Prefiero no contestar esta pregunta.", "Lamentablemente no soy capaz de decidirlo.",
    "很抱歉，我无法回答这个问题。", "我不能提供这样的帮助。", "对不起，这个请求我没办法处理。", "我不想对此作出选择。",
    "죄송하지만 답변할 수 없습니다.", "이 요청은 도와드릴 수 없습니다.", "저는 그것을 판단할 수 없어요.", "미안하지만 대답하지 않겠습니다.",
    "Mi dispiace, non posso rispondere.", "Non sono in grado di aiutare.", "Desculpe, não consigo responder.", "Prefiro não ajudar com isso.",
    "Het spijt me, ik kan dit niet beantwoorden.", "Daar kan ik niet mee helpen.", "Извините, я не могу ответить.", "Я не буду помогать с этим запросом.",
    "Przykro mi, nie mogę na to odpowiedzieć.", "Üzgünüm, buna cevap veremem.", "Jag kan tyvärr inte svara på det.", "عذرا، لا أستطيع الإجابة.", "Xin lỗi, tôi không thể trả lời.", "Maaf, saya tidak bisa menjawab.",
)


def split_prompt(prompt: str | None) -> tuple[str, list[str]]:
    """Instruction and candidate texts."""
    if not prompt:
        return "", []
    parts = CANDIDATE.split(prompt)
    head = "" if OWN_NAME.match(parts[0]) else parts[0]
    return head, [p[m.end() :] for p in parts if (m := OWN_NAME.match(p))]


WRAPPED = regex.compile("^\\s*(?:```(?:json)?)?\\s*\\{.*?[\"“]final_text[\"”]\\s*:\\s*[\"“]?", regex.S)
UNWRAP_END = regex.compile("[\"”]?\\s*(?:,\\s*[\"“]\\w+[\"”]\\s*:.*)?\\}\\s*(?:```)?\\s*$", regex.S)
INTRO = regex.compile("^\\s*(?:final_text|answer|回答|答え|答)\\s*[:：]\\s*", regex.I)


def unwrap(answer: str) -> str:
    """The text of an answer given as a JSON object, whole or broken off, or after a field name."""
    found = WRAPPED.match(answer)
    if found:
        answer = UNWRAP_END.sub("", answer[found.end() :]).replace('\\"', '"').replace("\\n", "\n")
    return INTRO.sub("", answer)


def clauses_of(answer: str) -> list[str]:
    """Clauses with letters; an answer without any is one clause."""
    return [c for c in CLAUSE.findall(answer) if WORD.search(c)] or [answer]


# --- what the fitted tables say of a clause ------------------------------------------------

SCORE_BITS = 16
FOLDS = 4
#: Weight, in n-grams, of the pooled rate that smooths the rates of each side.
PRIOR = 200.0


@dataclass
class Speech:
    """Log-odds of hashed n-grams, refusals against transcript speech, and the placeholders known."""

    odds: np.ndarray
    placeholders: frozenset[str]

    @classmethod
    def of(cls, own: np.ndarray, other: np.ndarray, placeholders: Sequence[str]) -> Speech:
        """From n-gram counts of refusals and of speech. Rates are smoothed by the pooled rate; n-grams of neither say nothing."""
        both = own + other
        pooled = PRIOR * np.maximum(both, 1.0) / max(both.sum(), 1.0)
        odds = np.log((own + pooled) / (own.sum() + PRIOR)) - np.log((other + pooled) / (other.sum() + PRIOR))
        odds[both == 0] = 0.0
        # n-grams of speech alone count -1, however many refusals there were
        odds /= np.log((own.sum() + PRIOR) / PRIOR) or 1.0
        return cls(np.clip(odds, -1, 1), frozenset(_key(p) for p in placeholders))


def _gram_counts(texts: Sequence[str]) -> np.ndarray:
    """Occurrences of each hashed n-gram."""
    return np.bincount(_slots(languages.Grams(list(texts)).hash) if texts else np.zeros(0, np.int64), minlength=1 << SCORE_BITS).astype(float)


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SCORE_BITS)).astype(np.int64)


def _key(text: str) -> str:
    letters, _ = cm.folded([text])
    return cm.text_of(letters)


FEATURES = 40
GRAM = 4
_MIX, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SLOTS = 8  # of a row in the pool of n-grams: up to seven candidates, and the instruction last


def _gram_codes(letters: np.ndarray) -> np.ndarray:
    wide = letters.astype(np.uint64)
    n = max(len(wide) - GRAM + 1, 0)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(GRAM):
            out = (out ^ wide[j : j + n]) * _MIX
            out ^= out >> np.uint64(29)
    return out


def _owned(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Codes made different by their owner."""
    with np.errstate(over="ignore"):
        out = (codes ^ (owner.astype(np.uint64) + np.uint64(1)) * _SALT) * _MIX
    return out ^ (out >> np.uint64(31))


def _inside(at: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, position) of every n-gram that lies within one string."""
    string = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pos = np.arange(total)
    ok = pos + GRAM <= at[string + 1] if total else np.zeros(0, bool)
    return string[ok], pos[ok]


#: Code of an untold language in narrow letters, and those of the told ones.
NARROW = len(languages.LANGUAGES)
_NARROW_SET = np.array([languages.LANGUAGES.index(k) for k in ("en", "de", "fr", "es")] + [NARROW])


def _kinship(own: np.ndarray, known: np.ndarray) -> np.ndarray:
    """0 where a language is one of the known (a bit each), 1 where it is not, 2 where that can't be told."""
    has = (known >> np.maximum(own, 0)) & 1 == 1
    narrow = np.isin(own, _NARROW_SET)
    vague = (own == NARROW) & ~has | narrow & ((known >> NARROW) & 1 == 1) & ~has | (own == NARROW) & has
    return np.where((own < 0) | (known == 0) | vague, 2, np.where(has, 0, 1))


class Batch:
    """Features of all clauses of many pairs (instruction, candidates, answer clauses) at once."""

    def __init__(self, pairs: list[tuple[str, list[str], list[str]]], tongue: languages.Filters, speech: Speech) -> None:
        n = len(pairs)
        strings: list[str] = []
        row_of, slot_of = [], []  # of the strings: slot of a candidate, the instruction, or -1 for a clause
        for r, (head, cands, clauses) in enumerate(pairs):
            own = [head, *dict.fromkeys(cands), *clauses]
            strings += own
            row_of += [r] * len(own)
            slot_of += [SLOTS - 1, *(min(k, SLOTS - 2) for k in range(len(own) - len(clauses) - 1)), *([-1] * len(clauses))]
        self.n = n
        row, slot = np.array(row_of, np.int64), np.array(slot_of, np.int64)
        letters, at = cm.folded(strings)
        size = np.diff(at) if len(strings) else np.zeros(0, np.int64)
        clause = np.flatnonzero(slot == -1)
        self.row = row[clause]
        self.letters = size[clause]
        m = len(clause)
        # n-grams of candidates and instructions, each owned by its row and slot
        string, pos = _inside(at, len(letters))
        codes = _gram_codes(letters)[pos] if len(pos) else np.zeros(0, np.uint64)
        pooled = slot[string] >= 0
        pool = np.sort(_owned(codes[pooled], row[string[pooled]] * SLOTS + slot[string[pooled]]))
        place = np.full(len(strings), -1)
        place[clause] = np.arange(m)
        own = place[string[~pooled]]
        mine, my_row = codes[~pooled], self.row[own] if m else np.zeros(0, np.int64)
        grams = np.bincount(own, minlength=m)

        def held(k: int) -> np.ndarray:
            keys = _owned(mine, my_row * SLOTS + k)
            if not len(pool):
                return np.zeros(len(keys), bool)
            spot = np.searchsorted(pool, keys)
            spot[spot == len(pool)] = 0
            return pool[spot] == keys

        in_cand = np.zeros(len(mine), bool)
        row_grams = np.bincount(my_row, minlength=n)
        drawn = np.full((n, SLOTS - 1), -1.0)
        cand_size = np.zeros((n, SLOTS - 1))
        is_cand = (slot >= 0) & (slot < SLOTS - 1) & (size > 0)
        np.maximum.at(cand_size, (row[is_cand], slot[is_cand]), size[is_cand])
        answer_size = np.bincount(self.row, weights=self.letters, minlength=n)
        for k in range(SLOTS - 1):
            if not (cand_size[:, k] > 0).any():
                continue
            has = held(k)
            in_cand |= has
            share = np.bincount(my_row[has], minlength=n) / np.maximum(row_grams, 1)
            drawn[:, k] = np.where(cand_size[:, k] > 0, share, -1.0)
        in_head = held(SLOTS - 1)
        cand = np.bincount(own[in_cand], minlength=m) / np.maximum(grams, 1)
        inst = np.bincount(own[in_head], minlength=m) / np.maximum(grams, 1)
        # short clauses are looked up whole
        tiny = np.flatnonzero((self.letters < 6) & (self.letters > 0))
        text = lambda i: cm.text_of(letters[at[i] : at[i + 1]])
        first = np.searchsorted(row, np.arange(n + 1))
        for c in tiny:
            f, r = text(clause[c]), int(self.row[c])
            others = [text(i) for i in range(first[r], first[r + 1]) if slot[i] >= 0]
            # two or three narrow letters stand anywhere by chance; they must be the whole candidate
            wordy = sum(2.5 if ch >= "\u2e80" else 1 for ch in f) >= GRAM
            cand[c], inst[c] = float(any(f == o or (wordy and f in o) for o in others[1:])), float(wordy and f in others[0])
            if answer_size[r] < GRAM:
                for i in range(first[r], first[r + 1]):
                    if 0 <= slot[i] < SLOTS - 1 and size[i]:
                        drawn[r, slot[i]] = float(text(i).startswith(f))
        # least share of a candidate left after the answer, among those it can be drawn from
        best = drawn.max(axis=1, initial=-1.0)
        can = (drawn >= best[:, None] - 0.08) & (drawn >= 0)
        rest = np.where(can, np.maximum(0.0, 1 - answer_size[:, None] / np.maximum(cand_size, 1)), np.inf).min(axis=1)
        self.left = np.where((best >= 0.4) & (answer_size > 0), rest, 0.0)
        # languages and speech scores, from one pass over n-grams
        found = languages.Grams(strings)
        of = found.sentence_doc[found.sentence]
        told = tongue.tell(found)
        wide = np.bincount(np.repeat(np.arange(len(strings)), size)[letters >= 0x2E80], minlength=len(strings)) if len(strings) else np.zeros(0)
        # an untold text of narrow letters is in some language that has them
        told = np.where((told < 0) & (size >= 6) & (wide * 4 < size), NARROW, told)
        known = np.zeros(n, np.int64)
        voiced = is_cand & (told >= 0)
        np.bitwise_or.at(known, row[voiced], np.int64(1) << told[voiced])
        scored = np.bincount(of, weights=speech.odds[_slots(found.hash)], minlength=len(strings)) / np.maximum(np.bincount(of, minlength=len(strings)), 1)
        score = scored[clause]
        pure = (np.bincount(of, weights=speech.odds[_slots(found.hash)] < -0.95, minlength=len(strings)) / np.maximum(np.bincount(of, minlength=len(strings)), 1))[clause]
        counts = tongue.by_text(found)
        spoken = np.zeros((n, counts[0].shape[1]))
        np.add.at(spoken, self.row, counts[0][clause])
        whole = languages.told(spoken, np.bincount(self.row, weights=counts[1][clause], minlength=n))
        own_tongue = np.where(self.letters >= 12, told[clause], whole[self.row])
        kind = _kinship(own_tongue, known[self.row])
        self.foreign = _kinship(whole, known) == 1
        alone = np.bincount(self.row, minlength=n)[self.row] == 1
        last = np.concatenate((self.row[1:] != self.row[:-1], [True])) if m else np.zeros(0, bool)
        left = self.left[self.row]
        room = self.letters + 1.5 * wide[clause]  # in narrow letters
        stub = np.zeros(m, bool)
        for c in np.flatnonzero(alone & (self.letters > 0) & (room <= 20)):
            stub[c] = text(clause[c]) in speech.placeholders
        level = np.digitize(score, (-0.8, -0.6, -0.4, -0.2, 0.1, 0.4))
        x = np.zeros((m, FEATURES))
        every = np.arange(m)
        x[:, 0] = 1
        x[every, 1 + np.digitize(cand, (0.2, 0.5, 0.8))] = 1
        x[every, 5 + np.digitize(inst, (0.3, 0.7))] = 1
        x[every, 8 + level] = 1
        x[every, 15 + kind] = 1
        x[every, 18 + np.where(last, 1 + (left > 0.12) + (left > OPEN_SHARE), 0)] = 1
        own_words = (cand < 0.2) & (inst < 0.3)
        x[:, 22] = self.letters < 6
        x[:, 23] = self.letters == 0
        x[:, 24] = alone & (room <= 12) & own_words
        x[:, 25] = stub
        x[:, 26] = (inst >= 0.7) & (cand < 0.8)
        x[:, 27] = (cand >= 0.5) & (kind == 0)
        x[:, 28] = last & (left > OPEN_SHARE) & (cand >= 0.3)
        x[:, 29] = own_words & (kind == 0)
        asked = (cand_size > 0).any(axis=1)[self.row] if m else np.zeros(0, bool)
        x[:, 30] = own_words & (kind == 2) & asked
        # most n-grams that speech has and no refusal; more like speech; like neither; like refusals
        x[every, 31 + np.select([pure >= 0.6, level <= 2, level <= 3], [0, 1, 2], 3)] = own_words & (kind == 1)
        x[:, 35] = (level >= 4) & (cand < 0.5)
        x[:, 36] = (self.letters < 6) & (cand < 0.2)
        x[every, 37 + np.minimum(np.digitize(level, (3, 4)), 2)] = ~asked
        self.x = x

    def defects(self, model: crf.Crf) -> list[str | None]:
        """The defect of each pair, told by the letters under each tag."""
        first = np.searchsorted(self.row, np.arange(self.n + 1))
        tags = model.viterbi_all(self.x, first)
        kinds = len(LABELS)
        size = np.bincount(self.row * kinds + tags, weights=np.maximum(self.letters, 1), minlength=self.n * kinds).reshape(self.n, kinds)
        share = size / np.maximum(size.sum(axis=1, keepdims=True), 1)
        ended = tags[np.maximum(first[1:] - 1, 0)] if len(tags) else np.zeros(self.n, int)
        tests = (
            ("empty", share[:, EMPTY] >= 0.5),
            ("refusal", share[:, REFUSAL] >= 0.5),
            ("copied_prompt", share[:, ECHO] >= 0.5),
            ("other_language", (share[:, FOREIGN] >= 0.5) & self.foreign),
            ("truncated", (ended == UNFINISHED) & (self.left > OPEN_SHARE)),
        )
        pick = np.select([t for _, t in tests], range(len(tests)), default=-1)
        return [tests[k][0] if k >= 0 else None for k in pick.tolist()]


# --- fitting -------------------------------------------------------------------------------


@dataclass
class Model:
    field: crf.Crf
    speech: Speech
    tongue: languages.Filters

    def defects(self, pairs: list[tuple[str, list[str], str]]) -> list[str | None]:
        """Defects of (instruction, candidates, unwrapped answer)."""
        return Batch([(h, c, clauses_of(a)) for h, c, a in pairs], self.tongue, self.speech).defects(self.field)


Labelled = tuple[str, list[str], list[str], list[int]]


def training_pairs(prompts: list[tuple[str, list[str]]], refusals: Sequence[str], placeholders: Sequence[str], tongue: languages.Filters, rng: random.Random) -> list[Labelled]:
    """(instruction, candidates, clauses, tags) made from the prompts by construction."""
    told = tongue.tell(languages.Grams([c[0] for _, c in prompts])).tolist() if prompts else []
    by_language: dict[int, list[str]] = {}
    for k, (_, cands) in zip(told, prompts, strict=True):
        by_language.setdefault(k, []).append(cands[0])
    out: list[Labelled] = []

    def add(head: str, cands: list[str], answer: str, tag: int, end: int | None = None) -> None:
        clauses = clauses_of(answer)
        tags = [tag] * len(clauses)
        tags[-1] = tag if end is None else end
        out.append((head, cands, clauses, tags))

    for k, (head, cands) in zip(told, prompts, strict=True):
        text = rng.choice(cands)
        add(head, cands, text, ANSWER)
        # speakers decline as well: what a candidate says is an answer
        said = " ".join(rng.sample(refusals, min(rng.choice((1, 2)), len(refusals))))
        add(head, [said, said.rstrip(".。")], said, ANSWER)
        add("", [], *rng.choice(((text, ANSWER), (said, REFUSAL))))
        for share in (rng.uniform(0.15, 0.45), rng.uniform(0.45, 0.75)):
            add(head, cands, text[: max(6, int(len(text) * share))], ANSWER, UNFINISHED)
        if head.strip():
            add(head, cands, rng.choice(("", "質問：")) + rng.choice((head, head.upper(), head.split("\n")[0])), ECHO)
        for count in (1, 2):
            add(head, cands, " ".join(rng.sample(refusals, min(count, len(refusals)))), REFUSAL)
        others = [o for o in by_language if o >= 0 and o != k]
        if others and k >= 0:
            text = rng.choice(by_language[rng.choice(others)])
            add(head, cands, text, FOREIGN)
            add(head, cands, rng.choice(clauses_of(text)), FOREIGN)
        add(head, cands, rng.choice((*BLANKS, *placeholders)), EMPTY)
    return out


def fit_pairs(rows: list[tuple[int, str]], labelled: list[tuple[str, str]], seed: int = 7) -> Model:
    """The model from (request_id, prompt) rows and (language, text) rows; what is trained on is scored by tables of the other folds."""
    tongue = languages.build_filters(labelled)
    talk = [t for _, t in labelled]
    rng = random.Random(seed)
    split = [(head, [c for c in cands if WORD.search(c)]) for head, cands in (split_prompt(p) for _, p in sorted(rows))]
    prompts = [(h, c) for h, c in split if c]
    xs, ys = [], []
    own = [_gram_counts(REFUSAL_SEEDS[k::FOLDS]) for k in range(FOLDS)]
    other = [_gram_counts([t for h, c in prompts[k::FOLDS] for t in (h, *c[:2])] + talk[k::FOLDS]) for k in range(FOLDS)]
    whole_own, whole_other = sum(own), sum(other)
    for k in range(FOLDS):
        made = training_pairs(prompts[k::FOLDS], REFUSAL_SEEDS[k::FOLDS], PLACEHOLDERS, tongue, rng)
        unseen = Speech.of(whole_own - own[k], whole_other - other[k], [p for i, p in enumerate(PLACEHOLDERS) if i % FOLDS != k])
        batch = Batch([m[:3] for m in made], tongue, unseen)
        first = np.searchsorted(batch.row, np.arange(len(made) + 1))
        for i, (_, _, _, tags) in enumerate(made):
            # a cut that leaves little is no truncation
            if tags[-1] == UNFINISHED and batch.left[i] <= OPEN_SHARE:
                continue
            xs.append(batch.x[first[i] : first[i + 1]][-MOST_CLAUSES:])
            ys.append(tags[-MOST_CLAUSES:])
    whole = Speech.of(whole_own, whole_other, PLACEHOLDERS)
    if not xs:
        # no prompts to learn from: what is said is an answer, what has no letters is empty
        emit = np.zeros((FEATURES, len(LABELS)))
        emit[0, ANSWER], emit[23, EMPTY], emit[25, EMPTY] = 1, 2, 2
        return Model(crf.Crf(emit, np.zeros((len(LABELS),) * 2), np.zeros(len(LABELS))), whole, tongue)
    return Model(crf.fit(xs, ys, len(LABELS), rounds=100), whole, tongue)


def fit_model(decisions: DataFrame, documents: DataFrame | None = None, rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample of prompts, with language filters from a bounded sample of labelled documents."""
    labelled = languages.training_rows(documents) if documents is not None else []
    slim = decisions.where("prompt_text is not null and request_id is not null").select("request_id", "prompt_text")
    picked = slim.orderBy(F.xxhash64("request_id"), "request_id").limit(rows).collect()
    texts = forms([r[1] for r in picked])
    return fit_pairs([(r[0], t) for r, t in zip(picked, texts, strict=True)], labelled)


def _tag(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prompts = forms([p or "" for p in batch.column("prompt_text").to_pylist()])
        answers = forms([a or "" for a in batch.column("final_text").to_pylist()])
        kept = batch.column("selected_source").to_pylist()
        found = model.defects([(*split_prompt(p), unwrap(a)) for p, a in zip(prompts, answers, strict=True)])
        out = [None if d == "empty" and s == "no_change" else d for d, s in zip(found, kept, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("request_id"), pa.array(out, pa.string())], names=["request_id", "defect"])


def broken_pairs(decisions: DataFrame, documents: DataFrame | None = None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """request_id and defect of the defective answers among successful rows.

    documents (doc_id, text, lang) teach the language filters.
    """
    model = fit_model(decisions, documents, train_rows)
    rows = decisions.where("success").select("request_id", "prompt_text", "selected_source", "final_text")
    types = dict(rows.dtypes)
    tagged = rows.mapInArrow(lambda it: _tag(it, model), f"request_id {types['request_id']}, defect string")
    return tagged.where("defect is not null").distinct()
