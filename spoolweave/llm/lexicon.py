"""Spoken-text lexicon shared by the turn grammar and the sentence transducer."""

from __future__ import annotations

import re

OPEN = "[\\[(<（［【〈〔｛{＜]"
CLOSE = "[\\])>）］】〉〕｝}＞]"

#: Words that name a sound or a gap in the recording, in the languages of the tables.
NOTE_WORDS = (
    "音楽 bgm 笑 笑い 笑い声 爆笑 拍手 咳払い 咳 間 沈黙 雑音 ノイズ 無音 ため息 聞き取れず 聞き取り不能 不明 効果音 "
    "music laughter laughs laughing applause coughs cough coughing inaudible crosstalk noise silence pause sighs unintelligible sound "
    "musik lacht lachen gelächter applaus beifall husten hustet pause rauschen stille unverständlich "
    "musique rires rire applaudissements toux tousse bruit silence inaudible "
    "música risas risa aplausos tos ruido silencio inaudible "
    "音乐 笑声 掌声 咳嗽 噪音 沉默 停顿 听不清 "
    "음악 웃음 박수 기침 잡음 침묵 소음"
).split()
WORDS = "|".join(sorted({re.escape(w) for w in NOTE_WORDS}, key=len, reverse=True))
#: One sound note; double brackets nest.
NOTE = (
    f"(?:{OPEN}{{1,2}}[ 　♪♫〜~]{{0,6}}(?:{WORDS})[ 　♪♫〜~]{{0,6}}{CLOSE}{{1,2}}"
    "|♪[^♪\n。]{0,30}♪|[♪♫][〜~]?|\\*[^*\n]{1,24}\\*|※(?:" + WORDS + ")※)"
)
TIME = "\\d{1,2}:\\d{2}(?::\\d{2})?(?:[.,]\\d{1,3})?"
STAMP = f"(?:{OPEN}?{TIME}(?:[ \\t]{{0,4}}--?>[ \\t]{{0,4}}{TIME})?{CLOSE}?)"

#: Hesitations, each with its lengthened spellings; whole words only.
FILLER = (
    "(?:え[ーえ〜]*[っッ]*と[ー〜]*|え[ーえ〜]+|あの[ーう〜]*(?:ですね)?|その[ー〜]+|[んウう]ー+ん*|ん[ー〜]+|ま[ーあぁ]+|うー+ん?"
    "|u+h+(?:m+)?|u+m+|e+r+m*|h+m+|e+h+m*|ä+h+m*|ö+h+m*|e+u+h*|h+e+u+|ehm+|呃+|嗯*呃+|嗯+呃*|那个|어+|음+|으음+|저기)"
)
FILLER_RE = re.compile(f"(?<![\\w])(?:{FILLER})(?![\\w])", re.I)
NOTE_RE = re.compile(NOTE, re.I)
STAMP_RE = re.compile(STAMP)
NOISE_RE = re.compile(f"{NOTE}|{STAMP}", re.I)
INVISIBLE = "­͏ᅟᅠ᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿"
INVISIBLE_RE = re.compile(f"[{INVISIBLE}]+")
