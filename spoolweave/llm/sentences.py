"""Problem 4: sentence boundaries across languages and scripts.

A lexer turns a text into a short run of symbols (terminators, quotes, brackets, line
breaks, closing predicates, content); a finite transducer over those symbols, compiled once
from the boundary rules, says after which symbols a sentence ends, and keeps in its state
whether the open sentence has speech and which quotes are open. Rules that differ by script
look at the letters within WINDOW characters on the same line, never at the whole text, so a
passage is split alike wherever it stands.

Every text is cut into chunks at safe cuts: places no token and no look-around of the lexer
reaches across (see SAFE). A chunk is lexed by itself and becomes a state-transition
function, an array that maps every start state to its end state; the functions are composed
by a prefix scan, and each chunk is then emitted from its own start state. Texts up to
SPREAD code points do this inside one Arrow batch, all chunks of the batch in one scan;
longer ones send their chunks to different tasks. Both run the same functions over the same
kind of chunks, and a cut changes nothing, so results don't depend on chunk size or length.

Defined cases: null or empty text gives no sentence; a text of labels, stamps, fillers and
sound notes alone gives none; a redelivered row gives the same rows once; null keys are a
key like any other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolweave.llm import lexicon as lx
from spoolweave.llm.lookalike import LATIN_ALIKE

#: Code points after which the next safe cut is taken.
CHUNK = 256
#: Chunk size of texts over SPREAD code points, which go over several tasks.
FAR_CHUNK, SPREAD = 16_384, 65_536
#: Characters on either side whose scripts decide which rules hold.
WINDOW = 80
#: Context of a chunk that travels alone: the longest look-behind and look-ahead of any rule.
BACK, AHEAD = 160, 320
#: A label on a line of its own ends within this many characters.
LABEL_REACH = 200

# Abbreviations after which a sentence never ends, and those that may close one.
MIDDLE = (
    "dr drs prof mr mrs ms mx st sr sra srta dra d dña m mm mme mmes mlle messrs nr no nos núm num abs fa p pp pág págs art arts al env "
    "approx aprox ca vs vgl vs bzw z b h u a o i e g s cf fig figs vol ver bd mio mrd mill jg hr fr abb ej ed eds chap rev gen col lt sgt jan feb "
    "mär apr jun jul aug sept sep okt oct nov dez dec tel ext dept est min max bspw evtl ggf inkl zzgl usf"
).split()
CLOSING = "etc co ltd cía inc jr corp usw a.m p.m am pm bros llc plc s.a e.v ff usf al".split()
_MID = "|".join(sorted(map(regex.escape, MIDDLE), key=len, reverse=True))
_END = "|".join(sorted(map(regex.escape, CLOSING), key=len, reverse=True))
MONTH = "(?:Jan|Feb|Mär|Apr|Mai|Jun|Jul|Aug|Sep|Okt|Nov|Dez)"
INV = f"[{lx.INVISIBLE}]{{0,16}}"
GAP = f"[ \\t\\u00a0\\u2002-\\u200a\\u202f\\u205f\\u3000{lx.INVISIBLE}]"
NEXT = f"(?=(?:{GAP}|(?i:{lx.NOTE})|{lx.STAMP}){{0,12}}[\"“„«»‹‘¿¡(\\[—–-]*{GAP}*[\\p{{Lu}}\\p{{Lt}}\\p{{Nd}}]|{GAP}*[\"“„«¿¡]|{GAP}*(?:$|[\\r\\n]))"
CJKNEXT = f"(?={GAP}*[\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}\\p{{Hangul}}])"
JA_PRED = "(?>(?:でしょうか|ましょうか|でしょう|ましょう|ませんでした|ました|でした|ません(?!でし)|です|ます)(?:よね|か|よ|ね|わ|な)?)"
KO_PRED = "(?:습니다|읍니다|입니다|니다|습니까|ㅂ니까|니까|까요|어요|아요|해요|예요|에요|세요|네요|지요|죠|군요)"
#: What cannot open the next Japanese sentence: particles that carry the predicate on.
JA_ON = (
    "(?!と(?!ころで|ても|にかく|りあえず|なりの|き|ある)|が(?![んっ])|けど|けれど|から|ので|のに|し[、,]|って|という|たら|ば|の(?!ち)|ん|か(?![なり])|ね|よ|さ、|わ|な[、。]"
    "|[、。，．,.!?！？…」』）)\\]】〉♪※])"
)

SPACE = "[ \\t\\u00a0\\u2002-\\u200a\\u202f\\u205f\\u3000]"
NOMARK = f"(?!(?:{GAP}|(?i:{lx.NOTE})){{0,12}}[,，、.。!?！？…])"

# Symbols of the transducer. AMBIG marks close a low opening quote, if one is open, and else open one.
CONTENT, TERM, SOFT, OPENQ, CLOSEQ, TOGGLE, OPENB, CLOSEB, BREAK, IDLE, OPENLOW, CLOSE_ON, AMBIG, AMBIG_ON = range(14)
SYMBOLS = 14

LEXER = regex.compile(
    "|".join(
        (
            f"(?P<noise>(?i:{lx.NOTE}|{lx.STAMP}))",
            "(?P<brk>[\\r\\n\\u2028\\u2029\\x0b\\x0c\\x85]+)",
            # a time of day ends a sentence before a capital
            f"(?P<clock>(?<![\\w])[ap]\\.[ \\u00a0]?m\\.{INV}(?={GAP}+[\"“„«]?\\p{{Lu}}|{GAP}*(?:$|[\\r\\n])))",
            # dots that end nothing: initials, numbers, abbreviations, ordinals, list numbers
            "(?P<skip>(?<![\\w])(?i:v|ver|vol|no|nr)\\.?\\d+(?:[.,]\\d+)*"
            f"|\\d+(?:[.,:]\\d+)+|\\d{{1,2}}\\.(?= {MONTH})|(?<=(?:^|[\\r\\n])[ \\t]{{0,16}})\\d{{1,3}}[.)．](?=\\s)"
            "|(?<![\\w])\\p{L}\\.(?:[ \\u00a0]?\\p{Ll}\\.)+(?!\\s*(?:$|[\\r\\n]))(?=[^\\S\\r\\n]*[\\p{Ll}\\d,;:])"
            "|(?<![\\w])\\p{Lu}\\.(?=[ \\u00a0]?\\p{Lu})"
            f"|(?<![\\w])(?i:{_MID})\\.(?=[^\\s]|[^\\S\\r\\n]+[\\p{{L}}\\p{{Nd}}\"“«„]))",
            # an abbreviation that may close a sentence does so before a capital
            f"(?P<abbr>(?<![\\w])(?i:{_END})\\.{INV}(?!{GAP}*(?:Ltd|Inc|Co)\\b){NEXT})",
            f"(?P<abbrmid>(?<![\\w])(?i:{_END})\\.)",
            "(?P<strong>[。！？｡︒‼⁇⁈⁉]" + f"(?:{INV}[。！？｡!?‼⁇⁈⁉])*)",
            f"(?P<dots>(?:\\.{{2,}}|…+)(?:{INV}[!?！？。.])*)",
            f"(?P<latin>[.!?．](?:{INV}[.!?！？．])*)",
            "(?P<toggle>[\"＂])",
            "(?P<oq>[「『“„«‹‟‘])",
            "(?P<cq>[」』”»›])",
            "(?P<ob>[(\\[{（［｛【〔〈《<＜])",
            "(?P<cb>[)\\]}）］｝】〕〉》>＞])",
            f"(?P<pred>{JA_PRED}{NOMARK}(?:{INV}{SPACE}{GAP}*{JA_ON}(?=\\S)|{INV}{JA_ON}(?=[\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}\\p{{L}}\\p{{Nd}}])))",
            f"(?P<kopred>{KO_PRED}{NOMARK}{INV}{SPACE}{GAP}*(?!라고|이라고|하고|고 )(?=\\S))",
            f"(?P<zhgap>(?<=\\p{{Han}}){INV}{SPACE}{GAP}*(?=[\\p{{Han}}\\p{{Nd}}“「]))",
            "(?P<filler>(?<![\\w])(?i:" + lx.FILLER + ")(?![\\w]))",
            f"(?P<w>[\\p{{Latin}}\\p{{M}}]+|\\p{{Hangul}}(?:(?!{KO_PRED})\\p{{Hangul}})*|[\\p{{Han}}\\p{{Katakana}}ー]+|(?:(?![でま])\\p{{Hiragana}})+|\\w)",
        )
    ),
    regex.V0,
)
#: Where none of these stands before the last few characters, nothing can be cut: all that a rule of LEXER ends at.
MAYBE = regex.compile(
    f"[.。！？｡︒‼⁇⁈⁉!?．…\\r\\n\\u2028\\u2029\\x0b\\x0c\\x85]|{JA_PRED}{INV}{GAP}*{JA_ON}(?=\\S)|{KO_PRED}{GAP}|\\p{{Han}}{INV}{SPACE}{GAP}*[\\p{{Han}}\\p{{Nd}}“「]", regex.V0
)
KANA = regex.compile("[\\p{Hiragana}\\p{Katakana}]")
HANGUL = regex.compile("\\p{Hangul}")
HAN = regex.compile("\\p{Han}")
QUOTES = {"「": "」", "『": "』", "“": "”", "„": "“", "«": "»", "‹": "›", "‟": "”", "‘": "’"}
AFTER_QUOTE_JA = regex.compile("[とっのはをがにもへで、，,。]|って|という")
AFTER_QUOTE_ZH = regex.compile(f"{GAP}*(?:$|[\\r\\n“])")
AFTER_QUOTE_KO = regex.compile(f"{GAP}*(?:라고|이라고|하고|라는|고|는|을|를|이|가)(?=\\s)|라고|라는|하고")
UPPER_NEXT = regex.compile(f"{GAP}*(?:(?:(?i:{lx.NOTE})|{lx.STAMP}){GAP}*){{0,6}}(?:[\"“„«¿¡(\\[—–-]+{GAP}*)?[\\p{{Lu}}\\p{{Lt}}]|{GAP}*[\"“„«¿¡]|{GAP}+\\p{{Nd}}|{GAP}*(?:$|[\\r\\n])", regex.V0)

# --- transducer -------------------------------------------------------------------------
# state = speech in this sentence (0/1) + 2 * ended inside the quote (0/1) + 4 * straight quote open (0/1)
#         + 8 * low quote open (0/1) + 16 * depth of quotes and brackets (0..3)
DEPTHS = 4
STATES = 16 * DEPTHS
START = 0


BEFORE_CLOSER = regex.compile(f"{GAP}*[»›]|[\"”“»«'’)\\]）」』]", regex.V0)


def _pack(spoke: int, ended: int, straight: int, low: int, depth: int) -> int:
    return spoke + 2 * ended + 4 * straight + 8 * low + 16 * depth


@lru_cache(1)
def transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and 'a sentence ends after this symbol', by state and symbol."""
    nxt = np.zeros((STATES, SYMBOLS), np.int16)
    end = np.zeros((STATES, SYMBOLS), bool)
    for s in range(STATES):
        spoke, ended, straight, low, depth = s & 1, s >> 1 & 1, s >> 2 & 1, s >> 3 & 1, s >> 4
        outside = not straight and not depth
        deeper = min(depth + 1, DEPTHS - 1)
        for y in range(SYMBOLS):
            if y in (AMBIG, AMBIG_ON):
                kind = (CLOSEQ if y == AMBIG else CLOSE_ON) if low else OPENQ
            else:
                kind = y
            now_low = 0 if y in (AMBIG, AMBIG_ON) else low
            to, out = s, False
            if kind == CONTENT:
                to = _pack(1, 0, straight, low, depth)
            elif kind == BREAK or (kind in (TERM, SOFT) and outside):
                to, out = START, True
            elif kind in (TERM, SOFT):
                to = _pack(spoke, 1, straight, low, depth)
            elif kind in (OPENQ, OPENB, OPENLOW):
                to = _pack(spoke, 0, straight, 1 if kind == OPENLOW else now_low, deeper)
            elif kind == TOGGLE and not straight:
                to = _pack(spoke, ended, 1, low, depth)
            elif kind in (CLOSEQ, CLOSEB, TOGGLE, CLOSE_ON):
                # CLOSE_ON: the lexer saw that what follows carries the sentence on
                toggles = kind == TOGGLE or (kind == CLOSE_ON and straight and y != AMBIG_ON)
                now_straight, now_depth = (0, depth) if toggles else (straight, max(depth - 1, 0))
                open_ = now_straight or now_depth
                if not open_ and ended and kind in (CLOSEQ, TOGGLE):
                    to, out = START, True
                else:
                    to = _pack(spoke, ended if open_ else 0, now_straight, now_low if open_ else 0, now_depth)
            nxt[s][y], end[s][y] = to, out
    return nxt, end


def scripts(text: str) -> tuple[bool, bool, bool]:
    """Whether the rules for Korean, for Japanese and for texts with Chinese characters hold."""
    hangul = HANGUL.search(text) is not None
    ja = not hangul and KANA.search(text) is not None
    return hangul, ja, ja or HAN.search(text) is not None


BREAKS = regex.compile("[\\r\\n\u2028\u2029\\x0b\\x0c\\x85]")
CJK = regex.compile("[\\p{Hiragana}\\p{Katakana}\\p{Hangul}\\p{Han}]", regex.V0)


def nearby(text: str, at: int) -> tuple[bool, bool, bool]:
    """The scripts of the letters around a place, on its own line."""
    before = BREAKS.split(text[max(at - WINDOW, 0) : at])[-1]
    after = BREAKS.split(text[at : at + WINDOW], 1)[0]
    return scripts(before + after)


def lex(text: str, lo: int = 0, hi: int | None = None) -> Iterator[tuple[int, int]]:
    """(symbol, stop) of the tokens that start in [lo, hi), which lie between two safe cuts."""
    hi = len(text) if hi is None else hi
    plain = (False, False, False)
    some_cjk = CJK.search(text, max(lo - WINDOW, 0), hi + WINDOW) is not None
    seen_word = False
    for m in LEXER.finditer(text, lo):
        a, b, kind = m.start(), m.end(), m.lastgroup
        if a >= hi:
            return
        if kind == "w" or kind == "skip" or kind == "abbrmid":
            # one content symbol for a whole run of words
            if not seen_word:
                seen_word = True
                yield CONTENT, b
            continue
        seen_word = False
        if kind == "noise" or kind == "filler":
            continue
        if kind == "brk":
            yield BREAK, b
            continue
        if kind == "ob":
            yield OPENB, b
            continue
        if kind == "cb":
            yield CLOSEB, b
            continue
        if kind in ("abbr", "clock", "pred", "kopred"):
            yield CONTENT, b
            yield TERM, b
            continue
        if kind == "strong":
            yield TERM, b
            continue
        hangul, ja, han = nearby(text, a) if some_cjk else plain
        if kind == "latin":
            follows, marks = text[b : b + 1], m.group()
            if marks == "." and follows and not follows.isspace() and follows not in "\"”“»«')]）」』’" and not lx.INVISIBLE_RE.match(follows):
                if not (han or hangul) or follows.isalnum():
                    continue
            if not han and "." not in marks and follows and follows.isalpha() and follows.islower():
                continue
            if not (han or hangul) and follows and not UPPER_NEXT.match(text, b) and not BEFORE_CLOSER.match(text, b):
                continue
            yield TERM, b
        elif kind == "dots":
            tail = m.group()[-1]
            if tail in "!?！？。" or (not (han or hangul) and UPPER_NEXT.match(text, b)):
                yield TERM, b
            elif b < len(text) and text[b] in "\"”“»«’）)」』" and not han:
                yield SOFT, b
            elif hangul and regex.match("[다요까죠]", text[max(a - 1, 0) : a]) and text[b : b + 1].isspace():
                yield TERM, b
            elif han and regex.search(f"(?:{JA_PRED}|[了呢吗吧])$", text[max(a - 12, 0) : a]) and b < len(text):
                yield TERM, b
        elif kind == "zhgap":
            if not ja and not hangul:
                yield TERM, b
        elif kind == "oq":
            if m.group() == "“":
                yield AMBIG if _ends_with(text, b, ja, han, hangul) else AMBIG_ON, b
            else:
                yield OPENLOW if m.group() == "„" else OPENQ, b
        elif kind == "cq":
            yield CLOSEQ if _ends_with(text, b, ja, han, hangul) else CLOSE_ON, b
        else:
            closes = a and not text[a - 1].isspace() and not _ends_with(text, b, ja, han, hangul)
            yield CLOSE_ON if closes else TOGGLE, b


def _ends_with(text: str, b: int, ja: bool, han: bool, hangul: bool) -> bool:
    """Whether the sentence may end with the closing quote before b."""
    if hangul:
        return AFTER_QUOTE_KO.match(text, b) is None
    if ja:
        return AFTER_QUOTE_JA.match(text, b) is None
    if han:
        return AFTER_QUOTE_ZH.match(text, b) is not None
    return UPPER_NEXT.match(text, b) is not None


LEAD = regex.compile(
    f"(?:\\s|[{lx.INVISIBLE}]|{lx.NOTE}|{lx.STAMP}|[、，,;；:：)\\]}}）］】〉》»”」』]|[.。!?！？…]+)+", regex.I | regex.V0
)

# --- chunks -----------------------------------------------------------------------------
#: Places a text may be cut: after line breaks; after a comma of East Asian texts; after a comma or space between words of
#: small Latin letters; between Chinese characters; after a space between Korean words of which the first ends like no
#: predicate. No token but a note spans such a place, and what stands before it stops every look-ahead.
SAFE = regex.compile(
    "(?<=[\\r\\n\u2028\u2029\\x0b\\x0c\\x85])(?![\\r\\n\u2028\u2029\\x0b\\x0c\\x85])"
    "|(?<=[、，])|(?<=\\p{Ll}{3},)(?= )|(?<=\\p{Ll}{3} )(?=\\p{Ll}{3})"
    "|(?<=[\\p{Han}]{2})(?<![呃嗯那个].|[呃嗯那个])(?=\\p{Han}{2})(?![呃嗯那个]|.[呃嗯那个])"
    "|(?<=\\p{Hangul} )(?<![다까요죠] )(?=\\p{Hangul})",
    regex.V0 | regex.S,
)
#: Notes reach at most this far; none may be open at a cut.
NOTE_REACH = 48
NOTE_OPEN = regex.compile("[\\[(<（［【〈〔｛{＜♪♫*※]")


def cuts(text: str, size: int) -> list[int]:
    """Ends of the chunks: the first safe cut at or after each ``size`` characters, and the text's end."""
    out, at = [], 0
    while len(text) - at > size:
        for m in SAFE.finditer(text, at + size):
            if NOTE_OPEN.search(text, max(m.start() - NOTE_REACH, 0), m.start()) is None:
                at = m.start()
                break
        else:
            break
        if at >= len(text):
            break
        out.append(at)
    return [*out, len(text)]


def lead_at(text: str, at: int, stop: int) -> int:
    """The first place in [at, stop) that can begin a sentence, or -1."""
    m = LEAD.match(text, at, stop)
    at = m.end() if m else at
    return at if at < stop else -1


def chunk_functions(symbols: list[list[int]]) -> np.ndarray:
    """The state-transition function of each chunk: (chunk, start state) -> end state, all chunks abreast."""
    nxt, _ = transducer()
    size = np.fromiter(map(len, symbols), np.int64, len(symbols))
    order = np.argsort(-size, kind="stable")
    size = size[order]
    out = np.tile(np.arange(STATES, dtype=np.int16), (len(symbols), 1))
    if not len(symbols):
        return out
    table = np.zeros((len(symbols), max(int(size[0]), 1)), np.int8)
    for i, k in enumerate(order):
        table[i, : size[i]] = symbols[k]
    work = out.copy()
    for step in range(int(size[0])):
        m = int(np.searchsorted(-size, -step, side="left"))
        work[:m] = nxt[work[:m], table[:m, step, None]]
    out[order] = work
    return out


def compose_scan(functions: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of (n, STATES) functions in log2(n) vectorised steps."""
    out, step = functions.copy(), 1
    while step < len(out):
        # out[i] after out[i - step]
        out[step:] = np.take_along_axis(out[step:], out[:-step].copy(), axis=1)
        step *= 2
    return out


#: (place the chunk may begin a sentence at, [(speech before the end, place after it)], speech at its end)
Emitted = tuple[int, list[tuple[bool, int]], bool]


def emit(lead: int, symbols: list[int], leads: list[int], state: int) -> Emitted:
    """What one chunk ends, from its start state."""
    nxt, end = _plain_tables()
    ends = []
    for y, at in zip(symbols, leads, strict=True):
        if end[state][y]:
            ends.append((state & 1 == 1, at))
        state = nxt[state][y]
    return lead, ends, state & 1 == 1


@lru_cache(1)
def _plain_tables() -> tuple[list[list[int]], list[list[bool]]]:
    nxt, end = transducer()
    return nxt.tolist(), end.tolist()


def join_chunks(chunks: list[Emitted], prefix: str) -> list[int]:
    """Starts of the sentences that have speech, from what the chunks of a text ended."""
    out, begun = [], -1
    for lead, ends, spoken in chunks:
        if begun < 0:
            begun = lead
        for spoke, after in ends:
            if spoke:
                out.append(begun)
            begun = after
    if chunks and spoken:
        out.append(begun)
    if len(out) > 1 and out[1] <= LABEL_REACH and LABEL_ONLY.match(prefix, 0, out[1]):
        out.pop(0)  # a label on a line of its own is no sentence
    return out


def tokens_of(text: str, lo: int, hi: int) -> tuple[int, list[int], list[int]]:
    """A chunk's first possible start, its symbols, and the possible start after each."""
    symbols, leads = [], []
    for y, stop in lex(text, lo, hi):
        symbols.append(y)
        leads.append(-1 if y in (CONTENT, OPENQ, OPENB, OPENLOW, CLOSEB) else lead_at(text, stop, hi))
    return lead_at(text, lo, hi), symbols, leads


def batch_starts(texts: list[str | None], chunk: int = CHUNK) -> list[list[int]]:
    """Sentence starts of each text; all chunks of the batch go through one scan."""
    out: list[list[int]] = [[] for _ in texts]
    owner, parts = [], []
    seen = [readable(t) if t else "" for t in texts]
    for i, text in enumerate(seen):
        first = MAYBE.search(text)
        if first is None or first.start() >= len(text) - 1:
            # nothing ends before the end: one sentence, if anything is said
            if any(y == CONTENT for y, _ in lex(text)):
                out[i] = [max(lead_at(text, 0, len(text)), 0)]
            continue
        lo = 0
        for hi in cuts(text, chunk):
            owner.append(i)
            parts.append(tokens_of(text, lo, hi))
            lo = hi
    if not parts:
        return out
    own = np.array(owner)
    fns = chunk_functions([p[1] for p in parts])
    # a text's first chunk starts from START whatever came before it: a constant function
    new = np.concatenate(([True], own[1:] != own[:-1]))
    fns[new] = fns[new][:, [START]]
    after = compose_scan(fns)[:, START]
    states = np.where(new, START, np.concatenate(([START], after[:-1]))).tolist()
    emitted = [emit(*p, s) for p, s in zip(parts, states, strict=True)]
    bounds = [*np.flatnonzero(new).tolist(), len(parts)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        out[owner[a]] = join_chunks(emitted[a:b], seen[owner[a]])
    return out


LABEL_ONLY = regex.compile(
    f"(?:\\s|{lx.NOTE}|{lx.STAMP})*(?:(?:>>|-)?\\s*[\\w.'’]{{1,24}}\\s*[:：｜|—]|[\\[(<【（［][\\w.'’ ]{{1,24}}[\\])>】）］])?\\s*$", regex.I | regex.V0
)


ODD = regex.compile("[Ａ-Ｚａ-ｚ０-９ɡ\\p{Greek}\\p{Cyrillic}\\p{Armenian}]", regex.V0)


@lru_cache(1)
def _plain_letters() -> dict[int, int]:
    """Full-width and look-alike letters to plain ones, one code point for one."""
    out = {c: c - 0xFEE0 for c in (*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B))}
    return out | {ord(o): ord(rep) for rep, others in LATIN_ALIKE.items() for o in others}


def sentence_starts(text: str | None, chunk: int = CHUNK) -> list[int]:
    """Code point position of the first character of every sentence."""
    return batch_starts([text], chunk)[0]


def readable(text: str) -> str:
    """The text with odd letters made plain at the same positions."""
    return text.translate(_plain_letters()) if ODD.search(text) else text


def _rows(batch: pa.RecordBatch, keys: list[str], starts: list[list[int]]) -> pa.RecordBatch:
    size = np.fromiter(map(len, starts), np.int64, len(starts))
    taken = pa.array(np.repeat(np.arange(len(starts)), size))
    no = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at = [p for s in starts for p in s]
    cols = [batch.column(k).take(taken) for k in keys]
    return pa.RecordBatch.from_arrays([*cols, pa.array(no, pa.int32()), pa.array(at, pa.int32())], names=[*keys, "sentence_no", "char_pos"])


def split_sentences(df: DataFrame, column: str, keys: list[str], chunk: int = CHUNK, spread: int = SPREAD, far_chunk: int = FAR_CHUNK) -> DataFrame:
    """One row per sentence: keys, sentence_no (from 0) and char_pos, the place it starts.

    keys identify a text; a key that occurs again with the same text is listed once. The
    chunks of texts over ``spread`` code points go to different tasks; results are the same
    for any sizes.
    """
    slim = df.select(*[F.col(k) for k in keys], F.col(column).alias("__text")).where(F.length("__text") > 0)
    types = dict(slim.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", sentence_no int, char_pos int"

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows(batch, keys, batch_starts(batch.column("__text").to_pylist(), chunk))

    small = slim.where(F.length("__text") <= spread).mapInArrow(near, schema)
    large = _far_texts(slim.where(F.length("__text") > spread), keys, far_chunk)
    return small.unionByName(large).dropDuplicates([*keys, "sentence_no"])


_ENDS = "array<struct<spoke:boolean,after:int>>"


def _far_texts(df: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """Texts whose chunks go to different tasks. A text is read whole only where it is cut; later steps see chunks or places."""
    # a struct, so that null keys are equal to each other
    slim = df.select(F.struct(*keys).alias("__k"), "__text").dropDuplicates(["__k"])
    kind = slim.schema["__k"].dataType.simpleString()

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("__text").to_pylist()):
                lo = 0
                for n, hi in enumerate(cuts(text, chunk)):
                    base = max(lo - BACK, 0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("__k").slice(i, 1), *(pa.array([x], pa.int32()) for x in (n, base, lo - base, hi - base)), pa.array([text[base : hi + AHEAD]], pa.string())],
                        names=["__k", "__c", "__base", "__lo", "__hi", "__p"],
                    )
                    lo = hi

    def lexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, lo, hi, part, no = (batch.column(c).to_pylist() for c in ("__base", "__lo", "__hi", "__p", "__c"))
            seen = [readable(p) for p in part]
            got = [tokens_of(p, a, b) for p, a, b in zip(seen, lo, hi, strict=True)]
            place = lambda x, o: x + o if x >= 0 else -1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__k"),
                    batch.column("__c"),
                    pa.array(list(chunk_functions([g[1] for g in got])), pa.list_(pa.int16())),
                    pa.array([place(g[0], o) for g, o in zip(got, base, strict=True)], pa.int32()),
                    pa.array([g[1] for g in got], pa.list_(pa.int8())),
                    pa.array([[place(x, o) for x in g[2]] for g, o in zip(got, base, strict=True)], pa.list_(pa.int32())),
                    pa.array([p[: LABEL_REACH + 1] if n == 0 else "" for p, n in zip(seen, no, strict=True)], pa.string()),
                ],
                names=["__k", "__c", "__fn", "__lead", "__y", "__at", "__head"],
            )

    def scan(pdf):
        pdf = pdf.sort_values("__c")
        done = compose_scan(np.stack([np.asarray(f, dtype=np.int16) for f in pdf["__fn"]]))
        return pdf[["__k", "__c"]].assign(__s=np.concatenate(([START], done[:-1, START])).astype("int32"))

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, y, at, state = (batch.column(c).to_pylist() for c in ("__lead", "__y", "__at", "__s"))
            got = [emit(*x) for x in zip(lead, y, at, state, strict=True)]
            ends = pa.array([[{"spoke": s, "after": a} for s, a in g[1]] for g in got], pa.list_(pa.struct([("spoke", pa.bool_()), ("after", pa.int32())])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("__k", "__c", "__lead", "__head")), ends, pa.array([g[2] for g in got], pa.bool_())], names=["__k", "__c", "__lead", "__head", "__e", "__spoke"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for parts in batch.column("__parts").to_pylist():
                found.append(join_chunks([(p["__lead"], [(e["spoke"], e["after"]) for e in p["__e"]], p["__spoke"]) for p in parts], parts[0]["__head"]))
            flat = pa.RecordBatch.from_arrays([*(batch.column("__k").field(i) for i in range(len(keys)))], names=keys)
            yield _rows(flat, keys, found)

    pieces = slim.mapInArrow(slices, f"__k {kind}, __c int, __base int, __lo int, __hi int, __p string").repartition("__k", "__c")
    # read twice, by the scan and by the emission: the exchange after it is shared
    tokens = pieces.mapInArrow(lexed, f"__k {kind}, __c int, __fn array<smallint>, __lead int, __y array<tinyint>, __at array<int>, __head string").repartition("__k", "__c")
    begun = tokens.select("__k", "__c", "__fn").groupBy("__k").applyInPandas(scan, f"__k {kind}, __c int, __s int")
    done = tokens.drop("__fn").join(begun, ["__k", "__c"]).mapInArrow(emitted, f"__k {kind}, __c int, __lead int, __head string, __e {_ENDS}, __spoke boolean")
    whole = done.groupBy("__k").agg(F.array_sort(F.collect_list(F.struct("__c", "__lead", "__head", "__e", "__spoke"))).alias("__parts"))
    types = dict(df.dtypes)
    return whole.mapInArrow(joined, ", ".join(f"`{k}` {types[k]}" for k in keys) + ", sentence_no int, char_pos int")
