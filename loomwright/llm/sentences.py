"""Sentence boundaries across languages and scripts.

The rules are a finite transducer over events: clusters of closing marks, quotation marks, line ends
and sentence-final particles. What stands around an event makes it one of finitely many symbols, and
each symbol is compiled once to a row of the transition table: for every state, the kind of quotation
a text is in, the state that follows and whether a sentence ends. A long text is cut into chunks; each
chunk is a function from the state it is entered in to the state it is left in and the sentences it
closes, and the functions are composed by a parallel prefix scan. Abbreviations beyond the common ones
are learned from all texts: a full stop stands beside them nearly always, and nearly never at the end
of a line or text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.operators.skew import fits
from loomwright.session import cut

#: Characters a chunk of a long text has, and those around it that a decision in it may look at.
CHUNK, CONTEXT = 32_768, 512
#: Chunks whose functions one task composes; blocks of them are composed in their turn.
BLOCK = 1_024
#: Letters of an abbreviation that is learned, times it must have been seen, most of its uses without a full stop and before one word.
LEARNED, SEEN, PLAIN, ALIKE = (2, 5), 12, 0.1, 0.5
#: Most of its uses at the end of a line or text, and how sure it must be that this is less than other words have (in nats, for words of three letters).
LAST, SURE = 0.01, 10.0

# Quotation marks by the state they open, and what closes each state.
OPENERS = {'"': 1, "“": 2, "«": 3, "„": 4, "「": 5, "『": 6}
CLOSERS = {1: '"', 2: "”", 3: "»", 4: "“”", 5: "」", 6: "』"}
KINDS = 7
#: A state is a kind of quotation (0: none), plus KINDS if a colon led into it.
STATES = 2 * KINDS

# Abbreviations that something always follows.
NEVER_LAST = frozenset(
    """dr mr mrs ms prof capt col gen lt sgt st mk vs cf approx ca incl excl sect fig tab abschn nr nos v vol pp p pt ch ed eq i.e e.g
    gov sen rep hon pres hdb bd hrsg
    viz min max lv lvl rev bzw vgl evtl ggf inkl z.b d.h u.a s.o z.t mme mlle env tabl p.ex c.-à-d sr sra srta ej p.ej pág págs aprox núm art
    ур табл напр проф г-н г-жа гр им см рис стр т.е т.к тыс ед мин млн млрд ул д-р акад др.
    डॉ श्री कि.ग्रा د أ م كغ น พ.ศ""".split()
)
# Abbreviations of counters and months, which only a number makes one.
NUMBERED = frozenset("no nr nos jan feb mar apr jun jul aug sep sept oct okt nov dec dez".split())
# Words before a German ordinal number.
ORDINAL_LEADS = frozenset("der die das dem den des am im vom zum beim seit ab bis jeder jede jedes".split())
# Particles that end a Thai sentence where a blank follows.
THAI_FINALS = ("ครับ", "ค่ะ", "คะ", "นะ", "บ้าง", "แล้ว", "จ้ะ", "จ้า")

_STOPS = ".!?…。！？．｡؟।॥‼⁇⁉"
_WIDE = "。！？｡"
_JOINTS = "、，,）)】；"
# a full stop within a word or number is no event, but one that lacks its blank before a capital word is
_EVENT = re.compile(rf"(?:[{_STOPS[1:]}]|\.(?!\w)|\.(?=[A-ZА-ЯЁ][a-zа-яё’' ]))[{_STOPS}]*(?:[\s​]*[»)\]）］}}”’」』\"“])*|[\"“”«»„「」『』]|\n|(?:{'|'.join(THAI_FINALS)})(?=\s)")
_STRUCTURE = re.compile(r"[ \t]*(?:[-*•–·◦▪+>]\s|#{1,6}\s|\(?\d{1,3}[.)]\s|\[\d{1,2}:\d\d(?::\d\d)?\]|\d{1,2}:\d\d(?::\d\d)?\s+\S+:\s|[A-ZА-ЯЁ][\w'-]{1,24}:\s)")
_SPEAKER = re.compile(r"[ \t]*(?:\[\d{1,2}:\d\d(?::\d\d)?\]|[A-ZА-ЯЁ][\w'-]{1,24}:\s)")
#: No abbreviation is longer.
LONGEST = 12
_OPENING = "\"“«„「『([（*—–-/:¿¡'"
_LEAD = re.compile(r"([^\W\d_]+)[ \xa0]$")
_EARLIER = re.compile(r"(\w+)\.[ \xa0]?$")
_COUNTED = re.compile(r"\d[ \xa0]?$")
# Abbreviations that may end a sentence, but not before a small letter.
_RESTING = frozenset("etc usw std sek incl inc ltd co corp jr".split())
# A word that may be a learned abbreviation, where it has its full stop.
_DOTTED = re.compile(r"(?<![\w.'’-])([^\W\d_]{%d,%d})\.(?:[ \t]*(\n|\Z)|(?=[ \xa0]\s*(\d|\w{,12}|\S)))" % LEARNED)
_DOTTED_WRAPPED = re.compile(r"(?<![\w.'’-])([^\W\d_]{%d,%d})\.(?:[ \t]*(\n[ \t]*\n|\Z)|(?=\s+(\d|\w{,12}|\S)))" % LEARNED)
# Words by which a sentence goes on after a quotation that a colon led into.
_GOES_ON = re.compile("然后|就|便|并|接着|随后|之后|又|还|这样|他|她|と|って|라고|하고|고")
_LIST_NUMBER = re.compile(r"(?:^|\n)[ \t]*[(#*]*\d{1,3}$")
_WRAPPED = re.compile(r"[^ \t\n]*")
_COLONS = (":", "：")
_SPACE = re.compile(r"[\s​]*")


def layout(text: str) -> tuple[int, bool]:
    """The width the text is wrapped to (0 if it is not) and whether its lines are turns of a chat."""
    if "\n" not in text:
        return 0, False
    lines = text.split("\n")
    full = [x for x in lines if x.strip()]
    turns = sum(1 for x in full if _SPEAKER.match(x))
    # a line that another follows at once may have been wrapped; the last of a paragraph was not
    widest = max((len(x) for x, y in zip(lines, lines[1:]) if x and y and not _STRUCTURE.match(x)), default=0)
    return (widest if 30 <= widest <= 130 else 0), turns * 3 >= len(full) > 1


def _capital(c: str) -> bool:
    return c.isupper() or c.istitle()


class Row:
    """A row of the transition table: for every state the next one, and which end of the event closes a sentence.

    ``ends[state]`` is -1 for none, else the number of closing marks that belong to the sentence.
    ``unsure`` tells that it ends only if the word before is no abbreviation.
    """

    __slots__ = ("next", "ends", "unsure")

    def __init__(self, following: list[int], ends: list[int], unsure: list[bool] | None = None) -> None:
        self.next, self.ends, self.unsure = following, ends, unsure or [False] * STATES


_SAME = list(range(STATES))
_NONE = [-1] * STATES
_IN_NONE = [0 if not state % KINDS else -1 for state in range(STATES)]
#: Rows of symbols without variants: a line end that closes in any state, one that a quotation goes over, a particle, a plain stop.
HARD, WRAPPED, PARTICLE = Row([0] * STATES, [0] * STATES), Row([s if s % KINDS else 0 for s in _SAME], _IN_NONE), Row(_SAME, _IN_NONE)
STOP, UNSURE_STOP = Row(_SAME, _IN_NONE), Row(_SAME, _IN_NONE, [True] * STATES)


def _turned(c: str, opens: bool, led: bool, state: int) -> int:
    """The state after the quotation mark ``c``."""
    if state % KINDS:
        return 0 if c in CLOSERS[state % KINDS] else state
    return OPENERS[c] + KINDS * led if opens and c in OPENERS else 0


@lru_cache(maxsize=None)
def quoting(c: str, opens: bool, led: bool) -> Row:
    """The row of a quotation mark that is no part of a cluster."""
    return Row([_turned(c, opens, led, state) for state in _SAME], _NONE)


@lru_cache(maxsize=65_536)
def closing_marks(seen: tuple, contexts: tuple) -> Row:
    """The row of a cluster of closing marks.

    ``seen`` has what closes after the marks: ``(mark, after a blank, opens, led)``; ``contexts`` what
    ``_context`` says after each number of those.
    """
    following, ends, unsure = [], [], []
    for inside in _SAME:
        state, end, text, opener = inside if inside % KINDS else 0, 0, "", None
        for n, (q, spaced, opens, led) in enumerate(seen):
            if q in "\"“”»」』":
                if state and q in CLOSERS[state % KINDS]:
                    state = 0
                elif state:
                    break
                elif q in OPENERS or spaced:
                    # an opening mark after a blank begins the next sentence
                    opener = (q, opens, led)
                    break
            elif spaced:
                break
            text += q
            end = n + 1
        if state:
            following.append(state)
            ends.append(-1)
            unsure.append(False)
            continue
        following.append(_turned(*opener, 0) if opener else 0)
        verdict = _ends(contexts[end], inside, text)
        ends.append(end if verdict else -1)
        unsure.append(verdict == MAYBE)
    return Row(following, ends, unsure)


#: What ends a sentence: nothing, something, or something unless the word before is an abbreviation.
NO, YES, MAYBE = 0, 1, 2


def events(text: str, low: int, high: int, width: int, chat: bool) -> Iterator[tuple[Row, tuple, str | None]]:
    """The events that begin in ``[low, high)``: the row of each, its ``(end, next start)`` by number of closing marks, and the word before a stop."""
    size = len(text)
    last = low
    for event in _EVENT.finditer(text, low):
        at = event.start()
        if at >= high:
            break
        if at < last:
            continue
        c, stop = text[at], event.end()
        if c == "\n":
            after = _SPACE.match(text, stop).end()
            gap = text.count("\n", at, after)
            last = after
            if after < size and not _hard_break(text, at, after, gap, width, chat):
                continue
            end = at
            while end > 0 and text[end - 1].isspace():
                end -= 1
            # a quotation goes on over the line ends of a wrapped text
            wrapped = after < size and width and gap == 1 and not chat and not _STRUCTURE.match(text, stop)
            yield (WRAPPED if wrapped else HARD), ((end, after),), None
            continue
        if c in "\"“”«»„「」『』":
            yield quoting(c, *_opening(text, at)), (), None
            continue
        if c not in _STOPS:
            yield PARTICLE, ((stop, _SPACE.match(text, stop).end()),), None
            continue
        if stop == at + 1:
            behind, then = text[stop : stop + 1], text[stop + 1 : stop + 2]
            if behind == " " and ("A" <= then <= "Z" or "А" <= then <= "Я"):
                # the common case: one mark, a blank and a capital
                if c != ".":
                    yield STOP, ((stop, stop + 1),), None
                elif (word := _abbreviated(text, at, stop + 1, False)) is not True:
                    yield (UNSURE_STOP if word else STOP), ((stop, stop + 1),), word or None
                continue
            if behind == " " and "a" <= then <= "z" and c in "!?":
                yield STOP, ((stop, stop + 1),), None
                continue
        # a cluster of closing marks with what closes after it
        marks = at
        while marks < stop and text[marks] in _STOPS:
            marks += 1
        seen, spans = [], [marks]
        for i in range(marks, stop):
            q = text[i]
            if not q.isspace() and q != "​":
                seen.append((q, text[i - 1].isspace(), *_opening(text, i)))
                spans.append(i + 1)
        pairs = tuple((end, _SPACE.match(text, end).end()) for end in spans)
        told = [_context(text, at, marks, end, after) for end, after in pairs]
        word = next((w for _, w in told if w), None)
        yield closing_marks(tuple(seen), tuple(x for x, _ in told)), pairs, word


def scan(text: str, low: int, high: int, state: int, width: int, chat: bool, known: frozenset | set = frozenset()) -> tuple[list[tuple[int, int]], int]:
    """Boundaries ``(end, next start)`` whose events begin in ``[low, high)`` and the state at ``high``."""
    out = []
    for row, pairs, word in events(text, low, high, width, chat):
        n = row.ends[state]
        if n >= 0 and not (row.unsure[state] and word in known):
            out.append(pairs[n])
        state = row.next[state]
    return out, state


def _opening(text: str, at: int) -> tuple[bool, bool]:
    """Whether the quotation mark at ``at`` can open a quotation, and whether a colon leads into it."""
    led = text[max(0, at - 4) : at].rstrip()[-1:] in _COLONS and at > 0
    if text[at] != '"':
        return text[at] in OPENERS, led
    before, behind = text[at - 1 : at], text[at + 1 : at + 2]
    opens = not before or before.isspace() or not before.isalnum() and before not in ".,!?)%"
    return bool(opens and behind and not behind.isspace()), led


def _hard_break(text: str, at: int, after: int, gap: int, width: int, chat: bool) -> bool:
    """Whether a line end is the end of a unit and not a wrap."""
    if gap > 1 or chat:
        return True
    if _STRUCTURE.match(text, at + 1):
        return True
    if not width and not text[after].islower():
        return True
    begun = text.rfind("\n", 0, at) + 1
    if text[after].islower():
        return False
    word = _WRAPPED.match(text, after).end() - after
    # a wrapped line is full: the next word would not have fitted, or it stops well past the middle without a closing mark
    full = (at - begun) + 1 + word > width
    return not full and ((at - begun) * 2 < width or text[at - 1] in _STOPS)


def _context(text: str, at: int, marks: int, end: int, after: int) -> tuple[tuple, str | None]:
    """What stands around the cluster at ``[at, marks)``, closed until ``end``, as predicates; and the word before it if that may be an abbreviation."""
    if after >= len(text):
        return ("over",), None
    cluster = text[at:marks]
    following = text[after]
    wide = cluster[0] in _WIDE or cluster[-1] in _WIDE
    dot = cluster in (".", "．")
    goes_on = wide and bool(_GOES_ON.match(text, after))
    if after == end:
        asked = following.isalpha() and text[at - 1].isalpha() and any(c in "!?؟" for c in cluster)
        begun = _capital(following) and (text[after + 1 : after + 2].islower() or text[after + 1 : after + 2] in " '’")
        word = _abbreviated(text, at, after, False) if dot and begun else None
        return ("tight", wide, goes_on, following in _JOINTS, asked, begun, word is True, bool(word) and word is not True), word if isinstance(word, str) else None
    if following in "—–-":
        # who said it follows after a dash
        said = text[_SPACE.match(text, after + 1).end() :][:1] if after + 80 > len(text) else text[_SPACE.match(text, after + 1).end() : after + 80][:1]
        return ("dash", bool(said) and not said.islower()), None
    small = following.lower() != following.upper() and following.islower()
    fresh = (_capital(following) or following in "\"“«„¿¡([#*•" or following.isdigit()) and not small
    word = _abbreviated(text, at, after, small) if cluster == "." or dot and not small else None
    return ("blank", wide, goes_on, fresh, small, "…" in cluster or cluster.startswith(".."), word is True, bool(word) and word is not True), word if isinstance(word, str) else None


def _ends(context: tuple, inside: int, closing: str) -> int:
    """Whether a cluster ends a sentence, by what stands around it, the state it is met in and what closes after it."""
    kind, *told = context
    quoted = inside % KINDS and closing
    if kind == "over":
        return YES
    if kind == "dash":
        return YES if told[0] else NO
    if kind == "tight":
        # without a blank only marks of spaceless scripts end a sentence, and not where a quotation goes on
        wide, goes_on, joint, asked, begun, short, unsure = told
        if quoted:
            return YES if wide and inside >= KINDS and not goes_on and not joint else NO
        if wide:
            return NO if joint else YES
        if not closing and asked:
            return YES
        if closing or not begun or short:
            return NO
        return MAYBE if unsure else YES
    wide, goes_on, fresh, small, pause, short, unsure = told
    if quoted and any(q in "\"“”»」』" for q in closing):
        if wide and inside >= KINDS:
            return NO if goes_on else YES
        # a quotation closed inside a sentence: only a fresh start splits
        return YES if fresh else NO
    # a pause goes on in small letters; else a sentence may well begin so
    if small and pause or short:
        return NO
    return MAYBE if unsure else YES


def _abbreviated(text: str, at: int, after: int, small: bool) -> bool | str:
    """Whether the full stop at ``at`` belongs to an abbreviation, an initial, an ordinal or a list mark; the word itself if it may be learned to."""
    before = text[max(0, at - 40) : at]
    begin = max(before.rfind(" "), before.rfind("\n"), before.rfind("\xa0")) + 1
    if len(before) - begin > LONGEST:
        return False
    word = before[begin:].lstrip(_OPENING)
    following = text[after]
    if not word:
        return False
    bare = word.strip(".'’-*")
    low = bare.lower()
    if word.isdigit():
        if _LIST_NUMBER.search(before):
            return True
        lead = _LEAD.search(before[: len(before) - len(word)])
        return len(word) <= 3 and bool(lead) and lead[1].lower() in ORDINAL_LEADS
    if low in NUMBERED:
        return following.isdigit() or following in "#№"
    if low in NEVER_LAST:
        return True
    rest = before[max(0, begin - 12) : len(before) - len(word)]
    if len(bare) <= 2:
        earlier = _EARLIER.search(rest)
        if earlier and f"{earlier[1].lower()}.{low}" in NEVER_LAST:
            return True
        if len(bare) == 1:
            if following.isdigit():
                return True
            # an initial or a title is a capital; a small letter is a unit or ends "and so on"
            if bare.isalpha() and bare.islower() and bare.upper() != bare:
                return small or (earlier is None and not _COUNTED.search(rest))
            return bare.isalpha()
    elif small and ("." in bare or low in _RESTING):
        return True
    return low if LEARNED[0] <= len(bare) <= LEARNED[1] and word == bare and bare.isalpha() else False


def sentences(text: str, known: frozenset | set = frozenset()) -> list[tuple[int, int]]:
    """Sentences of a whole text as (start, end), ``known`` being learned abbreviations; a blank text has none."""
    size = len(text)
    start = _SPACE.match(text).end()
    if start >= size:
        return []
    found, _ = scan(text, start, size, 0, *layout(text), known)
    return _spans(found, start, len(text.rstrip()))


def _spans(found: list[tuple[int, int]], start: int, tail: int) -> list[tuple[int, int]]:
    out = []
    for end, following in found:
        if end > start:
            out.append((start, end))
        start = max(start, following)
    if start < tail:
        out.append((start, tail))
    return out


_OUT = "doc_id bigint, start_char bigint, end_char bigint"
#: What one reading of the texts yields, in rows of three kinds: whole texts with their boundaries, chunks of long texts, and counts of words.
WHOLE, CHUNKED, COUNTED = 0, 1, 2
_READ = (
    "kind int, doc_id bigint, lang string, uid bigint, chunk int, start int, tail int, bounds array<int>, words array<string>, "
    "base int, low int, high int, last boolean, width int, chat boolean, text string, word string, after string, dotted bigint, ending bigint, plain bigint"
)
_READ_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("doc_id", pa.int64()), ("lang", pa.string()), ("uid", pa.int64()), ("chunk", pa.int32()), ("start", pa.int32()), ("tail", pa.int32()), ("bounds", pa.list_(pa.int32())), ("words", pa.list_(pa.string()))]
    + [(x, pa.int32()) for x in ("base", "low", "high")] + [("last", pa.bool_()), ("width", pa.int32()), ("chat", pa.bool_()), ("text", pa.string()), ("word", pa.string()), ("after", pa.string())] + [(x, pa.int64()) for x in ("dotted", "ending", "plain")]
)


def _counted(text: str, width: int, dotted: Counter, ending: Counter, plain: Counter) -> None:
    """Count the short words of a text with a full stop and what follows, with one at the end of a line or text, and all words between blanks."""
    for m in (_DOTTED_WRAPPED if width else _DOTTED).finditer(text):
        if m[2] is None:
            dotted[m[1], "0" if m[3].isdigit() else m[3]] += 1
        else:
            ending[m[1]] += 1
    plain.update(text.split())


def _lower(counts: Counter) -> Counter:
    out: Counter = Counter()
    for word, n in counts.items():
        out[word.lower() if isinstance(word, str) else (word[0].lower(), word[1].lower())] += n
    return out


def _reader(chunk: int):
    """The map that reads every text once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        uid = (context.partitionId() if context else 0) << 33
        as_batch = lambda rows: pa.RecordBatch.from_pylist(rows, schema=_READ_SCHEMA)
        for batch in batches:
            counts: dict[str, tuple[Counter, Counter, Counter]] = {}
            rows = []
            for doc, lang, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                text, uid = text.as_py(), uid + 1
                start, size = _SPACE.match(text).end(), len(text)
                if start >= size:
                    continue
                width, chat = layout(text)
                _counted(text, width, *counts.setdefault(lang, (Counter(), Counter(), Counter())))
                if size <= chunk:
                    # one chunk, entered in no quotation: a word before a doubtful boundary stays beside it
                    bounds, words, state = [], [], 0
                    for row, pairs, word in events(text, start, size, width, chat):
                        n = row.ends[state]
                        if n >= 0:
                            bounds += pairs[n]
                            words.append(word if row.unsure[state] else None)
                        state = row.next[state]
                    rows.append({"kind": WHOLE, "doc_id": doc, "lang": lang, "uid": uid, "chunk": 0, "start": start, "tail": len(text.rstrip()), "bounds": bounds, "words": words})
                    continue
                for number, base, low, high in _cuts(text, start, chunk):
                    piece = text[base : high + CONTEXT]
                    words = sorted({m[1].lower() for m in _DOTTED_WRAPPED.finditer(piece)})
                    rows.append({
                        "kind": CHUNKED, "doc_id": doc, "lang": lang, "uid": uid, "chunk": number, "words": words, "base": base, "low": low, "high": high,
                        "last": high >= size, "width": width, "chat": chat, "text": piece,
                    })
                    if len(rows) > 64:
                        yield as_batch(rows)
                        rows = []
            for lang, (dotted, ending, plain) in counts.items():
                dotted, ending = _lower(dotted), _lower(ending)
                plain = _lower(Counter({w: n for w, n in plain.items() if LEARNED[0] <= len(w) <= LEARNED[1] and w.isalpha()}))
                rows += [{"kind": COUNTED, "lang": lang, "word": w, "after": after, "dotted": n, "ending": 0, "plain": 0} for (w, after), n in dotted.items()]
                rows += [{"kind": COUNTED, "lang": lang, "word": w, "dotted": 0, "ending": ending[w], "plain": plain[w]} for w in ending | plain]
            yield as_batch(rows)

    return read


def _cuts(text: str, low: int, chunk: int) -> Iterator[tuple[int, int, int, int]]:
    """``(number, base, low, high)`` of the chunks of a text, each with CONTEXT characters on both sides."""
    number, size = 0, len(text)
    while low < size:
        high = min(size, low + chunk)
        # blanks, and marks that stand together, stay with the chunk before
        while high < size and (text[high] in _STOPS or text[high].isspace() or text[high] in "\"“”»」』)​" or text[high - 1] in _STOPS):
            high += 1
        yield number, max(0, low - CONTEXT), low, high
        low, number = high, number + 1


def abbreviations(counts: DataFrame) -> DataFrame:
    """``(lang, word)`` that a full stop makes no end of sentence after, by ``counts(lang, word, after, dotted, ending, plain)``.

    A word nearly always has its full stop, is followed by this and that, and nearly never stands last
    in a line or text, though the words of its language with a full stop do so often enough that
    chance would have put it there. Of longer words more is asked, as few of them are abbreviations.
    """
    pairs = counts.groupBy("lang", "word", "after").agg(*[F.sum(c).alias(c) for c in ("dotted", "ending", "plain")])
    words = pairs.groupBy("lang", "word").agg(*[F.sum(c).alias(c) for c in ("dotted", "ending", "plain")], F.max("dotted").alias("most")).filter("dotted + ending > 0")
    rates = words.groupBy("lang").agg((F.sum("ending") / F.sum(F.col("dotted") + F.col("ending"))).alias("rate"))  # a row a language
    with_stop = F.col("dotted") + F.col("ending")
    sure = with_stop * -F.log(F.greatest(1 - F.col("rate"), F.lit(1e-9))) >= SURE * F.exp(F.greatest(F.length("word") - 3, F.lit(0)))
    seldom = (F.col("plain") <= PLAIN * (F.col("plain") + with_stop)) & (F.col("ending") <= LAST * with_stop)
    return words.filter((with_stop >= SEEN) & seldom & (F.col("most") <= ALIKE * F.col("dotted"))).join(rates, "lang").filter(sure).select("lang", "word")


def _knowing(rows: DataFrame, learned: DataFrame) -> tuple[DataFrame, object]:
    """``rows`` with ``known``, the learned abbreviations among their words, or these as one broadcast if they are counted to be few."""
    if fits(learned):
        known: dict[str, set[str]] = {}
        for lang, word in learned.collect():
            known.setdefault(lang, set()).add(word)
        return rows.withColumn("known", F.lit(None).cast("array<string>")), rows.sparkSession.sparkContext.broadcast(known)
    here = rows.select("uid", "chunk", "lang", F.explode(F.array_distinct("words")).alias("word")).join(learned, ["lang", "word"], "left_semi")
    return rows.join(here.groupBy("uid", "chunk").agg(F.collect_set("word").alias("known")), ["uid", "chunk"], "left"), None


def _rows(ids: list, starts: list, ends: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["doc_id", "start_char", "end_char"])


def _settled(shared):
    """The map from whole texts with doubtful boundaries to their sentences."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, ends = [], [], []
            for doc, lang, start, tail, bounds, words, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "start", "tail", "bounds", "words", "known"))):
                known = shared.value.get(lang, ()) if shared else own or ()
                found = zip(bounds[::2], bounds[1::2])
                if known:
                    found = [pair for pair, word in zip(found, words) if word is None or word not in known]
                spans = _spans(found, start, tail)
                if spans:
                    a, b = zip(*spans)
                    ids += [doc] * len(spans)
                    starts += a
                    ends += b
            yield _rows(ids, starts, ends)

    return settle


_FUNCTION = "doc_id bigint, uid bigint, chunk int, low int, last boolean, tail int, goes array<int>, nexts array<int>, lists array<int>, found array<array<int>>"


def _functions(shared):
    """The map from chunks to functions: for every state one is entered in, the state it is left in, where the sentence after its last boundary begins (-1: no boundary), and which of the lists of boundaries is its."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text, base = row["text"], row["base"]
                known = shared.value.get(row["lang"], ()) if shared else row["known"] or ()
                live: dict[int, list] = {s: [s, []] for s in _SAME}  # by state entered: state now, boundaries
                for table, pairs, word in events(text, row["low"] - base, row["high"] - base, row["width"], row["chat"]):
                    for of in live.values():
                        n = table.ends[of[0]]
                        if n >= 0 and not (table.unsure[of[0]] and word in known):
                            of[1] += (pairs[n][0] + base, pairs[n][1] + base)
                        of[0] = table.next[of[0]]
                lists: dict[tuple, int] = {}
                which = [lists.setdefault(tuple(live[s][1]), len(lists)) for s in _SAME]
                nexts = [max(live[s][1][1::2], default=-1) for s in _SAME]
                rows.append((row["doc_id"], row["uid"], row["chunk"], row["low"], row["last"], base + len(text.rstrip()), [live[s][0] for s in _SAME], nexts, which, [list(x) for x in lists]))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.list_(pa.int32()))]
            columns = list(zip(*rows)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=[x.split()[0] for x in _FUNCTION.split(", ")])

    return apply


def composed(goes: np.ndarray, nexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inclusive prefix scan of ``n`` functions over states by doubling: row i composes rows 0 to i.

    ``goes[i, s]`` is the state that i is left in, ``nexts[i, s]`` the begin that it hands on, -1 for none.
    """
    goes, nexts, step = goes.copy(), nexts.copy(), 1
    while step < len(goes):
        first, second = goes[:-step].copy(), goes[step:].copy()
        handed = np.take_along_axis(nexts[step:], first, 1)
        nexts[step:] = np.where(handed >= 0, handed, nexts[:-step])
        goes[step:] = np.take_along_axis(second, first, 1)
        step *= 2
    return goes, nexts


_COMPOSED = "uid bigint, block int, chunk int, goes array<int>, nexts array<int>"


def _compose(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("chunk")
    goes, nexts = composed(np.stack(frame["goes"].to_numpy()).astype(np.int64), np.stack(frame["nexts"].to_numpy()).astype(np.int64))
    return pd.DataFrame({"uid": frame["uid"], "block": frame["block"], "chunk": frame["chunk"], "goes": list(goes), "nexts": list(nexts)})


def entered(functions: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(uid, chunk, state, start)``: the state each chunk is entered in and where the sentence begins that it is entered in.

    A blocked prefix scan: functions are composed within blocks, in any order of blocks; then those of
    whole blocks; then both are put together. A task never has more than ``block`` functions, and a
    text of 2^31 characters, more than a row can hold, has 64 blocks.
    """
    narrow = functions.select("uid", F.floor(F.col("chunk") / block).cast("int").alias("block"), "chunk", "goes", "nexts")
    inner = cut(narrow.groupBy("uid", "block").applyInPandas(_compose, _COMPOSED))
    ends = inner.groupBy("uid", "block").agg(F.max_by(F.struct("goes", "nexts"), "chunk").alias("f"))
    outer = ends.select("uid", F.lit(0).alias("block"), F.col("block").alias("chunk"), "f.*").groupBy("uid").applyInPandas(_compose, _COMPOSED)
    before = outer.select("uid", (F.col("chunk") + 1).alias("block"), F.col("goes")[0].alias("into"), F.col("nexts")[0].alias("begun"))
    # the prefix before a chunk is the one up to the chunk before it
    mine = inner.select("uid", F.floor((F.col("chunk") + 1) / block).cast("int").alias("block"), (F.col("chunk") + 1).alias("chunk"), "goes", "nexts").filter(F.col("chunk") % block != 0)
    places = functions.select("uid", F.floor(F.col("chunk") / block).cast("int").alias("block"), "chunk", "low")
    joined = places.join(before, ["uid", "block"], "left").join(mine.drop("block"), ["uid", "chunk"], "left")
    into = F.coalesce("into", F.lit(0))
    handed = F.when(F.col("nexts")[into] >= 0, F.col("nexts")[into]).when(F.col("begun") >= 0, F.col("begun"))
    first = functions.filter("chunk = 0").select("uid", F.col("low").alias("first"))
    return joined.join(first, "uid").select("uid", "chunk", F.coalesce(F.col("goes")[into], into).alias("state"), F.coalesce(handed, F.col("first")).alias("start"))


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, starts, ends = [], [], []
        for row in batch.to_pylist():
            spans = _spans(list(zip(row["closed"][::2], row["closed"][1::2])), row["start"], row["tail"] if row["last"] else 0)
            ids += [row["doc_id"]] * len(spans)
            starts += [a for a, _ in spans]
            ends += [b for _, b in spans]
        yield _rows(ids, starts, ends)


def split(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, start_char, end_char)``: every sentence of every text, by code points, end exclusive.

    A text that is null or blank has no sentences. ``lang`` is the language that abbreviations are
    learned by, all texts being of one if it is null. Texts are read once: one of at most ``chunk``
    characters is one chunk and needs no scan; a longer one is cut and its chunks run anywhere. A
    sentence may be longer than a chunk. Rows that repeat are split each; extra columns are ignored.
    """
    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(F.lower(lang) if lang is not None else F.lit(""), F.lit("")).alias("lang"))
    read = cut(rows.filter(F.col("text").isNotNull()).mapInArrow(_reader(chunk), _READ))
    learned = cut(abbreviations(read.filter(F.col("kind") == COUNTED).select("lang", "word", "after", "dotted", "ending", "plain")))
    whole, known = _knowing(read.filter(F.col("kind") == WHOLE).select("doc_id", "lang", "uid", "chunk", "start", "tail", "bounds", "words"), learned)
    short = whole.mapInArrow(_settled(known), _OUT)
    long = read.filter(F.col("kind") == CHUNKED)
    if long.isEmpty():
        return short
    chunks, known = _knowing(long.select("doc_id", "lang", "uid", "chunk", "words", "base", "low", "high", "last", "width", "chat", "text"), learned)
    functions = cut(chunks.repartition("uid", "chunk").mapInArrow(_functions(known), _FUNCTION))
    placed = functions.join(entered(functions), ["uid", "chunk"])
    closed = F.col("found")[F.col("lists")[F.col("state")]]
    return short.unionByName(placed.select("doc_id", "start", "tail", "last", closed.alias("closed")).mapInArrow(_resolved, _OUT))
