"""Evaluation texts leaking into training text.

Both sides are brought to a skeleton: letters and digits only, case and look-alikes folded, nothing
else kept. Seeds of the test items are joined with every document's skeleton by running hash; where
they meet, greedy string tiling marks the longest common stretches, longest first and none twice, and
the tiles that follow each other in the item's order are taken for one passage.
"""

from __future__ import annotations

import bisect
import heapq
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.operators.skew import fits

#: Share of an item's words that a passage must hold, and share of the passage's words that may differ.
SHARE, CHANGED = 0.4, 0.1
#: Characters of a seed; less only for items of which some run of words is shorter.
SEED = 12
#: Characters of the shortest tile.
TILE = 8
#: Characters that are looked at together. A longer text is taken in parts that overlap by STRETCH times the longest item.
PART, STRETCH = 2_000_000, 8
#: Items that are joined at once; more are taken in blocks, each against all documents.
BLOCK = 20_000

# Look-alikes, letter by letter below what they look like.
ALIKE_FROM = "АВЕЅІЈКМНОРСТУХҮԌԚԜаесорхуіјѕԁԛԝһӏкмтвнΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορνικτυχεɑɡıℓ"
ALIKE_TO = "abesijkmhopctyxygqwaecopxyijsdqwhlkmtbhabezhikmnoptyxaopviktuxeagil"

#: Texts, and characters of each, by which seeds are ranked. They decide which seeds are used, not what is found.
SAMPLE, SAMPLE_CHARS = 1_000, 2_000

# Blocks of scripts written without spaces, of which each letter counts as a word.
SPACELESS = ((0x0E00, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _table() -> np.ndarray:
    """The skeleton's code point of every code point, 0 for what is left out."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x20000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or unicodedata.category(c)[0] not in "LN":
            continue
        folded = unicodedata.normalize("NFKD", c).casefold()
        letters = [x for x in folded if unicodedata.category(x)[0] in "LN"]
        if letters:
            table[code] = ord(letters[0])
    for code in range(0x20000, 0x32000):
        table[code] = code
    for a, b in zip(ALIKE_FROM, ALIKE_TO):
        table[ord(a)] = ord(b)
        table[ord(a.lower())] = ord(b) if a.lower() not in ALIKE_FROM else table[ord(a.lower())]
    return table


_TABLE: np.ndarray | None = None


def _codes(text: str) -> np.ndarray:
    global _TABLE
    if _TABLE is None:
        _TABLE = _table()
    return _TABLE[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def _bones(text: str) -> np.ndarray:
    codes = _codes(text)
    return codes[codes > 0]


def skeleton(text: str) -> str:
    """Letters and digits of ``text``, folded."""
    return _bones(text).tobytes().decode("utf-32-le")


def _heads(text: str, codes: np.ndarray) -> np.ndarray:
    """Whether each letter of the skeleton begins a word: after white space, or as a letter of a script without spaces."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    blank = np.isin(points, _BLANKS)
    kept = codes > 0
    gaps = np.cumsum(blank)[kept]
    bones = codes[kept]
    heads = np.ones(len(bones), bool)
    heads[1:] = gaps[1:] != gaps[:-1]
    for low, high in SPACELESS:
        heads |= (bones >= low) & (bones <= high)
    return heads


_BLANKS = np.array([c for c in range(0x3001) if chr(c).isspace()], np.uint32)


def rolling(codes: np.ndarray, length: int) -> np.ndarray:
    """The running hash of every window of ``length`` codes, put together from windows of powers of two."""
    with np.errstate(over="ignore"):
        power, size = codes.astype(np.uint64), 1
        done, have = None, 0
        while True:
            if length & size:
                if done is None:
                    done, have = power, size
                else:
                    n = len(codes) - have - size + 1
                    if n <= 0:
                        return np.zeros(0, np.uint64)
                    done = done[:n] * _pow(size) + power[have : have + n]
                    have += size
            if size * 2 > length:
                return done
            n = len(power) - size
            if n <= 0:
                return np.zeros(0, np.uint64)
            power = power[:n] * _pow(size) + power[size : size + n]
            size *= 2


def _pow(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 2**64))


def _spans(words: int) -> list[tuple[int, int]]:
    """Every number of words a passage of an item may have, with those of them that may be changed."""
    return [(n, int(CHANGED * n + 1e-9)) for n in range(max(1, int(np.ceil(SHARE * words - 1e-9))), words + 1)]


class Items:
    """The test items as skeletons with their words, and the seeds that lead to them.

    An unchanged run of ``run`` words is in any passage of an item, as many as its changed words leave
    together at least. Of every such run the seed that is rarest in the items and in ``sample`` is
    taken; that makes fewer false meetings, and any choice finds all passages.
    """

    def __init__(self, rows: list[tuple[int, str]], sample: list[str] = [], seed: int | None = None) -> None:
        self.ids, self.text, self.starts, self.ends = [], [], [], []
        for key, text in rows:
            codes = _codes(text)
            bones = codes[codes > 0]
            if len(bones):
                starts = np.flatnonzero(_heads(text, codes))
                self.ids.append(key)
                self.text.append(bones.tobytes().decode("utf-32-le"))
                self.starts.append(starts)
                self.ends.append(np.concatenate([starts[1:], [len(bones)]]))
        self.codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in self.text]
        self.words = [[c[a:b].tobytes() for a, b in zip(s, e)] for c, s, e in zip(self.codes, self.starts, self.ends)]
        self.run = [min(-(-(n - c) // (c + 1)) for n, c in _spans(len(s))) for s in self.starts]
        # words between two seeds of one passage at most: all that may be changed, and what is unchanged but too short for a run
        self.apart = [(_spans(len(s))[-1][1] + 1) * (run + 1) + run for s, run in zip(self.starts, self.run)]
        self.seed = seed or min([SEED, *(self.own_seed(n) for n in range(len(self.ids)))])
        hashes = [rolling(c, self.seed) for c in self.codes]
        common = Counter(h for of in hashes for h in set(of.tolist()))
        every = np.array(sorted(common), np.uint64)
        if len(every):
            for text in sample:
                met = np.unique(rolling(_bones(text), self.seed))
                slot = np.minimum(np.searchsorted(every, met), len(every) - 1)
                common.update(met[every[slot] == met].tolist())
        # a seed from every run of words, so that any unchanged run has one
        chosen: dict[int, set[int]] = defaultdict(set)
        self.grams, self.least, self.meet = [], [], []
        for n, of in enumerate(hashes):
            values = of.tolist()
            rank = [(common[h], h) for h in values]
            for low, high in self._runs(n):
                chosen[min(rank[low : high - self.seed + 1])[1]].add(n)
            self.grams.append(of)
            self.least.append(self._least(n))
            self.meet.append(self._meet(n))
        self.keys = np.array(sorted(chosen), np.uint64)
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for n, of in enumerate(hashes):
            for i, h in enumerate(of.tolist()):
                if n in chosen.get(h, ()):
                    places[h, n].append(i)
        self.owners = [[(n, places[int(h), n]) for n in sorted(chosen[int(h)])] for h in self.keys]
        self.mask = np.zeros(1 << 20, bool)
        self.mask[self.keys >> np.uint64(44)] = True

    def _runs(self, n: int) -> list[tuple[int, int]]:
        """Letters from and to of every run of words of item ``n``."""
        starts, ends, run = self.starts[n], self.ends[n], self.run[n]
        return [(int(starts[i]), int(ends[min(i + run, len(starts)) - 1])) for i in range(max(1, len(starts) - run + 1))]

    def own_seed(self, n: int) -> int:
        """Letters that a seed of item ``n`` can have: no more than its shortest run."""
        return min([SEED, *(b - a for a, b in self._runs(n))])

    def _least(self, n: int) -> int:
        """Seeds of item ``n``, by position, that a document must share at least to hold a passage of it."""
        words = len(self.starts[n])
        lengths = np.sort(self.ends[n] - self.starts[n])[::-1]
        bounds = []
        for need, changed in _spans(words):
            shortest = int((self.ends[n][need - 1 :] - self.starts[n][: words - need + 1]).min())
            # every changed word takes its own letters and the seeds that reach into it
            bounds.append(shortest - int(lengths[:changed].sum()) - (changed + 1) * (self.seed - 1))
        return max(1, min(bounds))

    def _meet(self, n: int) -> int:
        """Chosen seeds, by position, that any passage of item ``n`` has: each unchanged stretch wastes less than a run."""
        run = self.run[n]
        return max(1, min(-(-(need - c - (run - 1) * (c + 1)) // run) for need, c in _spans(len(self.starts[n]))))


def by_seed(rows: list[tuple[int, str]], sample: list[str] = []) -> list[Items]:
    """``Items`` by the length of their seeds, so that items of short runs don't shorten the seeds of all."""
    groups: dict[int, list[tuple[int, str]]] = defaultdict(list)
    for row in rows:
        one = Items([row])
        if one.ids:
            groups[one.seed].append(row)
    return [Items(of, sample, seed) for seed, of in sorted(groups.items())]


def matches(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """All common stretches that can't be made longer: ``(length, in text, in item)``."""
    left, right = rolling(item, least), rolling(text, least)
    if not len(left) or not len(right):
        return []
    order = np.argsort(left, kind="stable")
    ranked = left[order]
    low, high = np.searchsorted(ranked, right, "left"), np.searchsorted(ranked, right, "right")
    times = high - low
    j = np.repeat(np.arange(len(right)), times)
    if not len(j):
        return []
    i = order[np.repeat(low, times) + np.arange(len(j)) - np.repeat(np.cumsum(times) - times, times)]
    by = np.lexsort((j, j - i))
    i, j = i[by], j[by]
    breaks = np.flatnonzero((np.diff(j) != 1) | (np.diff(j - i) != 0)) + 1
    begin, end = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(j)]])
    return list(zip((end - begin + least - 1).tolist(), j[begin].tolist(), i[begin].tolist()))


def tiles(item: np.ndarray, text: np.ndarray, least: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(in text, in item, length)``, longest marked first, no character in two tiles."""
    heap = [(-length, j, i) for length, j, i in matches(item, text, least)]
    heapq.heapify(heap)
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    out = []
    while heap:
        length, j, i = heapq.heappop(heap)
        taken = in_item[i : i - length] | in_text[j : j - length]
        if not taken.any():
            in_item[i : i - length] = in_text[j : j - length] = True
            out.append((j, i, -length))
            continue
        # what is left of a match beside longer tiles takes its place among the rest
        edges = np.flatnonzero(np.diff(np.concatenate([[1], taken.astype(np.int8), [1]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= least:
                heapq.heappush(heap, (a - b, j + a, i + a))
    return sorted(out)


def _between(words: list[bytes], text: np.ndarray, heads: np.ndarray, mean: float, most: float) -> float:
    """Changed words between two tiles, or infinity if more than ``most``: the item's ``words`` against the letters ``text`` that stand there instead.

    Words of the item that stand there whole and in order are not changed, though too short for a
    tile. What else stands there counts by the words it begins, however long they are, or by its
    letters where these are fewer, since the spacing of a document may differ.
    """
    begun = np.flatnonzero(heads).tolist()
    more = (len(text) - sum(map(len, words)) // text.itemsize) / mean
    more = round(more) if more > 0 else 0
    if max(len(words) - len(begun), min(len(begun) - len(words), more)) > most:
        return np.inf
    kept = 0
    if words and begun:
        letters, size = text.tobytes(), text.itemsize
        spots: dict[bytes, list[int]] = {}
        for k, (a, b) in enumerate(zip(begun, [*begun[1:], len(text)])):
            spots.setdefault(letters[a * size : b * size], []).append(k)
        at = 0
        for word in words:
            found = spots.get(word, ())
            k = bisect.bisect_left(found, at)
            if k < len(found):
                kept, at = kept + 1, found[k] + 1
    lost = len(words) - kept
    cost = max(lost, min(len(begun) - kept, lost + more))
    return cost if cost <= most else np.inf


def holds(items: Items, n: int, text: np.ndarray, heads: np.ndarray) -> bool:
    """Whether the skeleton ``text``, with its words' ``heads``, has enough of item ``n`` as one passage in order."""
    item, starts, ends, words = items.codes[n], items.starts[n], items.ends[n], len(items.starts[n])
    need = SHARE * words - 1e-9
    mean = max(1.0, ends[-1] / words)
    found = tiles(item, text, min(TILE, items.seed))
    count = len(found)
    first = [int(np.searchsorted(starts, i)) for _, i, _ in found]  # first word begun in the tile
    after = [int(np.searchsorted(ends, i + length, "right")) for _, i, length in found]  # words ended by it
    whole = [max(0, b - a) for a, b in zip(first, after)]
    for a in range(count):
        if not whole[a]:
            continue
        # fewest changed words of a chain from tile a to each later one
        errors = {a: 0}
        for b in range(a, count):
            if b not in errors:
                continue
            span = after[b] - first[a]
            if span >= need and errors[b] <= CHANGED * span + 1e-9:
                return True
            jb, ib, lb = found[b]
            for c in range(b + 1, count):
                jc, ic, _ = found[c]
                if ic < ib + lb or jc < jb + lb or not whole[c]:
                    continue
                room = CHANGED * words - errors[b]
                if first[c] - after[b] > (room + 1) * (items.run[n] + 1):
                    continue
                cost = errors[b] + _between(items.words[n][after[b] : first[c]], text[jb + lb : jc], heads[jb + lb : jc], mean, room + 1e-9)
                if cost < errors.get(c, words):
                    errors[c] = cost
    return False


_OUT = "doc_id bigint, item_id bigint"


def _searcher(groups: list[Items]):
    """The map over document batches for one block of items, in groups by the length of their seeds."""
    longest = max((len(t) for items in groups for t in items.text), default=0)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            ids, texts = _parted(ids, texts, STRETCH * longest)
            out: set[tuple[int, int]] = set()
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size + len(texts[high]) < PART):
                    size += len(texts[high])
                    high += 1
                out.update(_hits(groups, ids[low:high], texts[low:high]))
                low = high
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["doc_id", "item_id"])

    return search


def _parted(ids: np.ndarray, texts: list[str], overlap: int) -> tuple[np.ndarray, list[str]]:
    """Texts longer than PART as overlapping parts under the same id; the overlap holds any passage whole."""
    if all(len(t) <= PART for t in texts):
        return ids, texts
    step = max(PART, 2 * overlap) - overlap
    pairs = [(d, t[at : at + step + overlap]) for d, t in zip(ids.tolist(), texts) for at in range(0, max(1, len(t) - overlap), step)]
    return np.array([d for d, _ in pairs], np.int64), [t for _, t in pairs]


def _hits(groups: list[Items], ids: np.ndarray, texts: list[str]) -> list[tuple[int, int]]:
    joined = "".join(texts)
    codes = _codes(joined)
    kept = codes > 0
    ends = np.cumsum([len(t) for t in texts])
    before = np.concatenate([[0], np.cumsum(kept)])
    bounds = before[ends]  # where each document's bones end
    bones = codes[kept]
    return [pair for items in groups for pair in _met(items, ids, texts, bones, bounds)]


def _met(items: Items, ids: np.ndarray, texts: list[str], bones: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    hashes = rolling(bones, items.seed)
    if not len(hashes):
        return []
    at = np.flatnonzero(items.mask[hashes >> np.uint64(44)])
    slot = np.searchsorted(items.keys, hashes[at])
    exact = items.keys[np.minimum(slot, len(items.keys) - 1)] == hashes[at]
    at, slot = at[exact], slot[exact]
    doc = np.searchsorted(bounds, at, "right")
    inside = at + items.seed <= bounds[doc]
    spots: dict[tuple[int, int], list[int]] = defaultdict(list)
    owners = items.owners
    for d, p, k in zip(doc[inside].tolist(), at[inside].tolist(), slot[inside].tolist()):
        for n, positions in owners[k]:
            spots[d, n] += [p] * len(positions)
    out = []
    held, own, begin, heads, begun = -1, None, 0, None, None
    for (d, n), met in spots.items():
        least = items.meet[n]
        if len(met) < least:
            continue
        if d != held:
            held, begin, heads = d, int(bounds[d - 1]) if d else 0, None
            own = np.unique(hashes[begin : max(begin, int(bounds[d]) - items.seed + 1)])
        grams = items.grams[n]
        where = np.minimum(np.searchsorted(own, grams), len(own) - 1)
        if int((own[where] == grams).sum()) < items.least[n]:
            continue
        # seeds of one passage stand near each other, by words, however long a changed word is, or by letters, however the words are spaced
        if heads is None:
            heads = _heads(texts[d], _codes(texts[d]))
            begun = np.flatnonzero(heads)  # where the document's words begin
        own_bones, apart = bones[begin : int(bounds[d])], items.apart[n]
        reach = int(apart * max(1.0, items.ends[n][-1] / len(items.ends[n])) * 1.2) + 50
        windows: list[list[int]] = []
        for p in met:
            low, high = _around(begun, p - begin, apart, reach, len(heads))
            if windows and low <= windows[-1][1]:
                windows[-1][1] = max(high, windows[-1][1])
                windows[-1][2] += 1
            else:
                windows.append([low, high, 1])
        if any(holds(items, n, own_bones[a:b], heads[a:b]) for a, b, hits in windows if hits >= least):
            out.append((int(ids[d]), items.ids[n]))
    return out


def _around(begun: np.ndarray, at: int, words: int, letters: int, size: int) -> tuple[int, int]:
    """The stretch of ``words`` words or ``letters`` letters, whichever is longer, on both sides of ``at``."""
    here = int(np.searchsorted(begun, at, "right")) - 1
    low = min(at - letters, int(begun[max(0, here - words)]))
    high = max(at + letters, int(begun[here + words + 1]) if here + words + 1 < len(begun) else size)
    return max(0, low), min(size, high)


def leaks(documents: DataFrame, items: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, item_id)``: the documents that hold a passage of a test item, once each.

    A passage has at least ``SHARE`` of the item's words in their order, of which at most ``CHANGED``
    is changed, left out or added. Words go by white space, and letter by letter in scripts without it. Null
    and blank texts and items hold nothing. The items are counted; up to ``block`` go to the executors at once, more are
    taken in blocks of about that many, each against all documents. Documents are read whole and are
    not shuffled.
    """
    rows = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).filter(F.col("text").isNotNull())
    wanted = items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).filter(F.col("text").isNotNull())
    blocks = 1 if fits(wanted, block) else -(-wanted.count() // (block // 2))
    found = None
    sample = [r[0] for r in rows.select(F.substring("text", 1, SAMPLE_CHARS)).limit(SAMPLE).collect()]
    for n in range(blocks):
        of = wanted if blocks == 1 else wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == n)
        local = [(r[0], r[1]) for r in of.collect()]
        groups = by_seed(local, sample)
        if not groups:
            continue
        part = rows.mapInArrow(_searcher(groups), _OUT)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("doc_id", F.lit(None).cast("bigint").alias("item_id")).limit(0)
    return found
