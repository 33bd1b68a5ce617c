"""Leaking test items: changed passages against short and reordered ones, and tiling against brute force."""

import random

import numpy as np

from loomwright.llm import leakage as L

WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in ("a", "ei", "ou", "y") for c in ("lt", "nd", "rk", "x")]


def item(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def test_passages(spark):
    texts = {i: item(i) for i in range(20)}
    r = random.Random(5)
    filler = lambda n: item(r.randrange(10**6), n)
    w = texts[3].split()
    changed = w[:30]
    changed[8], changed[20] = "other", "thing"
    docs = {
        1: f"{filler(50)} {texts[0]} {filler(20)}",
        2: filler(30) + " " + " ".join(changed) + " " + filler(30),
        3: filler(30) + ". " + ", ".join(x.upper() for x in texts[5].split()[10:45]).replace("A", "А") + filler(9),
        4: filler(20) + " " + " ".join(texts[7].split()[:9]) + " " + filler(40),
        5: " ".join(" ".join(texts[8].split()[i : i + 6]) for i in range(54, -6, -6)),
        6: filler(80), 7: "", 8: None,
        9: "​".join(texts[9]) + "!",
        10: filler(2000) + " " + " ".join(texts[11].split()[20:50]),
    }
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").withColumnRenamed("doc_id", "doc_id")
    items = spark.createDataFrame([*texts.items(), (90, None), (91, " ")], "item_id bigint, text string")
    want = [(1, 0), (2, 3), (3, 5), (9, 9), (10, 11)]
    assert sorted(map(tuple, L.leaks(frame, items).collect())) == want
    assert sorted(map(tuple, L.leaks(frame, items, block=6).collect())) == want
    assert L.leaks(frame, items.limit(0)).count() == 0 and L.leaks(frame.limit(0), items).count() == 0


def test_long_texts_are_parted(spark, monkeypatch):
    monkeypatch.setattr(L, "PART", 6000)
    items = L.Items([(1, item(1)), (2, item(2))])
    filler = item(77, 4000)
    text = filler[:9000] + " " + item(1) + " " + filler[9000:] + " " + item(2)
    ids, parts = L._parted(np.array([5]), [text], L.STRETCH * max(map(len, items.text)))
    assert len(parts) > 2 and set(L._hits([items], ids, parts)) == {(5, 1), (5, 2)}


def test_changed_words_of_any_length():
    """A tenth of the words swapped, for words of 1 to 80 letters: every passage is found, whatever the item's length."""
    r = random.Random(8)
    for words in (12, 22, 27, 43, 60, 120):
        rows = [(i, item(1000 * words + i, words)) for i in range(15)]
        groups = L.by_seed(rows)
        for letters in (1, 6, 12, 80):
            texts = []
            for _, text in rows:
                w = text.split()
                for at in r.sample(range(words), words // 10):
                    w[at] = "".join(r.choice("qzj") for _ in range(letters))
                texts.append(f"{item(r.randrange(10**6), 30)} {' '.join(w)} {item(r.randrange(10**6), 30)}")
            assert len(L._hits(groups, np.arange(15), texts)) == 15, (words, letters)


def test_too_many_changed_words_are_no_passage():
    r = random.Random(9)
    rows = [(i, item(500 + i, 60)) for i in range(15)]
    texts = []
    for _, text in rows:
        w = text.split()
        for at in range(0, 60, 4):
            w[at] = "".join(r.choice("qzj") for _ in range(5))
        texts.append(" ".join(w))
    assert not L._hits(L.by_seed(rows), np.arange(15), texts)


def test_scripts_without_spaces():
    """Letters count as words: two fifths of a Chinese item, one letter in ten changed, beside items with spaces."""
    r = random.Random(10)
    letters = [chr(c) for c in range(0x4E00, 0x5200)]
    text = "".join(r.choice(letters) for _ in range(60))
    groups = L.by_seed([(1, text), (2, item(2))])
    part = list(text[20:50])
    part[9] = part[19] = "的"
    noise = "".join(r.choice(letters) for _ in range(300))
    docs = [noise + "".join(part) + noise, noise + text[:12] + noise, noise + "".join(sorted(text)) + noise, "x " + item(2)]
    assert len(groups) == 2 and sorted(L._hits(groups, np.arange(4), docs)) == [(0, 1), (3, 2)]


def brute(item, text, least):
    item, text, out = list(item), list(text), []
    used_i, used_t = [False] * len(item), [False] * len(text)
    while True:
        best = None
        for j in range(len(text)):
            for i in range(len(item)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not used_i[i + k] and not used_t[j + k]:
                    k += 1
                if k >= least and (best is None or (-k, j, i) < best):
                    best = (-k, j, i)
        if not best:
            return sorted(out)
        k, j, i = -best[0], best[1], best[2]
        out.append((j, i, k))
        for n in range(k):
            used_i[i + n] = used_t[j + n] = True


def test_tiling_against_brute_force():
    r = random.Random(1)
    for _ in range(60):
        a = "".join(r.choice("abc") for _ in range(r.randrange(5, 40)))
        b = a[r.randrange(4) : r.randrange(10, 40)] + "".join(r.choice("abc") for _ in range(12)) + a[:9]
        codes = lambda s: np.frombuffer(s.encode("utf-32-le"), np.uint32)
        assert sum(k for *_, k in L.tiles(codes(a), codes(b), 4)) == sum(k for *_, k in brute(a, b, 4))


def test_rolling_hash_is_by_content():
    x = np.array([1, 2, 3, 9, 1, 2, 3, 7, 1, 2, 3], np.uint32)
    h = L.rolling(x, 3)
    assert h[0] == h[4] == h[8] and len(set(h.tolist())) == 7 and len(L.rolling(x[:2], 3)) == 0
