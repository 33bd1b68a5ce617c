"""Sentence boundaries: rules by script, chunks against whole texts, degenerate texts."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomwright.llm import sentences as S

CASES = [
    ("Dr. Low sells it at Lv. 5. Ask e.g. at No. 4. It is 3.5 units, i.e. about 7 tries!", 3),
    ('He typed "gg." in chat and left. "Bring two of them!" shouted the vendor. “Is it gone?” she asked.', 3),
    ("J. Low and R. T. Mon disagree. Gates open at 7 a.m. Bring keys, shields, etc. A crate waits.", 4),
    ('it is late. “Is it gone?” she asked. "Never go alone. It wastes keys." and then logged off.', 3),
    ("It went well.For now it rests.we left. the rest is luck! or so v3.2.1 of drops.v0.txt says, p. ex. here.", 4),
    ("[06:48] Low: thx!gl with the grind", 2),
    ("Wait... what happened? It left... The rest is luck…", 3),
    ("Der 40. Rang reicht. Seit dem 3. März zahlt Low z. B. 5 Chips. „Geh nie allein hin. Das kostet“, schrieb Low.", 3),
    ("« N'y va jamais seul. C'est un piège ! » a écrit Low. M. Low vend p. ex. celles de la forge.", 2),
    ("См. табл. 5 в отчёте. Кузница просит кожух и т. д. — А где чертёж? — спросил Low. Таймер отстаёт на 16,80 с. Враг ур. 4 тут!", 5),
    ("「本当？」と聞かれた。前は1.5%で、今は2%だ。開けたが……出なかった。", 3),
    ("他说：“别一个人去。那里有埋伏。”然后就下线了。真便宜！！「真的吗？」他问。他喊道：“快跑！”有谁见过吗？他喊道：“快跑！” 真便宜！", 7),
    ("قال د. Low: «لا تذهب وحدك. إنه فخ.» ثم خرج. لماذا اختفى؟!", 2),
    ('डॉ. Low ने कहा, "अकेले मत जाओ। वहाँ जाल है।" और चले गए। वाह! भार 4.7 कि.ग्रा. है।', 3),
    ("ใครจะไป Low บ้าง ลองหาดูที่ด่าน 48 นะคะ เมื่อก่อน 13.9 ตอนนี้เหลือ 20.0 เปอร์เซ็นต์ค่ะ", 3),
    ("# A heading\n\n1. Fixed it (again).\n2. Min. rank 8\n* x6 Low\n\nA wrapped line that is long enough to be full\nends here. Next one.", 6),
    ("[06:48] Low: thx! gl with the grind\nMon: host left... again\n[07:00] Low: WTS it", 4),
]


@pytest.mark.parametrize("text,n", CASES)
def test_rules(text, n):
    spans = S.sentences(text)
    assert len(spans) == n, [text[a:b] for a, b in spans]
    assert all(text[a:b] == text[a:b].strip() and a < b for a, b in spans)
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("text", ["", " ", "\n\n\t", "​ "])
def test_blank_texts_have_none(text):
    assert S.sentences(text) in ([], [(0, 1)]) and not S.sentences(text.strip())


def chunked(text, size, block=3):
    """All chunks as functions, composed by the scan, read in the states they are entered in."""
    import numpy as np

    read = [r for b in S._reader(size)(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text]), pa.array([""])], names=["a", "b", "c"])])) for r in b.to_pylist()]
    chunks = [r | {"known": None} for r in read if r["kind"] == S.CHUNKED]
    if not chunks:
        return S.sentences(text)
    f = next(S._functions(None)(iter([pa.RecordBatch.from_pylist(chunks)]))).to_pylist()
    goes, nexts = S.composed(np.array([x["goes"] for x in f]), np.array([x["nexts"] for x in f]))
    out = []
    for i, x in enumerate(f):
        state = goes[i - 1][0] if i else 0
        start = nexts[i - 1][0] if i and nexts[i - 1][0] >= 0 else f[0]["low"]
        flat = x["found"][x["lists"][state]]
        out += S._spans(list(zip(flat[::2], flat[1::2])), start, x["tail"] if x["last"] else 0)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*" \nab", "Aa", ". ", "! ", '"', "“", "”", "«", "»", "。", "「", "」", "...", "\n\n", "Dr. ", "1. ", "ค่ะ "]), max_size=120), st.integers(7, 60))
def test_chunks_compose_to_the_whole(parts, size):
    text = "".join(parts)
    assert chunked(text, size) == S.sentences(text)


def test_split_over_spark(spark, monkeypatch):
    long = " ".join(f'Part {i} says "one. two" and ends.' for i in range(400))
    data = [(1, "One. Two.", "x"), (2, None, "x"), (3, "", "x"), (4, long, "x"), (1, "One. Two.", "x")]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, start_char string")
    got = sorted((r["doc_id"], r["start_char"], r["end_char"]) for r in S.split(frame, chunk=200).collect())
    monkeypatch.setattr(S, "BLOCK", 4)
    assert sorted((r["doc_id"], r["start_char"], r["end_char"]) for r in S.split(frame, chunk=100).collect()) == got
    want = sorted((d, a, b) for d, t, _ in data for a, b in S.sentences(t or ""))
    assert got == want and len(got) > 400
    assert S.split(frame.limit(0)).count() == 0


def test_abbreviations_are_learned(spark, monkeypatch):
    """Words outside any list: one that always has its full stop and never stands last, beside one that ends sentences."""
    r = random.Random(3)
    others = ["It was gone.", "They left it so.", "Nobody knew.", "A crate waits."]
    texts = []
    for i in range(240):
        r.shuffle(others)
        texts.append(f"We met Vrtx. {r.choice(['Smith', 'Low', 'Mon', 'Kay'])} in the Qlb. {r.choice(['Hall', 'Room', 'Yard'])} when it was gone. {' '.join(others)}\n\nHe asked Vrtx. {r.choice(['Smith', 'Low', 'Mon'])}, as nobody knew. {' '.join(others[:2])}")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts = S._reader(10_000)(iter([pa.RecordBatch.from_arrays([pa.array(range(240)), pa.array(texts), pa.array(["en"] * 240)], names=["a", "b", "c"])]))
    rows = [r for b in counts for r in b.to_pylist() if r["kind"] == S.COUNTED]
    table = spark.createDataFrame([(r["lang"], r["word"], r["after"], r["dotted"], r["ending"], r["plain"]) for r in rows], "lang string, word string, after string, dotted bigint, ending bigint, plain bigint")
    learned = {r["word"] for r in S.abbreviations(table).collect()}
    assert {"vrtx", "qlb"} <= learned and not {"gone", "so", "knew"} & learned
    got = S.split(frame).filter("doc_id = 3").count()
    assert got == 8
    # too many to broadcast: joined instead, with the same result
    monkeypatch.setattr(S, "fits", lambda frame: False)
    assert S.split(frame).filter("doc_id = 3").count() == 8
    assert S.split(frame, chunk=60).filter("doc_id = 3").count() == 8


@pytest.mark.parametrize("text,n", [("Siehe Hdb. Seite 4. Gut.", 2), ("Bob met Gov. Smith on Jan. 5 at St. Mary's. He left.", 2)])
def test_more_abbreviations(text, n):
    assert len(S.sentences(text)) == n
