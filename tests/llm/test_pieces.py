import random
import time

import pytest
from loamline.llm import pieces as p

sentencepiece = pytest.importorskip("sentencepiece")


def texts():
    r = random.Random(1)
    return ["", " ", "  ", "a", "\n", "  hello\tworld\n\n x  é漢😀 ", "aaaaaaaaaaaaaaaaaaaaa", "a" * 3000, "the cat " * 4000] + ["".join(r.choice(" abcdeinthor\n\té漢ñ0123") for _ in range(r.randrange(60))) for _ in range(400)]


def test_ids_equal_the_library_and_come_back():
    library = sentencepiece.SentencePieceProcessor(model_file=p.VOCABULARY)
    with open(p.VOCABULARY, "rb") as f:
        e = p.Encoder(p.Vocabulary.read(f.read()))
    some = [*texts(), "▁x▁▁y"]
    for t, got in zip(some, e.encode(some), strict=True):
        assert list(got) == library.encode(t), t
        assert e.decode(got) == t.replace("▁", " ")
    assert e.encode([None]) == [None] and e.decode(None) is None


def test_long_units_take_time_near_to_linear():
    library = sentencepiece.SentencePieceProcessor(model_file=p.VOCABULARY)
    with open(p.VOCABULARY, "rb") as f:
        e = p.Encoder(p.Vocabulary.read(f.read()))
    r = random.Random(2)
    for n in (200, 300, 3000, 20_000):
        for kinds in ("=", "ab", "etaoinshr", "漢字语a", "0123456789abcdefghijklmnopqrstuvwxyzABC+/"):
            t = "".join(r.choice(kinds) for _ in range(n))
            assert list(e.encode([t])[0]) == library.encode(t), (n, kinds)
    t = "".join(r.choice("etaoinshrdlu") for _ in range(1_000_000))
    began = time.time()
    got = e.encode([t])[0]
    assert time.time() - began < 60 and e.decode(got) == t


def test_forgetting_changes_nothing(monkeypatch):
    with open(p.VOCABULARY, "rb") as f:
        data = f.read()
    one = p.Encoder(p.Vocabulary.read(data)).encode(texts())
    monkeypatch.setattr(p, "REMEMBERED", 20)
    monkeypatch.setattr(p, "INDEX_CHARS", 50)
    assert list(p.Encoder(p.Vocabulary.read(data)).encode(["ab"])[0]) == list(p.Encoder(p.Vocabulary.read(data)).encode(["ab", "the longer text of them"])[0])
    two = p.Encoder(p.Vocabulary.read(data))
    assert all((a == b).all() for t, a in zip(texts(), one, strict=True) for b in two.encode([t]))


def test_query(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([None, *texts()])], "doc_id long, text string, ids string")
    out = p.pieces_of(docs.select("doc_id", "text"), ids=True)
    rows = p.decoded(out).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == dict(enumerate([None, *texts()]))
    assert all(r["round_trip"] or r["n_pieces"] is None for r in rows)
    assert p.pieces_of(docs.limit(0)).count() == 0
