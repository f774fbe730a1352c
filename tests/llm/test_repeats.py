import hashlib
import random

import numpy as np
from loamline.llm import repeats as r


def brute(rows, least=50):
    first = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    order = lambda d: r.LAST if d is None else d
    for d, b in data:
        for i in range(len(b) - least + 1):
            w = b[i : i + least]
            first[w] = min(order(d), first.get(w, r.LAST))
    out = []
    for d, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - least + 1):
            if first[b[i : i + least]] < order(d):
                gone[i : i + least] = [True] * least
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    g = random.Random(6)
    line = lambda n: "".join(g.choice("abcde é\n") for _ in range(n))
    shared = [line(g.choice([30, 49, 50, 51, 70, 200])) for _ in range(12)]
    rows = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 49), (5, "x" * 400), (6, "x" * 300), (7, "ab" * 100), (8, "ab" * 90 + "c"), (None, shared[0] * 3), (9, "x" * 400)]
    for i in range(60):
        rows.append((g.choice([i + 20, i + 20, 25]), "".join(line(g.randrange(60)) + g.choice(shared) for _ in range(g.randrange(5)))))
    rows += [(g.randrange(200, 400), rows[g.randrange(20, 60)][1]) for _ in range(15)]
    return [*rows, rows[30], rows[30]]


def test_against_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, key string")
    assert sorted(map(tuple, r.without_repeats(docs).collect()), key=str) == brute(rows)
    monkeypatch.setattr(r, "PIECE", 300)
    monkeypatch.setattr(r, "CHUNK", 100)
    assert sorted(map(tuple, r.without_repeats(docs.repartition(5)).collect()), key=str) == brute(rows)


def test_frequent_anchors_are_split_and_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(r, "HOT", 1)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, r.without_repeats(docs).collect()), key=str) == brute(rows)


def test_shared_prefixes_against_sorting():
    g = np.random.default_rng(2)
    for n in (1, 2, 30, 300):
        for kinds in (1, 2, 3):
            buf = np.concatenate([g.integers(97, 97 + kinds, n, dtype=np.uint8), [r.END]]).astype(np.uint8)
            for least in (9, 20, 50):
                order, same = r.suffix_array(buf, least)
                assert sorted(order.tolist()) == list(range(len(buf)))
                first = [bytes(buf[i : i + least]).ljust(least, b"\xff") for i in order]
                assert first == sorted(first)
                want = [False] + [a == b for a, b in zip(first, first[1:], strict=False)]
                ends = [bytes(buf[i:]) for i in order]  # strings that go over the end are not looked for
                got = r.shared_prefixes(order, same, least)
                assert all(x == y for x, y, e, f in zip(want[1:], got[1:], ends, ends[1:], strict=False) if len(e) > least and len(f) > least) and not got[0]


def test_repeated_against_brute_force():
    g = random.Random(3)
    for _ in range(20):
        parts = ["".join(g.choice("ab") for _ in range(g.randrange(80))).encode() for _ in range(30)]
        doc = np.array([g.randrange(12) for _ in parts])
        want = []
        for p, b in enumerate(parts):
            gone = [False] * len(b)
            for i in range(len(b) - 9):
                if any(doc[q] < doc[p] and b[i : i + 10] in c for q, c in enumerate(parts)):
                    gone[i : i + 10] = [True] * 10
            for i, x in enumerate(gone):
                if x and (i == 0 or not gone[i - 1]):
                    z = i
                    while z < len(b) and gone[z]:
                        z += 1
                    want.append((p, i, z))
        assert list(zip(*(x.tolist() for x in r.repeated(parts, doc, 10)), strict=True)) == want


def test_empty(spark):
    assert r.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
