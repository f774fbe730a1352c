import hashlib
import random
import re

from loamline.llm import decontamination as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items, window=13):
    ws, hit, found = words(text), set(), set()
    for name, item in items:
        iw = words(item)
        n = min(window, len(iw))
        for j in range(len(iw) - n + 1) if n else ():
            for i in range(len(ws) - n + 1):
                if ws[i : i + n] == iw[j : j + n]:
                    hit |= set(range(i, i + n))
                    if name is not None:
                        found.add(str(name))
    return len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(ws)


def test_against_brute_force(spark):
    r = random.Random(3)
    line = lambda n: " ".join(r.choice("Ab c dé e1".split()) for _ in range(n))
    items = [(i, line(r.choice([1, 3, 5, 6, 12, 13, 14, 20, 40]) + 4)) for i in range(30)] + [(99, None), (98, "..."), (None, line(15)), (5, line(13)), (100, "x y"), (101, "x y"), (102, "w x y")]
    texts = [None, "", "x-y", "W x, y"] + [line(r.randrange(1, 60)) for _ in range(60)]
    texts += ["zz " + (items[r.randrange(30)][1]) + " qq! " + line(5) for _ in range(40)] + [items[0][1].upper() * 50]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_hit long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = d.matched(docs.select("doc_id", "text"), bench).collect()
    assert {x[0]: tuple(x[1:]) for x in got} == {i: brute(t, items) for i, t in enumerate(texts)}
    cut = d.decontaminated(docs, bench)
    assert cut.columns == docs.columns
    left = {x["doc_id"] for x in cut.collect()}
    assert left == {i for i, t in enumerate(texts) if not ((b := brute(t, items))[1] and b[1] >= 0.5 * b[0])}


def test_blocks_give_the_same(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/benchmark.parquet")
    one = sorted(map(tuple, d.matched(docs, bench).collect()))
    assert any(x[5] for x in one)
    assert len(list(d.automata(spark, bench, block_words=300))) > 3
    assert sorted(map(tuple, d.matched(docs, bench, block_words=300).collect())) == one


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.matched(docs, none).first()["n_hit"] == 0
    assert d.matched(docs.limit(0), none).count() == 0
