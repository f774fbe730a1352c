import random
import re

import numpy as np
from loamline.llm import near_dedup as nd
from loamline.llm.common import sifted, stored

WORD = re.compile("[^\x20\x09-\x0d]+")


def sets(t):
    w = WORD.findall(t or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    s = [sets(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] is not None and (rows[i][1] == rows[j][1] or (s[i] and s[j] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]))):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(4))
    rows = [(1, None), (2, None), (3, ""), (4, ""), (5, " \n"), (6, "one two"), (7, "one two"), (8, "one  two"), (9, "two one")]
    for g in range(25):
        base = [word() for _ in range(r.randrange(20, 300))]
        for k in range(r.choice([1, 2, 3, 6, 30])):
            w = list(base)
            for _ in range(r.choice([0, 1, 2, len(w) // 50, len(w) // 12]) if k else 0):
                w[r.randrange(len(w))] = word()
            rows.append((100 * g + k + 10, " ".join(w) + " line" * (40 if g % 9 == 0 else 0)))
    return [*rows, rows[-1], rows[-1]]


def test_classes_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, node string")
    got = nd.classes(docs.select("doc_id", "text")).collect()
    assert sorted((g["doc_id"], g["class_id"]) for g in got) == brute(rows)
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted(c for d, c in set(brute(rows)))
    assert sorted(k["doc_id"] for k in kept.collect()) == sorted(set(want))


def test_registers_agree_with_probability_jaccard():
    n, both = 400, 200
    a = {f"s{i}": 1 + i % 3 for i in range(n)}
    b = {f"s{i}": 1 + (i * 7) % 4 for i in range(n - both, 2 * n - both)}
    names = sorted(a.keys() | b.keys())
    h = {x: i * 2654435761 + 12345 for i, x in enumerate(names)}
    expect = sum(1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in names) for x in a.keys() & b.keys())
    sig = [nd.signatures(np.zeros(len(s), np.int64), np.array([h[x] for x in s], np.uint64), np.array(list(map(float, s.values()))), 1, 4000)[0] for s in (a, b)]
    assert abs((sig[0] == sig[1]).mean() - expect) < 0.03


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nd.classes(docs).count() == 0 and nd.one_of_each(docs).count() == 0


def in_one_bucket(spark, texts):
    """Classes by the operator against brute force; no other band can make up for a pair that is not compared."""
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    size = {i: len(sets(t)) for i, t in rows}
    of = spark.createDataFrame(list(size.items()), "doc_id long, size int")
    keys = docs.join(of, "doc_id").selectExpr("unhex(sha1(cast(text as binary))) AS node", "doc_id AS first_id", "1L AS n", "array(1L) AS bands", "size")
    keys, _ = stored(keys, "keys")
    labels = keys.select("node", "first_id").join(nd.components(nd.links(docs, keys)), "node", "left").selectExpr("first_id", "hex(coalesce(label, node)) AS label").collect()
    groups = {}
    for x in labels:
        groups.setdefault(x["label"], []).append(x["first_id"])
    assert sorted((d, min(g)) for g in groups.values() for d in g) == brute(rows)
    return len(groups)


def test_chains_and_unlike_centres_in_one_bucket(spark):
    r = random.Random(4)
    texts = []
    for chain, n in enumerate((40, 25, 12)):
        words = [f"c{chain}w{i}" for i in range(400)]
        texts += [" ".join(words[i * 8 : i * 8 + 104]) for i in range(n)]  # neighbours are at 92 / 108, others below 0.8
    r.shuffle(texts)
    assert in_one_bucket(spark, texts) == 3


def test_a_passage_in_unlike_texts_a_group_of_copies_and_nested_texts_in_one_bucket(spark):
    r = random.Random(5)
    word = lambda: f"w{r.randrange(10**9)}"
    passage, line = [word() for _ in range(25)], [word() for _ in range(9)]
    texts = [" ".join([word() for _ in range(r.randrange(30, 90))] + (line if r.random() < 0.3 else []) + passage + [word() for _ in range(20)]) for _ in range(400)]
    base = [word() for _ in range(90)] + passage
    for _ in range(200):
        w = list(base)
        for _ in range(r.randrange(7)):
            w[r.randrange(90)] = word() if r.random() < 0.7 else "again"
        texts.append(" ".join(w))
    whole = [word() for _ in range(400)] + passage
    texts += [" ".join(whole[k:]) for k in range(0, 390, 7)]  # each contains the next
    texts += [" ".join(whole[: 60 + 10 * k] + passage) for k in range(20)]
    texts = list(dict.fromkeys(texts))
    r.shuffle(texts)
    in_one_bucket(spark, texts)


def test_many_subsets_of_one_text_are_compared_in_the_end(spark, monkeypatch):
    monkeypatch.setattr(nd, "LEVELS", 2)
    r = random.Random(6)
    base = [f"w{i}" for i in range(160)]
    texts = [" ".join(base)] + [" ".join(base[: 100 + r.randrange(8)] + [f"x{k % 40}"] * (k % 3)) for k in range(60)] + [" ".join(base[40 + k % 9 :]) for k in range(40)]
    in_one_bucket(spark, list(dict.fromkeys(texts)))


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b c d e f", "x", 1, 2), (2, "a b c d e f", "y", 3, 4), (None, None, None, None, None), (3, None, "z", 5, 6), (1, "a b c d e f", "x", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, _node int, _id int")
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)


def test_texts_that_repeat_passages_share_bands_with_copies_that_do_not():
    r = random.Random(6)
    for times, changed in ((1000, 0), (20, 3)):
        missed = 0
        for _ in range(60):
            w = [f"w{r.randrange(10**9)}" for _ in range(300)]
            passage, rest = w[:60], w[60:]
            other = list(rest)
            for k in range(changed):
                other[20 + 60 * k] = "changed"
            a, b = " ".join(passage * times + rest), " ".join(passage * 2 + other)
            assert len(sets(a) & sets(b)) >= 0.8 * len(sets(a) | sets(b))
            one, two = ({(i % nd.BANDS, v) for i, v in enumerate(bands) if v is not None} for bands in nd.bands_of([a, b])[0])
            missed += not one & two
        assert missed == 0


def test_sifting_keeps_all_that_may_join(spark):
    keys = spark.range(0, 3000, 7).selectExpr("unhex(sha1(cast(id as string))) AS k")
    rows = spark.range(3000).selectExpr("id", "unhex(sha1(cast(id as string))) AS k")
    got = {r["id"] for r in sifted(rows, keys, "k").collect()}
    assert set(range(0, 3000, 7)) <= got and len(got) < 700
    assert sifted(rows, keys, "k", 64).count() >= 429
    assert sifted(rows, keys.limit(0), "k").count() == 0
