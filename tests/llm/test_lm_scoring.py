import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from loamline.llm import lm_scoring as lm

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows):
    out_of = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 7 == 2
    c, ends = Counter(), 0
    for d, t in rows:
        if not out_of(d):
            c.update(words(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    log = lambda k: math.log10((k + 1) / (n + v + 1))
    return [(d, out_of(d), len(w := words(t)) + 1, sum(c[x] > 0 for x in w) + (ends > 0), n, sum(log(c[x]) for x in w) + log(ends)) for d, t in rows]


def test_base_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", 9)
    monkeypatch.setattr(lm, "MODEL_WORDS", 5)
    r = random.Random(2)
    pool = [f"w{i}" for i in range(40)] + ["É", "é", "A", "a"]
    texts = [None, "", " \n", "one-off", "x " * 5000] + [" ".join(r.choice(pool) for _ in range(r.randrange(30))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[9]), (3, texts[9]), (None, "w1 only")]
    docs = spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, score string")
    got = sorted(map(tuple, lm.score(docs).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 * (1 + abs(w[5])) and g[6] < 0 for g, w in zip(got, want, strict=True))
    assert lm.score(docs.limit(0)).count() == 0


def test_tables_are_normalised():
    p = lm.Parameters(30, 4, np.random.default_rng(1).normal(0, 1, 30 * 8 + 8 + 30))
    one, two, z = p.tables()
    probs = np.exp(one[:, None, :] + two[None, :, :] - z[:, :, None])
    assert np.allclose(probs.sum(2), 1, atol=1e-4)
    direct = (p.r[3] * p.c1 + p.r[5] * p.c2) @ p.q.T + p.b
    assert np.allclose(np.log(probs[3, 5]), direct - np.log(np.exp(direct).sum()), atol=1e-3)


def test_held_out_texts_are_better_predicted_than_by_counts(spark):
    r = random.Random(5)
    after = {i: [(i * 7 + k) % 50 for k in (1, 2)] for i in range(50)}
    rows = []
    for d in range(700):
        w, out = r.randrange(50), []
        for _ in range(200):
            out.append(f"w{w}")
            w = r.choice(after[w])
        rows.append((d, " ".join(out)))
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).where("held_out").groupBy().sum("score", "base_score", "n_tokens").first()
    assert got[0] / got[2] > got[1] / got[2] + 0.3


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 3000)
    r = random.Random(8)
    rows = [(d, " ".join(f"w{int(r.expovariate(0.05))}" for _ in range(r.randrange(120)))) for d in range(300)] + [(None, None), (5, ""), (7, "w1 " * 9000), (7, "w1 " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one, other = (sorted(((g["doc_id"] is None, g["doc_id"] or 0, g["n_tokens"]), g["score"]) for g in lm.score(docs.repartition(n)).collect()) for n in (2, 8))
    assert all(a[0] == b[0] and abs(a[1] - b[1]) <= 1e-6 * abs(a[1]) for a, b in zip(one, other, strict=True))


def test_score_against_direct_recomputation(spark, monkeypatch):
    monkeypatch.setattr(lm, "MODEL_WORDS", 6)
    monkeypatch.setattr(lm, "HEAD_WORDS", 12)
    r = random.Random(9)
    docs = spark.createDataFrame([(d, " ".join(f"w{int(r.expovariate(0.2))}" for _ in range(r.randrange(30)))) for d in range(80)], "doc_id long, text string")
    train = docs.where(~lm.held_out())
    counts = lm.word_counts(train)
    stats = lm.corpus_statistics(counts, train.count())
    p, n = lm.trained(train, stats), {bytes(x["word"]).decode(): x["n"] for x in counts.collect()}
    ids = {w.decode(): i + lm.FIRST for i, w in enumerate(stats.words[:6])}
    # A word outside of the model has its smoothed share of the class of others; one unseen word has one count.
    others = sum(k for w, k in n.items() if w not in ids) + sum(w not in ids for w in n) + 1
    got = {g["doc_id"]: g["score"] for g in lm.score(docs).collect()}
    for d, text in docs.collect():
        seq, want = [lm.END, lm.END, *(ids.get(w, lm.OTHER) for w in text.split()), lm.END], 0.0
        for i, w in enumerate([*text.split(), None], 2):
            x = (p.r[seq[i - 2]] * p.c1 + p.r[seq[i - 1]] * p.c2) @ p.q.T + p.b
            want += (x[seq[i]] - np.log(np.exp(x).sum())) / np.log(10)
            want += math.log10((n.get(w, 0) + 1) / others) if seq[i] == lm.OTHER else 0
        assert abs(got[d] - want) < 1e-4 * (1 + abs(want))
