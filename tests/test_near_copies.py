import hashlib
import random

import pytest
from loamline.functions import text as t
from loamline.operators import dedup
from pyspark.sql import functions as F


def simhash(text):
    text = " ".join(text.lower().split()).ljust(5)
    votes = [0] * 64
    for i in range(len(text) - 4):
        v = int.from_bytes(hashlib.sha256(text[i : i + 5].encode()).digest()[:8], "big")
        votes = [s + (1 if v >> b & 1 else -1) for b, s in enumerate(votes)]
    out = sum(1 << b for b, s in enumerate(votes) if s >= 0)
    return out - (1 << 64) if out >= 1 << 63 else out


def test_simhash_of_odd_texts_and_of_pieces(spark):
    r = random.Random(5)
    texts = ["", "a", " \t\x1cx", "abcde", "a" * 255 + "b" * 4, "a" * 259, "a" * 260, "a" * 300, "\U0001f600" * 9, "İstanbul ẞ " * 9]
    # More characters than three to a word, and lengths round the runs that are summed at once.
    texts += ["".join(chr(r.randrange(0x20, 0xD800)) for _ in range(9000))] + ["".join(r.choice("ab c") for _ in range(r.randrange(600))) for _ in range(60)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*texts, None])], "i long, x string").coalesce(1)
    assert [r[0] for r in df.select("i", t.simhash("x").alias("p")).orderBy("i").select("p").collect()] == [*map(simhash, texts), None]
    # A text of more than one piece, of few distinct shingles so that they can be counted here.
    unit, n = "the quick brown fox ", t.PIECE // 20 + 1000
    whole = (unit * n).strip()
    shingles = {i: (unit * 2)[i : i + 5] for i in range(20)}
    votes = [0] * 64
    for i, s in shingles.items():
        v, k = int.from_bytes(hashlib.sha256(s.encode()).digest()[:8], "big"), len(range(i, len(whole) - 4, 20))
        votes = [x + (k if v >> b & 1 else -k) for b, x in enumerate(votes)]
    want = sum(1 << b for b, x in enumerate(votes) if x >= 0)
    assert spark.range(1).select(t.simhash(F.expr(f"repeat('{unit}', {n})"))).first()[0] & (1 << 64) - 1 == want


def greedy(rows, threshold):
    ok, out = [], {}
    for path, p in sorted(rows):
        best = None
        for other, q in ok if p is not None else []:
            if q is not None and other[-3:] == path[-3:] and any((p ^ q) >> 16 * b & 0xFFFF == 0 for b in range(4)):
                s = 1 - ((p ^ q) & (1 << 64) - 1).bit_count() / 64
                if s >= threshold and (best is None or s > best[2]):
                    best = ("near", other, s)
        if best is None:
            ok.append((path, p))
        out[path] = best or ("canonical", path, 1.0)
    return out


@pytest.mark.parametrize("threshold", [0.92, 0.8, 1.0, 1.5])
def test_groups_of_near_copies_are_not_paired_in_full(spark, monkeypatch, threshold):
    r = random.Random(7)
    flipped = lambda p, n: p ^ sum(1 << b for b in r.sample(range(64), r.randrange(n + 1)))
    base = r.getrandbits(64)
    prints = [flipped(base, 4) for _ in range(1500)]
    # One band, all else unlike; chains; equal prints; no text.
    prints += [r.getrandbits(48) << 16 | 0x1234 for _ in range(1200)]
    chain = [r.getrandbits(64)]
    while len(chain) < 60:
        chain.append(chain[-1] ^ 1 << r.randrange(64) ^ 1 << r.randrange(64))
    prints += chain + [base ^ 7] * 150 + [r.getrandbits(64) for _ in range(100)]
    names = [f"f{i:05d}" for i in range(len(prints) + 5)]
    r.shuffle(names)
    rows = [(f"{n}.{'php' if i % 9 == 0 else 'txt'}", p - (1 << 64) if p is not None and p >> 63 else p) for i, (n, p) in enumerate(zip(names, [*prints, *[None] * 5], strict=True))]
    written, cut = [], dedup.cut

    def counted(df):
        out = cut(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(dedup, "cut", counted)
    monkeypatch.setattr(dedup.t, "simhash", lambda x: F.col(x).cast("long"))
    files = spark.createDataFrame(rows, "path string, print long").select("path", F.col("print").cast("string").alias("content"))
    got = {x["path"]: (x["dup_type"], x["canonical_source"], x["similarity_score"]) for x in dedup.near(files, threshold).collect()}
    assert got == greedy(rows, threshold)
    # All pairs of the group are over a million.
    assert max(written) < 40 * len(rows)
