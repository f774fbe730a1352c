"""A log-bilinear language model, trained by noise-contrastive estimation.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, and one
end after each text. Word counts cover all training documents and are kept in a
table; the ``HEAD_WORDS`` most frequent are broadcast, the others are joined by
shuffle.

The model predicts the ``MODEL_WORDS`` most frequent words, the end and a class of
all other words from the two tokens before. A score is the word's bias plus the
product of its vector and the sum of both context vectors, each scaled by its
place. Training texts are dealt by a hash of id and text to shards, whose number
follows from the corpus' tokens, and are ordered by that hash inside. Every shard
trains on all its tokens from the same start, in batches with common noise words,
and the shards' parameters are averaged by their tokens: the parameters depend on
the rows only, not on how they are partitioned. As the exponential of a score is a product over the two places,
one matrix product of the exponentials gives the normaliser of every pair of
context tokens, so the log-probabilities are normalised exactly. A word of the
class of others gets, besides, its smoothed share of that class.

Null texts are empty and have the end only. A null id counts as an empty text
in the choice of held-out rows. Repeated rows are scored each and counted each.
Without training documents N and V are 0. Columns besides id and text are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, pieces, stored, table

HEAD_WORDS, MODEL_WORDS, DIM, NOISE, BATCH = 131_072, 2046, 16, 64, 8192
END, OTHER, FIRST = 0, 1, 2
COUNT_FLUSH, PIECE = 200_000, 3_000_000
# More shards than MOST_SHARDS would only give more parameters to average; beyond that they grow.
SHARD_TOKENS, MOST_SHARDS = 2_000_000, 4096


def tokens_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n of all words of the texts, counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for b in pieces(batches, PIECE):
            for text in b.column(0).to_pylist():
                counts.update(tokens_of(text))
            if len(counts) > COUNT_FLUSH:
                yield out()
                counts.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Parameters:
    """Context vectors, word vectors, scales of the two places, biases."""

    def __init__(self, size: int, dim: int = DIM, flat: np.ndarray | None = None):
        self.size, self.dim = size, dim
        ends = np.cumsum([size * dim, size * dim, dim, dim, size])
        if flat is None:
            r = np.random.default_rng(7)
            flat = np.concatenate([r.normal(0, 0.3, ends[1]), np.ones(2 * dim), np.zeros(size)])
        self.flat = flat.astype(np.float32)
        a, b, c, d, e = np.split(self.flat, ends[:-1])
        self.r, self.q, self.c1, self.c2, self.b = a.reshape(size, dim), b.reshape(size, dim), c, d, e

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of (first token, word) and (second token, word), the latter less the bias; log of the normaliser of both contexts."""
        one, two = (self.r * self.c1) @ self.q.T, (self.r * self.c2) @ self.q.T
        one = one + self.b
        m1, m2 = one.max(1, keepdims=True), two.max(1, keepdims=True)
        z = np.exp((one - m1).astype(np.float64)) @ np.exp((two - m2).astype(np.float64)).T
        return one, two, (np.log(z) + m1 + m2.T).astype(np.float32)


def nce_steps(p: Parameters, squares: np.ndarray, ids: np.ndarray, noise_log: np.ndarray, r: np.random.Generator, cumulative: np.ndarray, rate: float) -> float:
    """One pass over triples (first, second, word): a step of AdaGrad for each batch. Returns the summed objective."""
    total, ar = 0.0, np.arange(p.dim)
    old = np.seterr(over="ignore")
    for k in range(0, len(ids), BATCH):
        w1, w2, w = ids[k : k + BATCH].T
        noise = np.minimum(np.searchsorted(cumulative, r.random(NOISE)), p.size - 1)
        r1, r2, qw, qn = p.r[w1], p.r[w2], p.q[w], p.q[noise]
        q = r1 * p.c1 + r2 * p.c2
        good = np.einsum("ij,ij->i", q, qw) + p.b[w] - noise_log[w]
        bad = q @ qn.T + (p.b[noise] - noise_log[noise])
        dg, db = 1 / (1 + np.exp(good)), -1 / (1 + np.exp(-bad))
        total += float(-np.log1p(np.exp(-good)).sum() - np.log1p(np.exp(bad)).sum())
        dq = dg[:, None] * qw + db @ qn
        at = np.concatenate([w1, w2])
        g_r = np.bincount((at[:, None] * p.dim + ar).ravel(), np.concatenate([dq * p.c1, dq * p.c2]).ravel(), p.size * p.dim)
        g_q = np.bincount((w[:, None] * p.dim + ar).ravel(), (dg[:, None] * q).ravel(), p.size * p.dim)
        g_q += np.bincount((noise[:, None] * p.dim + ar).ravel(), (db.T @ q).ravel(), p.size * p.dim)
        g_b = np.bincount(w, dg, p.size) + np.bincount(noise, db.sum(0), p.size)
        g = np.concatenate([g_r, g_q, (dq * r1).sum(0), (dq * r2).sum(0), g_b]) / len(w)
        squares += g * g
        p.flat += (rate * g / np.sqrt(squares + 1e-12)).astype(np.float32)
    np.seterr(**old)
    return total


class Statistics:
    """What of the corpus every task needs: counts of head words, and totals."""

    def __init__(self, head: list[tuple[bytes, int]], words: int, total: int, documents: int):
        self.words = [w for w, _ in head]
        self.counts = np.array([documents, 0, *(n for _, n in head)], np.int64)
        self.n, self.v, self.documents = total + documents, words + (documents > 0), documents
        inside = head[:MODEL_WORDS]
        self.other_n, self.other_v = total - sum(n for _, n in inside), words - len(inside)
        self.size = FIRST + len(inside)

    def ids(self) -> dict[bytes, int]:
        return {w: i + FIRST for i, w in enumerate(self.words)}

    def unigram(self) -> np.ndarray:
        n = self.counts[: self.size].astype(float) + 1
        n[OTHER] += self.other_n
        return n / n.sum()


def trained(docs: DataFrame, stats: Statistics, rate: float = 0.12) -> Parameters:
    """Parameters from all texts of docs."""
    start = Parameters(stats.size)
    start.b[:] = np.log(stats.unigram())
    words, unigram = stats.words[:MODEL_WORDS], stats.unigram()
    sent = docs.sparkSession.sparkContext.broadcast((start.flat, unigram, words))
    count = max(1, min(MOST_SHARDS, -(-stats.n // SHARD_TOKENS)))

    def make():
        ids = {w: i + FIRST for i, w in enumerate(sent.value[2])}
        return lambda texts: [[np.array([*(ids.get(w, OTHER) for w in tokens_of(t)), END], np.int16).tobytes() for t in texts]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, unigram, _ = sent.value
        noise_log, cumulative = np.log(NOISE * unigram), np.cumsum(unigram)
        now, shard, held, size = None, None, [], 0

        def begun(shard: int) -> tuple:
            return Parameters(len(unigram), flat=flat.copy()), np.full(len(flat), 1e-8), np.random.default_rng([3, shard])

        def steps(last: bool) -> None:
            # Batches are cut from the shard's tokens alone, wherever Arrow's batches end.
            nonlocal held, size
            p, squares, r = now
            x = np.concatenate(held)
            cut = len(x) if last else len(x) // BATCH * BATCH
            nce_steps(p, squares, x[:cut], noise_log, r, cumulative, rate)
            held, size = [x[cut:]], len(x) - cut

        def whole() -> pa.RecordBatch:
            steps(True)
            p, n = now[0], float(tokens)
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(p.flat.astype(float) * n), pa.array(np.full(len(flat), n))], names=["i", "v", "n"])

        tokens = 0
        for b in batches:
            for s, ids in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if s != shard:
                    if now:
                        yield whole()
                    now, shard, held, size, tokens = begun(s), s, [], 0, 0
                x = triples(np.frombuffer(ids.as_buffer(), np.int16))
                held.append(x)
                size, tokens = size + len(x), tokens + len(x)
                if size > 32 * BATCH:
                    steps(False)
        if now:
            yield whole()

    key = F.xxhash64("doc_id", "text")
    coded = map_texts(docs.select(F.pmod(key, F.lit(count)).cast("int").alias("shard"), key.alias("at"), "text"), make, {"ids": "binary"}, PIECE)
    dealt = coded.repartitionById(count, "shard").sortWithinPartitions("shard", "at", "ids").select("shard", "ids")
    rows = dealt.mapInArrow(run, "i int, v double, n double").groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).collect()
    for i, v in rows:
        start.flat[i] = v
    return start


def triples(ids: np.ndarray) -> np.ndarray:
    """(first, second, word) at every token of a text, its end included; contexts begin with two ends."""
    x = np.concatenate([np.full(2, END, np.int16), ids])
    return np.stack([x[:-2], x[1:-1], x[2:]], 1).astype(np.int64)


def corpus_statistics(counts: DataFrame, documents: int) -> Statistics:
    """The head is every word of at least some count: the least one, in steps of 2 in 100, that no more than HEAD_WORDS words reach.

    It is found from the words in each step, so that the driver gets the head and no more.
    """
    step = F.floor(F.log("n") * 50).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    taken, least = 0, None
    for r in steps:
        taken += r["words"]
        if taken > HEAD_WORDS:
            break
        least = r["step"]
    head = [] if least is None else counts.where(step >= least).collect()
    return Statistics(sorted(((bytes(r["word"]), r["n"]) for r in head), key=lambda x: (-x[1], x[0])), sum(r["words"] for r in steps), sum(r["n"] for r in steps), documents)


SCORED = {"n_tokens": "long", "n_known": "long", "base": "double", "model": "double", "tail": "array<string>", "tail_n": "array<long>"}


def scored(docs: DataFrame, stats: Statistics, p: Parameters) -> DataFrame:
    """docs with sums over what head words give, and the words that aren't among them."""
    sent = docs.sparkSession.sparkContext.broadcast((stats.words, stats.counts, p.tables(), stats.size, stats.documents))

    def make():
        words, counts, (one, two, z), size, documents = sent.value
        ids = {w: i + FIRST for i, w in enumerate(words)}
        logs = np.log10(counts + 1.0)

        def of(texts: list) -> list:
            flat: list[int] = []
            starts, tails = [], []
            for text in texts:
                starts.append(len(flat))
                found = tokens_of(text)
                got = [ids.get(w, OTHER) for w in found]
                tails.append(Counter(w for w, i in zip(found, got, strict=True) if i == OTHER) if OTHER in got else {})
                flat += (END, END)
                flat += got
                flat.append(END)
            x, s = np.array(flat, np.int64), np.array(starts, np.int64)
            live = np.ones(len(x), bool)
            live[s] = live[s + 1] = False
            y = np.where(x < size, x, OTHER)
            model, base, known = np.zeros(len(x)), np.where(live, logs[x], 0.0), live & (x != OTHER) & ((x != END) | (documents > 0))
            i = np.nonzero(live)[0]
            model[i] = (one[y[i - 2], y[i]] + two[y[i - 1], y[i]] - z[y[i - 2], y[i - 1]]) / np.log(10)
            model += np.where(live & (x >= size), logs[x], 0.0)
            others = np.add.reduceat((live & (y == OTHER)).astype(np.int64), s)
            return [
                np.add.reduceat(live.astype(np.int64), s), np.add.reduceat(known.astype(np.int64), s), np.add.reduceat(base, s), np.add.reduceat(model, s) - others * other_log,
                [[w.decode("utf-8", "replace") for w in t] for t in tails], [list(t.values()) for t in tails],
            ]

        return of

    other_log = float(np.log10(stats.other_n + stats.other_v + 1))
    return map_texts(docs, make, SCORED, PIECE)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    docs = docs.select("doc_id", "text")
    train = docs.where(~held_out())
    counts, _ = stored(word_counts(train), "word-counts")
    stats = corpus_statistics(counts, train.count())
    heads, _ = stored(scored(docs, stats, trained(train, stats)).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = heads.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")).select("row", F.col("t.tail").cast("binary").alias("word"), F.col("t.tail_n").alias("k"))
    met = tail.join(counts, "word").groupBy("row").agg(F.sum("k").alias("_known"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("_log"))
    # The statistics' logarithm of N + V + 1 is taken from each token.
    per_token = float(np.log10(stats.n + stats.v + 1))
    out = heads.drop("tail", "tail_n").join(met, "row", "left")
    more = F.coalesce("_log", F.lit(0.0))
    return out.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(stats.n).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * per_token).alias("base_score"), (F.col("model") + more).alias("score"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
