"""Exact and SimHash deduplication of files, by path order within a family."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..plans.shared import cut

BANDS, BITS = 4, 16
NODE, KEY = ["family", "print"], ["family", "band", "value", "block", "part"]
#: Buckets of up to FEW rows are compared in all pairs; a band's bucket of more than SPLIT is dealt out anew.
FEW, SPLIT = 8, 1024
#: Links that a node of a larger bucket gets at first.
LINKS = 4
#: Columns and rows compared at once.
STEP, MOST_ROWS = 64, 1 << 14


def exact(files: DataFrame) -> DataFrame:
    """files (path, content) with hash, canonical_path and canonical_family: the first path of each content, by partial aggregation and a join."""
    hashed = files.withColumns({"hash": F.sha2("content", 256), "family": t.content_family("path")})
    first = hashed.groupBy("hash").agg(F.min(F.struct("path", "family")).alias("_first"))
    return hashed.join(first, "hash").select(*hashed.columns, F.col("_first.path").alias("canonical_path"), F.col("_first.family").alias("canonical_family"))


def _keyed(nodes: DataFrame, most: int) -> DataFrame:
    """nodes (family, print, path), a row for each bucket they are in. Prints that share a band and differ in ``most`` bits at most share a bucket.

    A band's bucket of more than SPLIT nodes is dealt out anew: of ``most + 1`` blocks of
    the other bits one is equal in such a pair.
    """
    bands = F.array(*(F.shiftrightunsigned("print", BITS * b).bitwiseOR(F.shiftleft("print", 64 - BITS * b)) if b else F.col("print") for b in range(BANDS)))
    turned = nodes.select(*NODE, "path", F.posexplode(bands).alias("band", "_bits")).withColumn("value", F.col("_bits").bitwiseAND((1 << BITS) - 1))
    whole = {"block": F.lit(-1), "part": F.lit(0).cast("long")}
    others, blocks = 64 - BITS, most + 1
    if 1 << (others // blocks) < 4 * blocks:  # blocks of so few bits would add more rows than they tell apart
        return turned.withColumns(whole).drop("_bits")
    band = ["family", "band", "value"]
    turned = turned.join(turned.groupBy(band).agg((F.count("*") > SPLIT).alias("_large")), band)
    starts = [BITS + others * i // blocks for i in range(blocks + 1)]
    parts = F.array(*(F.shiftrightunsigned("_bits", i).bitwiseAND((1 << j - i) - 1) for i, j in zip(starts, starts[1:], strict=False)))
    small = turned.where(~F.col("_large")).withColumns(whole)
    large = turned.where("_large").select("*", F.posexplode(parts).alias("block", "part"))
    return small.unionByName(large).select(*NODE, "path", *KEY[1:])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in the order of their buckets as tables of whole buckets, and where those start."""
    held: list[pa.RecordBatch] = []

    def starts(rows: pa.Table) -> np.ndarray:
        new = np.zeros(len(rows), bool)
        new[:1] = True
        for k in KEY:
            new[1:] |= pc.not_equal(rows[k][1:], rows[k][:-1]).to_numpy()
        return np.flatnonzero(new)

    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([*held, batch]).combine_chunks()
        at = starts(rows)
        if len(at) > 1:
            yield rows[: at[-1]], at[:-1]
        held = rows[at[-1] :].to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, starts(rows)


def _in_small(prints: np.ndarray, at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Similar pairs (later, earlier) of all buckets of FEW rows or less."""
    sizes = np.diff(np.append(at, len(prints)))
    place = np.arange(len(prints)) - np.repeat(at, sizes)
    rows, later, earlier = np.flatnonzero(np.repeat(sizes, sizes) <= FEW), [], []
    for back in range(1, FEW):
        rows = rows[place[rows] >= back]
        found = rows[np.bitwise_count(prints[rows] ^ prints[rows - back]) <= most]
        later.append(found)
        earlier.append(found - back)
    return np.concatenate(later), np.concatenate(earlier)


def _large(at: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    ends = np.append(at[1:], n)
    for i in np.flatnonzero(ends - at > FEW):
        yield at[i], ends[i]


def _firsts(prints: np.ndarray, rows: np.ndarray, others: np.ndarray, most: int, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows with the first ``limit`` similar ones of others that are before them; and the rows that have more."""
    pairs, found = [(rows[:0], rows[:0])], np.zeros(len(prints), np.int64)
    for j in range(0, len(others), STEP):
        some = others[j : j + STEP]
        rows = rows[(rows > some[0]) & (found[rows] <= limit)]
        if not len(rows):
            break
        for i in range(0, len(rows), MOST_ROWS):
            part = rows[i : i + MOST_ROWS]
            near = (np.bitwise_count(prints[part][:, None] ^ prints[some]) <= most) & (some < part[:, None])
            hit = np.flatnonzero(near.any(axis=1))
            part, near = part[hit], near[hit]
            count = found[part][:, None] + near.cumsum(axis=1)
            found[part] = count[:, -1]
            r, k = np.nonzero(near & (count <= limit))
            pairs.append((part[r], some[k]))
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]), np.flatnonzero(found > limit)


def _by_distance(prints: np.ndarray, rows: np.ndarray, others: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with the first similar one of others at each distance."""
    pairs, seen = [(rows[:0], rows[:0])], np.zeros((len(prints), most + 1), bool)
    for j in range(0, len(others), STEP):
        some = others[j : j + STEP]
        for i in range(0, len(rows), MOST_ROWS):
            part = rows[i : i + MOST_ROWS]
            apart = np.bitwise_count(prints[part][:, None] ^ prints[some])
            r, k = np.nonzero(apart <= most)
            d = apart[r, k]
            new = ~seen[part[r], d]
            r, k, d = r[new], k[new], d[new]
            once = np.unique(r * (most + 1) + d, return_index=True)[1]
            r, k, d = r[once], k[once], d[once]
            seen[part[r], d] = True
            pairs.append((part[r], some[k]))
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def _in_order(keyed: DataFrame) -> DataFrame:
    """Whole buckets in a task, each in the order of paths."""
    return keyed.repartition(int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), *KEY).sortWithinPartitions(*KEY, "path")


def _earlier(keyed: DataFrame, most: int, limit: int) -> DataFrame:
    """For undecided nodes of keyed (whose accepted is false) similar nodes before them: those of small buckets, else an accepted one or the first ``limit``. A row without one (earlier is null): there are more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in _buckets(batches):
            prints, ok = rows["print"].to_numpy().view(np.uint64), rows["accepted"].to_numpy()
            later, earlier = _in_small(prints, at, most)
            mine = ~ok[later]
            later, earlier, more = [later[mine]], [earlier[mine]], []
            for i, j in _large(at, len(prints)):
                p, taken = prints[i:j], ok[i:j]
                left = np.flatnonzero(~taken)
                a, b, _ = _firsts(p, left, np.flatnonzero(taken), most, 1)
                later.append(a + i)
                earlier.append(b + i)
                left = np.setdiff1d(left, a, assume_unique=True)
                a, b, c = _firsts(p, left, left, most, limit)
                later.append(a + i)
                earlier.append(b + i)
                more.append(c + i)
            later, earlier, more = np.concatenate(later), np.concatenate(earlier), np.concatenate([*more, later[0][:0]])
            both = np.concatenate([later, more])
            out = pa.table({"family": rows["family"].take(pa.array(both)), "print": rows["print"].take(pa.array(both)), "earlier": pa.array(np.append(prints[earlier].view(np.int64), np.zeros(len(more), np.int64)), mask=np.arange(len(both)) >= len(later)), "accepted": np.append(ok[earlier], np.zeros(len(more), bool))})
            yield from out.combine_chunks().to_batches()

    return _in_order(keyed).mapInArrow(run, "family string, print long, earlier long, accepted boolean").distinct()


def _nearest(keyed: DataFrame, most: int) -> DataFrame:
    """For each node of keyed that isn't accepted and each distance the first accepted node, by path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in _buckets(batches):
            prints, ok = rows["print"].to_numpy().view(np.uint64), rows["accepted"].to_numpy()
            later, earlier = _in_small(prints, at, most)
            near, source = np.append(later, earlier), np.append(earlier, later)
            mine = ~ok[near] & ok[source]
            near, source = [near[mine]], [source[mine]]
            for i, j in _large(at, len(prints)):
                a, b = _by_distance(prints[i:j], np.flatnonzero(~ok[i:j]), np.flatnonzero(ok[i:j]), most)
                near.append(a + i)
                source.append(b + i)
            near, source = np.concatenate(near), np.concatenate(source)
            out = pa.table({"family": rows["family"].take(pa.array(near)), "print": rows["print"].take(pa.array(near)), "distance": np.bitwise_count(prints[near] ^ prints[source]).astype(np.int32), "source": rows["path"].take(pa.array(source))})
            yield from out.combine_chunks().to_batches()

    found = _in_order(keyed).mapInArrow(run, "family string, print long, distance int, source string")
    return found.groupBy(*NODE, "distance").agg(F.min("source").alias("source"))


def _accepted(nodes: DataFrame, keyed: DataFrame, most: int) -> DataFrame:
    """Nodes (family, print) that aren't similar to an accepted node before them.

    In rounds: an undecided node is rejected if an accepted one before it is similar, and
    accepted once all similar ones before it are rejected. Of many similar ones the first few
    mostly tell; nodes of which all those are rejected are compared anew with what is left.
    """
    undecided, accepted, limit = nodes.select(*NODE), [], LINKS
    rows = keyed.withColumn("accepted", F.lit(False))
    while True:
        found = cut(_earlier(rows, most, limit))
        links, more = found.where("earlier IS NOT NULL").select(*NODE, "earlier"), found.where("earlier IS NULL").select(*NODE)
        accepted.append(cut(undecided.join(found, NODE, "left_anti")))
        settled = accepted[-1].unionByName(found.where("accepted").select("family", F.col("earlier").alias("print")).distinct())
        rejected = []
        while settled.limit(1).count():
            gone = cut(links.join(settled.withColumnRenamed("print", "earlier"), ["family", "earlier"], "left_semi").select(*NODE).distinct())
            alive = links.join(gone, NODE, "left_anti")
            rest = cut(alive.join(gone.withColumnRenamed("print", "earlier"), ["family", "earlier"], "left_anti"))
            settled = cut(alive.select(*NODE).distinct().join(rest, NODE, "left_anti").join(more, NODE, "left_anti"))
            accepted.append(settled)
            rejected.append(gone)
            links = rest
        all_accepted = functools.reduce(DataFrame.unionByName, accepted)
        for gone in rejected:
            more = more.join(gone, NODE, "left_anti")
        undecided = cut(links.select(*NODE).unionByName(more).distinct())
        if not undecided.limit(1).count():
            return all_accepted
        limit *= 4
        state = all_accepted.withColumn("accepted", F.lit(True)).unionByName(undecided.withColumn("accepted", F.lit(False)))
        rows = keyed.join(state, NODE).join(keyed.join(undecided, NODE, "left_semi").select(*KEY).distinct(), KEY, "left_semi")


def near(files: DataFrame, threshold: float = 0.92) -> DataFrame:
    """Distinct files with dup_type, canonical_source and similarity_score.

    A file is compared with accepted files before it only: it is a copy of the most similar one
    that shares a band with it, of equally similar ones of the first. Files of one print are a node
    with the path of the first, as no other of them can be accepted. Similar pairs are never listed
    in full: a group of n similar nodes has few links for each and one source for each distance.
    """
    prints = cut(files.withColumns({"family": t.content_family("path"), "print": t.simhash("content")}).select("path", *NODE))
    most = max((d for d in range(65) if 1 - d / 64 >= threshold), default=-1)
    nodes = cut(prints.where(F.col("print").isNotNull() & F.lit(most >= 0)).groupBy(*NODE).agg(F.min("path").alias("path")))
    most = max(most, 0)
    keyed = cut(_keyed(nodes, most))
    accepted = cut(_accepted(nodes, keyed, most).withColumn("accepted", F.lit(True)))
    state = nodes.select(*NODE).join(accepted, NODE, "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))
    own = nodes.join(accepted, NODE, "left_semi").select(*NODE, F.lit(0).alias("distance"), F.col("path").alias("source"))
    sources = own.unionByName(_nearest(keyed.join(state, NODE), most)).groupBy(*NODE).agg(F.collect_list(F.struct("distance", "source")).alias("_sources"))
    # The first source at a distance is before the file if any is.
    out = prints.join(sources, NODE, "left").withColumn("_best", F.expr("array_min(filter(_sources, x -> x.source < path))"))
    is_ok = F.col("_best").isNull()
    return out.select("path", "family", F.when(is_ok, "canonical").otherwise("near").alias("dup_type"), F.when(is_ok, F.col("path")).otherwise(F.col("_best.source")).alias("canonical_source"), F.when(is_ok, F.lit(1.0)).otherwise(1 - F.col("_best.distance") / 64).alias("similarity_score"))


def summary(files: DataFrame) -> DataFrame:
    """Files and characters by dup_type (path, content, dup_type), and how many characters copies save."""
    size = F.coalesce(F.length("content"), F.lit(0)).cast("long")
    return files.groupBy("dup_type").agg(F.count("*").alias("n"), F.sum(size).alias("chars"), F.sum(F.when(F.col("dup_type") == "canonical", F.lit(0)).otherwise(size)).cast("long").alias("saved"))


def first_of(samples: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The first row of each key."""
    return samples.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")
