"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by the hash of their text, then by id, so that equal texts lie
together. Splitters of that order are found by counting: in each round the exact
bytes and rows of every cell of the key range that still holds a splitter are
counted across all partitions, and the cell that holds the target is probed
more finely, first by the bits of the hash, then, within one text's copies, by
the range of their ids. A splitter is settled when its cell holds no more bytes
than the tolerance, or one key. Then whole rows, texts and all, are exchanged once,
by the interval they fall in, and numbered; their digests are taken after that.

The order is cut into more intervals than shards, so that no task sorts more
than about ``rows_per_task`` rows or ``BYTES_PER_TASK`` bytes; a shard is a run of intervals, and counts of
the intervals give where each one's slots begin. The driver sees counts of
cells only: at most 16 for each splitter in a round.

A group of equal texts that is larger than a shard is split by id. A null text
counts 8 bytes and is a group of its own; a null id is ordered first. Rows that
are wholly equal get different slots. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import literal_table, stored, table

SHARDS, ROWS_PER_TASK, BYTES_PER_TASK, TOLERANCE = 24, 1_000_000, 256_000_000, 0.0005
FIRST_BITS, MORE_BITS = 12, 4
LEAST = -(2**63)


@dataclass
class Target:
    """The key at which ``wanted`` bytes lie below it is in [low, low + width of its level)."""

    wanted: float
    below: int = 0
    prefix: int | None = None
    key: tuple[int, int] | None = None


def size_of(text: str) -> F.Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def keyed() -> dict[str, F.Column]:
    return {"_h": F.when(F.col("text").isNull(), F.lit(LEAST)).otherwise(F.xxhash64("text")), "_d": F.coalesce("doc_id", F.lit(LEAST))}


def splitters(keys: DataFrame, intervals: int, tolerance: float) -> list[tuple[int, int]]:
    """Keys (hash, id), each the first of the next interval."""
    spark = keys.sparkSession
    step = 0
    total, bits = keys.agg(F.sum("size")).first()[0] or 0, FIRST_BITS
    targets = [Target(total * i / intervals) for i in range(1, intervals)]
    within = max(1.0, total / SHARDS * tolerance)
    while (open_ := [t for t in targets if t.key is None]) and total:
        cells = keys
        if bits > FIRST_BITS:
            held = spark.range(1).select(F.explode(longs(sorted({t.prefix for t in open_}))).alias("_p"))
            cells = keys.withColumn("_p", F.shiftright("_h", 64 - bits + step)).join(F.broadcast(held), "_p", "left_semi")
        counted = cells.groupBy(F.shiftright("_h", 64 - bits).alias("p")).agg(F.sum("size").alias("n"), F.min("_h").alias("a"), F.max("_h").alias("z")).orderBy("p").collect()
        in_group, at, sums = [], [c["p"] for c in counted], [0, *accumulate(c["n"] for c in counted)]
        for t in open_:
            low, high = (0, len(at)) if t.prefix is None else (bisect_left(at, t.prefix << step), bisect_left(at, (t.prefix + 1) << step))
            i = min(high - 1, bisect_left(sums, t.wanted - t.below + sums[low], low + 1, high + 1) - 1)
            c, t.below, t.prefix = counted[i], t.below + sums[i] - sums[low], at[i]
            if c["n"] <= within:
                nearer_end = t.below + c["n"] - t.wanted < t.wanted - t.below
                t.key = (c["z"] + 1 if nearer_end and c["z"] < 2**63 - 1 else c["a"], LEAST)
            elif c["a"] == c["z"]:
                in_group.append((t, c["a"]))
        if in_group:
            by_id(keys, in_group, within)
        step = min(MORE_BITS, 64 - bits)
        bits += step
    return [t.key or (2**63 - 1, 2**63 - 1) for t in targets]


def by_id(keys: DataFrame, targets: list[tuple[Target, int]], within: float, parts: int = 16) -> None:
    """Settles targets within groups of equal hashes by probing ranges of ids."""
    spark = keys.sparkSession
    ranges = {h: None for _, h in targets}
    held = F.broadcast(literal_table(spark, [(h,) for h in ranges], {"_h": "long"}))
    group = keys.join(held, "_h", "left_semi").select("_h", "_d", "size")
    for r in group.groupBy("_h").agg(F.min("_d"), F.max("_d")).collect():
        ranges[r[0]] = (r[1], r[2])
    open_ = [[t, h, *ranges[h]] for t, h in targets]
    while open_:
        spans = sorted({(h, a, (z - a) // parts + 1) for _, h, a, z in open_})
        spans_df = F.broadcast(literal_table(spark, [(h, a, w, a + w * parts) for h, a, w in spans], {"_h": "long", "a": "decimal(20,0)", "w": "decimal(20,0)", "e": "decimal(20,0)"}))
        d = F.col("_d").cast("decimal(20,0)")
        cells = group.join(spans_df, "_h").where((d >= F.col("a")) & (d < F.col("e"))).groupBy("_h", "a", F.floor((d - F.col("a")) / F.col("w")).cast("long").alias("i")).agg(F.sum("size").alias("n"), F.min("_d").alias("first"), F.max("_d").alias("last")).orderBy("_h", "a", "i").collect()
        left, of = [], {}
        for c in cells:
            of.setdefault((c["_h"], int(c["a"])), []).append(c)
        for t, h, a, z in open_:
            mine = of[h, a]
            for c in mine:
                if t.below + c["n"] >= t.wanted or c is mine[-1]:
                    break
                t.below += c["n"]
            if c["n"] <= within or c["first"] == c["last"]:
                nearer_end = t.below + c["n"] - t.wanted < t.wanted - t.below
                t.key = (h, c["last"] + 1) if nearer_end and c["last"] < 2**63 - 1 else (h, c["first"])
            else:
                left.append([t, h, c["first"], c["last"]])
        open_ = left


def longs(values: list[int]) -> F.Column:
    """An array of constants that is one short expression, however many there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def interval_of(found: list[tuple[int, int]], most_cases: int = 256) -> F.Column:
    """The number of splitters at or below a row's key, by halving: in compiled cases, or for many splitters in arrays."""
    if not found:
        return F.lit(0)
    if len(found) > most_cases:
        hs, ds = longs([h for h, _ in found]), longs([d for _, d in found])

        def further(n: F.Column, by: F.Column) -> F.Column:
            # Beyond the end there is null, which is not below.
            h, d = F.get(hs, n + by - 1), F.get(ds, n + by - 1)
            return F.when((h < F.col("_h")) | ((h == F.col("_h")) & (d <= F.col("_d"))), n + by).otherwise(n)

        powers = [1 << k for k in reversed(range(len(found).bit_length()))]
        return F.aggregate(F.array(*map(F.lit, powers)), F.lit(0), further)

    def below(low: int, high: int) -> F.Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        h, d = found[mid]
        left = (F.col("_h") < F.lit(h)) | ((F.col("_h") == F.lit(h)) & (F.col("_d") < F.lit(d)))
        return F.when(left, below(low, mid)).otherwise(below(mid + 1, high))

    return below(0, len(found))


def shards(docs: DataFrame, n: int = SHARDS, tolerance: float = TOLERANCE, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every row whole (``row``) in its shard and slot, with doc_id, size, text_crc32, law and grown_shard."""
    keys, _ = stored(docs.select(size_of("text").alias("size"), *(c.alias(name) for name, c in keyed().items())), "shard-keys")
    count, total = keys.agg(F.count("*"), F.sum("size")).first()
    runs = max(1, -(-count // (n * rows_per_task)), -(-(total or 0) // (n * BYTES_PER_TASK)))
    found = splitters(keys, n * runs, tolerance)
    rows = dict(keys.groupBy(interval_of(found).alias("i")).count().collect())
    offsets, at = [], 0
    for i in range(n * runs):
        at = 0 if i % runs == 0 else at
        offsets.append(at)
        at += rows.get(i, 0)
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(c.alias(name) for name, c in keyed().items()))
    dealt = whole.withColumn("_i", interval_of(found))
    order = Window.partitionBy("_i").orderBy("_h", "_d", "row.text")
    first = F.element_at(longs(offsets), F.col("_i") + 1)
    return dealt.withColumn("slot", first + F.row_number().over(order) - 1).select(
        "row", F.col("row.doc_id").alias("doc_id"), size_of("row.text").alias("size"), F.crc32(F.coalesce(F.col("row.text").cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.floor(F.col("_i") / runs).cast("int").alias("shard"), F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents")).drop("row")
