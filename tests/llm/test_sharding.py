import bisect
import random
import time
import zlib

from loamline.llm import sharding as s
from pyspark.sql import functions as F


def whole(rows, texts, n, spare):
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    by = [[r for r in rows if r["shard"] == i] for i in range(n)]
    assert sum(map(len, by)) == len(texts)
    assert all(sorted(r["slot"] for r in b) == list(range(len(b))) for b in by)
    sizes = [sum(r["size"] for r in b) for b in by]
    assert max(sizes) - min(sizes) <= spare, sizes


def test_even_bytes_with_a_hot_group_nulls_and_repeats(spark):
    texts = [f"text {i} " * (1 + i * 7919 % 13) for i in range(2000)] + ["copy of one text"] * 3000 + [None, "", "é"] * 5
    rows = [(i if i % 400 else None, t, "x") for i, t in enumerate(texts)] + [(7, "same row", "x")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, size string")
    for per_task in (10**6, 50, 5):
        got = s.shards(docs, 8, rows_per_task=per_task).collect()
        whole(got, [r[1] for r in rows], 8, 2 * (8 * 13 + 120) + 200)
        copies = {}
        for r in got:
            if r["size"] == 24:
                copies.setdefault(r["shard"], 0)
                copies[r["shard"]] += 1
        assert len(copies) > 1


def test_equal_texts_stay_together_where_they_fit(spark):
    docs = spark.createDataFrame([(i, f"t{i // 3}") for i in range(900)], "doc_id long, text string")
    got = s.shards(docs, 4).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(g) > 1 for g in groups.values()) <= 3


def test_empty_and_tiny(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert s.shards(docs).count() == 0
    got = s.shards(spark.createDataFrame([(1, "a")], "doc_id long, text string")).collect()
    assert len(got) == 1 and got[0]["slot"] == 0 and 0 <= got[0]["shard"] < 24 and got[0]["law"] == "bytes"


def test_rows_arrive_whole_in_their_shards(spark):
    rows = [(None if i % 5 == 0 else i % 7, None if i % 11 == 0 else f"text {i % 40} " * (i % 9), f"c{i}") for i in range(300)]
    got = s.shards(spark.createDataFrame(rows, "doc_id long, text string, slot string"), 4).collect()
    assert sorted(map(str, (tuple(r["row"]) for r in got))) == sorted(map(str, rows))
    for r in got:
        text = (r["row"]["text"] or "").encode()
        assert (r["doc_id"], r["size"], r["text_crc32"]) == (r["row"]["doc_id"], len(text) + 8, zlib.crc32(text))
    whole(got, [r[1] for r in rows], 4, 1000)


def test_many_splitters_are_searched_alike(spark):
    r = random.Random(3)
    found = sorted((r.randrange(-50, 50), r.choice([s.LEAST, r.randrange(40)])) for _ in range(700))
    keys = spark.createDataFrame([(r.randrange(-60, 60), r.choice([s.LEAST, r.randrange(45)])) for _ in range(2000)] + found, "_h long, _d long")
    for n in (1, 2, 255, 256, 700):
        some = found[:n]
        for h, d, one, other in keys.select("_h", "_d", s.interval_of(some, 1000), s.interval_of(some, 0)).collect():
            assert one == other == bisect.bisect_right(some, (h, d))


def test_twenty_thousand_splitters_take_seconds(spark):
    keys = spark.range(100_000).select(F.lit(10).cast("long").alias("size"), F.xxhash64("id").alias("_h"), F.col("id").alias("_d")).cache()
    keys.count()
    began = time.time()
    found = s.splitters(keys, 20_000, 0.0005)
    assert len(found) == 19_999 and found == sorted(found) and time.time() - began < 60
    sizes = keys.groupBy(s.interval_of(found).alias("i")).count().toPandas()["count"]
    assert sizes.sum() == 100_000 and sizes.max() <= 7
