import random
import re

from loamline.llm import quality_rules as q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    base = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))
    return (*base, len(words) < 50 or 100 * len(hit) > 50 * len(words))


def test_counts_against_brute_force(spark):
    r = random.Random(1)
    texts = [None, "", " \t\r\n", "a", "a b", "a b c", "a b c a b c", "x " * 3000, "é#\n\né#\n b\x0bc\n b\x0bc", "\u2003wide\u2003 space"]
    texts += [" ".join(r.choice("ab c\n dé $ %".split(" ")) for _ in range(r.randrange(200))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    rows = q.with_stats(docs).select("doc_id", *(f"stats.{s}" for s in q.STATS), "stats.base_failed").collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_list_learns_and_matches_its_column(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = q.learn([({f: float(i % 7) for f in q.FEATURES} | {"symbol_share": 0.3 if i % 5 == 0 else 0.0}, i % 5 == 0) for i in range(500)])
    assert rules.rules and not rules.keeps({f: 1.0 for f in q.FEATURES} | {"symbol_share": 0.3})
    rows = q.with_stats(docs).withColumn("kept", rules.verdict()).select("stats.*", "kept").collect()
    assert all(r["kept"] == rules.keeps({f: float(r[f]) for f in q.FEATURES}) for r in rows)
    got = q.op1_quality_rules(spark, sf)
    assert got.count() == docs.count()
    both = got.join(labels, "doc_id")
    assert both.where("quality = 0 and kept").count() <= 2 and both.where("quality = 1 and not kept and not base_failed").count() <= 2


def test_empty_tables_and_repeats(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert q.judged(docs, labels).count() == 0
    docs = spark.createDataFrame([(1, "w " * 60), (1, "w " * 60), (None, None)], "doc_id long, text string")
    assert q.judged(docs, labels).where("not kept").count() == 3
    assert q.learn([]).rules == []


def test_columns_of_any_name_stay(spark):
    rows = [(1, "w " * 20, 1, "k", "x", "r"), (2, " ".join(f"word{i}" for i in range(80)), 2, "k", "x", "r"), (None, None, 3, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stats int, kept string, _words string, _row string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    kept = q.kept_rows(docs, labels)
    assert kept.columns == docs.columns and list(map(tuple, kept.collect())) == rows[1:2]
