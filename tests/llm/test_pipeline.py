import corpus_pipeline as p
from loamline.llm import decontamination, near_dedup, pieces, pii, quality_rules


def test_stages_on_the_small_tables(spark, monkeypatch):
    model = pii.train(steps=60, batch=16)
    monkeypatch.setattr(pii, "train", lambda: model)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    ruled = p.rules(spark, docs, sf).cache()
    assert ruled.columns == docs.columns and 0 < ruled.count() < docs.count()
    kept = {r["doc_id"] for r in quality_rules.judged(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("kept").select("_row.doc_id").collect()}
    assert {r["doc_id"] for r in ruled.collect()} == kept
    unique = p.near_duplicates(spark, ruled, sf).cache()
    assert unique.columns == docs.columns
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted({r["class_id"] for r in near_dedup.classes(ruled).collect()})
    cut = p.benchmark_passages(spark, unique, sf).cache()
    assert cut.columns == docs.columns and decontamination.matched(cut.select("doc_id", "text"), spark.read.parquet(f"{sf}/benchmark.parquet")).where("n_hit > 0").count() == 0
    clean = p.personal_data(spark, cut, sf).cache()
    assert clean.columns == docs.columns
    assert all(not any(pii.base_spans(r["text"])) and r["n_chars"] == len(r["text"]) for r in clean.collect())
    last = p.encode(spark, clean, sf)
    with open(pieces.VOCABULARY, "rb") as f:
        e = pieces.Encoder(pieces.Vocabulary.read(f.read()))
    want = {r["doc_id"]: len(e.encode([r["text"]])[0]) for r in clean.collect()}
    assert {r["doc_id"]: r["n_pieces"] for r in last.collect()} == want and all(r["round_trip"] for r in last.collect())
    assert sum(r["text"] == before[r["doc_id"]] for r in clean.collect()) > 0.7 * len(want)


def test_empty_documents(spark, monkeypatch):
    monkeypatch.setattr(pii, "train", lambda: pii.new_model())
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_run_on_nulls_repeats_and_extra_columns(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(pii, "train", lambda: pii.new_model())
    sf = "/root/testdata/sf0.001"
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "'a' AS node", "'b' AS _row", "1 AS stats", "2 AS kept", "3 AS n_hit")
    odd = docs.limit(3).selectExpr("doc_id", "cast(null as string) AS text", "lang", "source", "n_chars", "node", "_row", "stats", "kept", "n_hit")
    long = docs.limit(1).selectExpr("cast(null as bigint) AS doc_id", "concat_ws(' ', transform(sequence(1, 60000), x -> sha1(cast(x as string)))) AS text", "lang", "source", "n_chars", "node", "_row", "stats", "kept", "n_hit")
    docs.unionByName(docs).unionByName(odd).unionByName(long).write.parquet(f"{tmp_path}/documents.parquet")
    got = [r["doc_id"] for r in p.run(spark, str(tmp_path)).collect()]
    ids = [x for x in got if x is not None]
    assert len(ids) == len(set(ids)) > 50 and got.count(None) <= 1
