import hashlib

from loamline.functions import html
from loamline.functions import text as t
from loamline.operators import augment, dedup, refine, templates
from loamline.sources import crawl, files
from pyspark.sql import functions as F


def simhash(text):
    text = " ".join(text.lower().split()).ljust(5)
    votes = [0] * 64
    for i in range(max(1, len(text) - 4)):
        v = int.from_bytes(hashlib.sha256(text[i : i + 5].encode()).digest()[:8], "big")
        votes = [s + (1 if v >> b & 1 else -1) for b, s in enumerate(votes)]
    out = sum(1 << b for b, s in enumerate(votes) if s >= 0)
    return out - (1 << 64) if out >= 1 << 63 else out


def test_simhash_and_greedy_near_duplicates(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away from all of the others in the wood " * 3
    texts = [base, base + "x", base + "xy", "entirely different content " * 8, base.replace("dog", "cat"), "a", "", "entirely different content " * 8 + "!"]
    rows = [(f"p{i}.md", x) for i, x in enumerate(texts)]
    prints = [simhash(x) for x in texts]
    df = spark.createDataFrame(rows, "path string, content string")
    assert [r[0] for r in df.select(t.simhash("content")).collect()] == prints
    ok, want = [], {}
    for (path, _), p in zip(rows, prints, strict=True):
        near = [(1 - bin((p ^ q) & (1 << 64) - 1).count("1") / 64, other) for other, q in ok if any((p >> 16 * b & 0xFFFF) == (q >> 16 * b & 0xFFFF) for b in range(4))]
        best = max((s for s, _ in near), default=0)
        if best >= 0.8:
            want[path] = ("near", next(o for s, o in near if s == best), best)
        else:
            ok.append((path, p))
            want[path] = ("canonical", path, 1.0)
    got = {r["path"]: (r["dup_type"], r["canonical_source"], r["similarity_score"]) for r in dedup.near(df, 0.8).collect()}
    assert got == want and any(x[0] == "near" for x in got.values())


def chunks(text, most, overlap):
    lines, out, start = text.splitlines(), [], 0
    while start < len(lines):
        end, size = start, 0
        while end < len(lines) and (end == start or size + 1 + len(lines[end]) <= most):
            size += len(lines[end]) + (end > start)
            end += 1
            if size >= most:
                break
        out.append((start + 1, end))
        if end >= len(lines):
            break
        start = end - overlap if end - overlap > start else end
    return out


def test_char_chunks(spark):
    texts = ["a" * 2500 + "\n" + "b" * 2500 + "\n" + "c" * 2500, "short", "\n".join("l" * (i % 40) for i in range(300)) + "\n", "z" * 9000]
    df = spark.createDataFrame([(i, "x", "in", x) for i, x in enumerate(texts)], "seq long, instruction string, input string, output string")
    for most, overlap in ((3000, 1), (500, 3)):
        got = {}
        for r in refine.char_chunks(df, most, overlap).collect():
            if r["char_chunk_index"] is not None:
                got.setdefault(r["seq"], []).append((r["char_chunk_start_line"], r["char_chunk_end_line"]))
        assert {k: sorted(v) for k, v in got.items()} == {i: chunks(x, most, overlap) for i, x in enumerate(texts) if len(x) > most}


def test_line_chunks(spark):
    df = spark.createDataFrame([(1, "do", "", "\n".join(f"line_{i}" for i in range(609)))], "seq long, instruction string, input string, output string")
    rows = refine.line_chunks(df, 300, 30, True).orderBy("chunk_index").collect()
    assert [(r["line_start"], r["line_end"]) for r in rows] == [(1, 300), (271, 570), (541, 609)] and rows[0]["instruction"].startswith("do [Part 1/3")


def test_grouped_split_keeps_groups_whole(spark):
    df = spark.createDataFrame([(i, f"s{i % 7}") for i in range(210)], "seq long, source string")
    assert refine.grouped_split(df).groupBy("source").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0


def test_html_and_links(spark):
    page = "<html><head><title>x</title></head><body><nav>no</nav><h1>Head</h1><p>One <b>two</b> &amp; <a href='/y'>three</a></p><ul><li>i</li></ul></body></html>"
    assert html.to_markdown(page) == "# Head\n\nOne **two** & [three](/y)\n\n- i\n"
    df = spark.createDataFrame([("http://a.b/c/", '<a href="d#e"></a><a class="q" href="/f"></a>')], "url string, html string")
    assert sorted(r["link"] for r in crawl.links(df).collect()) == ["http://a.b/c/d", "http://a.b/f"]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "url string, link string")
    assert [r["url"] for r in crawl.reachable(edges.select("url").limit(1), edges, 10).collect()] == ["a", "b", "c"]


def test_templates(spark):
    df = spark.createDataFrame([("x/card/card.component.yml", "name: Card"), ("x/card/card.twig", "<div>")], "path string, content string")
    assert templates.bundle_samples(templates.component_pairs(df)).count() == 4
    two = spark.createDataFrame([("r/multi_thing.php", "<?php\nclass A {}\nclass B {}")], "path string, content string")
    assert "class MultiThing " in templates.code_sample(two).first()["instruction"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("one\n\ntwo\n")
    (tmp_path / "in" / "b.png").write_bytes(b"\0\1")
    (tmp_path / "in" / "c.jsonl").write_text('{"instruction": "i", "output": "o"}\nbroken\n')
    tree = files.read_tree(spark, str(tmp_path / "in"))
    assert sorted(r["path"][-4:] for r in tree.collect()) == ["a.md"[-4:], "sonl"]
    assert [r["line"] for r in files.numbered_lines(spark, str(tmp_path / "in" / "a.md")).collect()] == [1, 3]
    rows = files.read_samples(spark, str(tmp_path / "in" / "c.jsonl"), "train").cache()
    assert rows.where("_corrupt is not null").count() == 1 and rows.where("_corrupt is null").first()["output"] == "o"
    files.write_samples(rows, str(tmp_path / "out"))
    assert "_corrupt" not in spark.read.json(str(tmp_path / "out")).columns
    assert len(files.tree_digest(files.file_index(spark, str(tmp_path / "in")))) == 64


def test_streaming_dedup(spark, tmp_path):
    from loamline.streaming import gate as stream

    for k in range(2):
        spark.createDataFrame([(k * 3 + i, f"text {i}") for i in range(3)], "seq long, output string").write.json(str(tmp_path / "in"), mode="append")
    s = spark.readStream.schema("seq long, output string").json(str(tmp_path / "in"))
    q = stream.new_outputs(s).writeStream.format("memory").queryName("fresh").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("fresh").count() == 3


def test_trees_keep_text_files_whatever_their_lines_end_with(spark, tmp_path):
    ends = ["stop", "space ", "0", "@", "P", "`"]
    for i, x in enumerate(ends):
        (tmp_path / f"f{i}.txt").write_text(f"{x}\nnext\n")
    (tmp_path / "a.svg").write_text("<svg/>")
    (tmp_path / "nul.txt").write_bytes(b"a\0b")
    (tmp_path / "nul.php").write_bytes(b"a\0b")
    (tmp_path / "bad.txt").write_bytes(b"caf\xe9 ol\xc3\xa9")
    got = {r["path"].rsplit("/", 1)[1]: r["content"] for r in files.read_tree(spark, str(tmp_path)).collect()}
    assert got == {f"f{i}.txt": f"{x}\nnext\n" for i, x in enumerate(ends)} | {"nul.php": "a\0b", "bad.txt": "caf ol\u00e9"}


def test_augmentation_candidates_and_pairs_of_components(spark):
    rows = [("a/tests/x.php", "<?php", 1), ("a/x.md", "<?php", 1), ("a/x.module", "text", 1), ("a/x.inc", " \n<?php", 3), ("a/x.theme", "<?php", None)]
    df = spark.createDataFrame(rows, "source string, output string, chunk_total int")
    assert [r[0] for r in df.select(augment.candidate_reason()).collect()] == ["augmentation_from_test_source", "augmentation_non_php_source", "augmentation_non_php_output", "augmentation_chunked_source", None]
    paths = ["c/card/card.component.yml", "c/card/card.twig", "c/hero/component.yml", "c/hero/hero.twig", "c/lone/component.yml", "component.yml", "component.twig"]
    df = spark.createDataFrame([(p, "x") for p in paths], "path string, content string")
    assert sorted((r["yaml_path"], r["twig_path"]) for r in templates.component_pairs(df).collect()) == [("c/card/card.component.yml", "c/card/card.twig"), ("c/hero/component.yml", "c/hero/hero.twig"), ("component.yml", "component.twig")]
