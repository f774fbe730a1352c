"""Registered queries of the engine's own operators, each with the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import html
from ..functions import text as t
from ..operators import augment, dedup, evaluation, gate, metrics, projects, refine, templates
from ..sources import crawl

NUMBERS = "\n".join(map(str, range(1, 45)))
CODE = "<?php\n\nnamespace A;\n\nuse B\\C;\nuse D;\n\n"

#: Samples drawn from documents, in SQL that both engines take.
SAMPLES = f"""
SELECT doc_id AS seq, lang,
  CASE doc_id % 5 WHEN 0 THEN 'code_reference' WHEN 1 THEN 'yaml_reference' WHEN 2 THEN 'doc_summary' WHEN 3 THEN 'twig_reference' ELSE 'sdc_reference' END AS type,
  CASE doc_id % 6 WHEN 0 THEN 'bugfix' WHEN 1 THEN 'refactor' WHEN 2 THEN 'write_from_spec' WHEN 3 THEN 'explain_and_implement' WHEN 4 THEN 'retrieval' ELSE 'other' END AS sample_type,
  CASE WHEN doc_id % 3 = 0 THEN 'repos/' || source || '/tests/F' || CAST(doc_id AS STRING) || 'Test.php' WHEN doc_id % 4 = 0 THEN 'repos/' || source || '/src/F' || CAST(doc_id AS STRING) || 'Interface.php' ELSE 'docs/' || source || '/d' || CAST(doc_id AS STRING) || '.md' END AS source,
  CASE WHEN doc_id % 5 = 2 THEN 'Explain the following topic: ' || left(text, 20) WHEN doc_id % 5 = 1 THEN 'Show the yaml configuration of ' || source WHEN doc_id % 5 = 0 THEN 'Show me the implementation of the class ' || CASE WHEN doc_id % 2 = 0 THEN 'C' ELSE 'c' END || CAST(doc_id AS STRING) || ' in the file f.php.' ELSE left(text, 40) END AS instruction,
  CASE WHEN doc_id % 13 = 0 THEN ' ' ELSE 'File: ' || source END AS input, left(text, 20) AS topic,
  CASE WHEN doc_id % 7 = 0 THEN 'Instruction: ' || text WHEN doc_id % 11 = 0 THEN text || chr(10) || '{NUMBERS}' WHEN doc_id % 17 = 0 THEN '<?php' || chr(10) || 'interface I' || CAST(doc_id AS STRING) || ' {{}}' || chr(10) || text
       WHEN doc_id % 19 = 0 THEN '```' || chr(10) || text WHEN doc_id % 23 = 0 THEN '```' || chr(10) || '{NUMBERS}' || chr(10) || '```' || chr(10) || text ELSE text END AS output
FROM documents
"""


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(SAMPLES.replace("FROM documents", "FROM {documents}").replace(" {}", " {{}}"), documents=docs(spark, sf))


# --- text --------------------------------------------------------------------


def fn01_normalize(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(t.normalized(F.concat(F.lit(" \r\n"), F.replace("text", F.lit(". "), F.lit(".  \r\n")), F.lit("  ")))).alias("h"))


def fn05_hashes(spark, sf):
    return docs(spark, sf).select("doc_id", t.output_hash("text").alias("raw"), t.output_hash("text", True).alias("normal"), t.letters("text").cast("long").alias("letters"))


def fn07_code_blocks(spark, sf):
    return samples(spark, sf).select("seq", F.size(t.code_blocks("output")).cast("long").alias("n"), F.coalesce(F.md5(F.get(t.code_blocks("output"), F.lit(0))), F.lit("")).alias("first"))


def fn14_format_sanity(spark, sf):
    return samples(spark, sf).select("seq", t.wrapper_echo("output").alias("echo"), F.round(t.repeated_line_ratio("output"), 6).alias("repeated"), (t.numeric_streak("output", True) >= 40).alias("streak"), t.format_sanity("output").alias("sanity"))


def pj18_paths(spark, sf):
    s = samples(spark, sf)
    return s.select("seq", t.file_hint("source").alias("file"), t.module_hint("source").alias("module"), t.content_family("source").alias("family"), t.kind_from_path("source").alias("kind"), t.source_bucket("source").alias("bucket"), t.symbol_name("topic").alias("symbol"), t.slug("topic").alias("slug"))


def fn21_labels(spark, sf):
    ids = docs(spark, sf).select("doc_id", F.transform(F.sequence(F.lit(1), (F.col("doc_id") % 9 + 3).cast("int")), lambda i: (i * 10).cast("int")).alias("ids"))
    marked = ids.withColumn("labels", t.completion_labels("ids", F.array(F.lit(30), F.lit(40))))
    size = t.rounded_up(F.max(F.size("ids")).over(Window.partitionBy(F.floor(F.col("doc_id") / 8))), 8)
    out = marked.withColumn("size", size)
    return out.select("doc_id", F.array_join(t.padded("ids", F.col("size"), 0), ",").alias("ids"), F.array_join(t.padded("labels", F.col("size"), -100), ",").alias("labels"))


# --- rules -------------------------------------------------------------------

GATE = gate.GateConfig(min_chars=50, max_by_type={"doc_summary": 6000}, min_by_type={"yaml_reference": 20}, need_input=["yaml_reference"], denied_topics=["the "], doc_sources=["docs/", "repos/src1"])


def fl01_gate_rules(spark, sf):
    return gate.stateless(samples(spark, sf), GATE).select("seq", "before", "after")


def fl01_gate(spark, sf):
    return gate.gated(samples(spark, sf), GATE).select("seq", "type", "rejection_reason")


def ag02_gate_report(spark, sf):
    return metrics.reasons_report(gate.gated(samples(spark, sf), GATE)).select(F.coalesce("type", F.lit("*")).alias("type"), F.coalesce("rejection_reason", F.lit("*")).alias("reason"), "n", "level")


def fl10_validation(spark, sf):
    return samples(spark, sf).select("seq", refine.validation_reason(("yaml_reference",)).alias("reason"))


def fl13_categories(spark, sf):
    p = {"a": ["the\\s+of", "\\bing"], "b": ["license"], "c": []}
    return samples(spark, sf).select("seq", *(refine.matches(k, p).alias(k) for k in p))


def fl21_audit(spark, sf):
    return metrics.artifact_audit(samples(spark, sf), 12, 0.31)


# --- refinement --------------------------------------------------------------


def wn14_line_chunks(spark, sf):
    out = refine.line_chunks(samples(spark, sf), 20, 5)
    return out.select("seq", "chunk_index", "chunk_total", "line_start", "line_end", "input", F.md5("output").alias("h"))


def wn15_char_chunks(spark, sf):
    out = refine.char_chunks(samples(spark, sf), 2000, 2)
    return out.select("seq", "char_chunk_index", "char_chunk_total", "char_chunk_start_line", "char_chunk_end_line", F.length("output").alias("n"))


def wn01_first_pairs(spark, sf):
    return dedup.first_of(samples(spark, sf), ["instruction", "output"]).select("seq")


def wn02_exact_dedup(spark, sf):
    files = docs(spark, sf).select(F.format_string("f%06d.md", "doc_id").alias("path"), F.col("text").alias("content"))
    return dedup.exact(files).select("path", "hash", "canonical_path", F.when(F.col("path") == F.col("canonical_path"), "canonical").otherwise("exact").alias("dup_type"))


def wn03_near_dedup(spark, sf):
    first = wn02_exact_dedup(spark, sf).where("dup_type = 'canonical'").select("path")
    files = docs(spark, sf).select(F.format_string("f%06d.md", "doc_id").alias("path"), F.col("text").alias("content"))
    return dedup.near(files.join(first, "path", "left_semi"))


def wn04_ranked_dedup(spark, sf):
    return refine.ranked_dedup(samples(spark, sf)).select("seq", "kept")


def wn07_split(spark, sf):
    return refine.positional_split(samples(spark, sf)).select("seq", "split")


def wn08_rebalance(spark, sf):
    return refine.rebalanced(samples(spark, sf), 0.2, 42).select("seq", "kept")


def wn09_share_cap(spark, sf):
    return refine.share_capped(samples(spark, sf), "lang", 0.45, 42, F.when(F.contains("output", F.lit("license")), 1).otherwise(0)).select("seq", "lang", "kept")


def wn10_quota(spark, sf):
    return refine.quota_sample(samples(spark, sf), {"a": 20}, 0.3, 42, {"a": ["license"]}).select("seq")


def wn11_round_robin(spark, sf):
    picked = refine.quota_sample(samples(spark, sf), {"a": 20}, 0.3, 42, {"a": ["license"]})
    return refine.round_robin(picked, ["bugfix", "refactor", "write_from_spec"], 42).select("seq", "augmentation_type")


def wn12_grouped_split(spark, sf):
    return refine.grouped_split(docs(spark, sf).select("doc_id", "source")).select("doc_id", "source", "split")


def wn17_turn_pairs(spark, sf):
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    after = Window.partitionBy("conv_id").orderBy("turn")
    pairs = conv.select("conv_id", "turn", "role", F.md5("text").alias("ask"), F.lead("role").over(after).alias("next_role"), F.md5(F.lead("text").over(after)).alias("answer"))
    return pairs.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", "ask", "answer")


# --- figures -----------------------------------------------------------------


def ag04_percentiles(spark, sf):
    return metrics.nearest_rank(samples(spark, sf).select("type", F.length("output").cast("long").alias("n")), "n", [0.5, 0.9, 0.95, 0.99], ["type"])


def ag05_empty_inputs(spark, sf):
    return metrics.empty_input_share(samples(spark, sf))


def ag06_ambiguity(spark, sf):
    return metrics.ambiguity(samples(spark, sf).withColumn("input", F.lit("")))


def ag07_duplicates(spark, sf):
    return metrics.duplicate_ratio(samples(spark, sf))


def ag08_concentration(spark, sf):
    return metrics.concentration(samples(spark, sf), t.source_bucket("source"))


def results(spark, sf):
    d = docs(spark, sf).select("doc_id", "text")
    return d.select(
        F.col("doc_id").alias("seq"), F.concat(F.lit("m"), F.col("doc_id") % 3).alias("model_name"), F.concat(F.lit("p"), F.floor(F.col("doc_id") / 6) % 5).alias("prompt_id"), F.when(F.floor(F.col("doc_id") / 3) % 2 == 0, "fine_tuned").otherwise("baseline").alias("variant"),
        ((F.col("doc_id") * 7 % 11) / 10).alias("score"), (F.col("doc_id") % 4 > 0).alias("passed"), ((F.col("doc_id") % 5) / 4).alias("sanity"), (F.col("doc_id") % 5 > 2).alias("is_sane"), F.concat(F.lit("c"), F.floor(F.col("doc_id") / 6) % 2).alias("category"),
    )


def ag12_evaluation(spark, sf):
    return evaluation.summary(results(spark, sf)).withColumn("model_name", F.coalesce("model_name", F.lit("*")))


def ag11_feedback(spark, sf):
    return evaluation.feedback_targets(evaluation.deltas(results(spark, sf)))


def fn17_scores(spark, sf):
    d = docs(spark, sf)
    lint = F.when(F.col("doc_id") % 3 > 0, (F.col("doc_id") % 4) / 3)
    style = F.when(F.col("doc_id") % 2 == 0, (F.col("doc_id") % 5) / 4)
    return d.select("doc_id", evaluation.result_score((F.col("doc_id") % 6) / 5, [lint, style]).alias("score"))


def ag15_scorecard(spark, sf):
    s = samples(spark, sf)
    yaml = F.col("type") == "yaml_reference"
    plain = s.agg(
        F.count_if(F.col("instruction").rlike("class c[0-9]")).alias("malformed"), (F.count_if(yaml & (F.length("output") < 20)) / F.count_if(yaml)).alias("yaml_short_share"), (F.count_if(F.col("lang") == "en") / F.count("*")).alias("largest_share"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY length(output))").alias("p95"), F.create_map(F.lit("yaml_reference"), F.count_if(yaml & (F.trim("input") == "")) / F.count_if(yaml)).alias("empty_share"),
        F.create_map(F.lit("a"), F.count_if(F.contains("output", F.lit("license")))).alias("coverage"),
    )
    figures = plain.join(F.broadcast(metrics.duplicate_ratio(s))).join(F.broadcast(metrics.ambiguity(s).withColumnRenamed("row_ratio", "ambiguous_ratio")))
    return metrics.quality_checks(figures, 0.45, ["yaml_reference"], {"a": 3, "none": 0})


def fl22_failed_checks(spark, sf):
    return metrics.failed_checks(ag15_scorecard(spark, sf))


def sc11_metadata(spark, sf):
    made = "CASE (doc_id + place) % 4 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN concat('{\"require\": {\"drupal/core\": \"^', doc_id % 12, '\", \"php\": \">=8.', doc_id % 4, '\"}, \"require-dev\": {\"PHPUnit/phpunit\": \"*\"}}') WHEN 2 THEN '{\"require\": {\"drupal/core-recommended\": \"^11\"}}' ELSE '{\"require\": ' END"
    files = docs(spark, sf).where("doc_id is not null").selectExpr("concat('m', doc_id) AS machine_name", "doc_id", "explode(array(0, 1)) AS place").selectExpr("machine_name", "concat('b', place) AS branch", "place", f"{made} AS content")
    return projects.composer_metadata(files)


def ag13_dedup_summary(spark, sf):
    return dedup.summary(wn02_exact_dedup(spark, sf).join(docs(spark, sf).select(F.format_string("f%06d.md", "doc_id").alias("path"), F.col("text").alias("content")), "path"))


# --- sources -----------------------------------------------------------------


def sc15_storage_paths(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", crawl.storage_path("url").alias("path"))


def sc16_links(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return crawl.links(pages.select(F.regexp_replace("url", "[?#].*$", "").alias("url"), "html")).groupBy("url").agg(F.count("*").alias("n"), F.countDistinct("link").alias("n_distinct"))


def fn03_markdown(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", html.markdown("html").alias("markdown"))


NODES = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'project_' || CAST(o_orderkey AS STRING) END AS machine_name, CASE WHEN o_orderkey % 10 = 0 THEN 'Old [archived]' ELSE 'Title' END AS title, o_orderkey % 7 > 0 AS has_composer,
  CASE o_orderkey % 4 WHEN 0 THEN '^11' WHEN 1 THEN '^10' WHEN 2 THEN '11.x-dev' ELSE '^10.3 || ^11' END AS core_constraint, CASE o_orderkey % 3 WHEN 0 THEN '^8.3 || ^8.4' WHEN 1 THEN '>=8.1' ELSE '8.10' END AS language_constraint,
  o_custkey % 50 AS usage, o_orderkey % 2 AS recent, o_orderkey % 5 = 0 AS has_tests
FROM orders
"""


def nodes(spark, sf):
    return spark.sql(NODES.replace("FROM orders", "FROM {orders}"), orders=spark.read.parquet(f"{sf}/orders.parquet"))


def fl19_discovery(spark, sf):
    n = nodes(spark, sf).withColumn("reason", F.coalesce(projects.discovery_reason((8, 3), ["archived"]), F.lit("kept")))
    return n.groupBy("reason").agg(F.count("*").alias("n"))


def so01_ranking(spark, sf):
    n = nodes(spark, sf).withColumns({"core_ok": projects.core_supported(F.col("core_constraint")).cast("int"), "language_ok": projects.supports(F.col("language_constraint"), 8, 3).cast("int")}).where("machine_name <> ''")
    return projects.ranked(n.withColumn("has_tests", F.col("has_tests").cast("int")), 200).select("id", "machine_name", "core_ok", "language_ok")


def pj05_doc_samples(spark, sf):
    files = docs(spark, sf).select(F.format_string("docs/a/%d.md", "doc_id").alias("path"), F.concat(F.lit("# Title "), F.col("doc_id"), F.lit(" {#x}\n\n"), F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("content"))
    return templates.doc_sample(files).select("source", "topic", "instruction", F.md5("output").alias("h"))


def pj01_code_samples(spark, sf):
    files = docs(spark, sf).select(F.format_string("repos/mod/src/f%d.php", "doc_id").alias("path"), F.concat(F.lit(CODE + "// class Decoy\nclass Thing"), F.col("doc_id"), F.lit(" {}\n/*\n"), F.replace("text", F.lit("*/"), F.lit("")), F.lit("*/\n")).alias("content"))
    return templates.code_sample(files).select("source", "instruction", "input", "symbol_extraction_method", F.md5("output").alias("h"))


def pj06_dispatch(spark, sf):
    """Configuration, templates and code side by side, each by its suffix; other files give no sample."""
    name = F.element_at(F.array(*map(F.lit, ["%d_x.y.yml", "t-%d.html.twig", "f%d.php", "m%d.js"])), (F.col("doc_id") % 4 + 1).cast("int"))
    files = docs(spark, sf).select(F.concat(F.lit("repos/mod/"), F.replace(name, F.lit("%d"), F.col("doc_id").cast("string"))).alias("path"), F.col("text").alias("content"))
    return templates.generated(files.where("content is not null")).where("type != 'code_reference'").select("source", "instruction", "input", "type", "topic", F.md5("output").alias("h"))


def fl12_candidates(spark, sf):
    s = samples(spark, sf).withColumn("output", F.when(F.col("seq") % 2 == 0, F.concat(F.lit(" \n<?php\n"), F.col("output"))).otherwise(F.col("output"))).withColumn("chunk_total", F.when(F.col("seq") % 10 == 4, 3))
    return s.select("seq", augment.candidate_reason().alias("reason"))


def fl09_prefixes(spark, sf):
    return samples(spark, sf).where(~refine.has_prefix(["", " REPOS/src1 ", "docs/src2/"])).select("seq")


def wn13_feedback(spark, sf):
    """Candidates in order of how many weak categories they serve."""
    p = {"a": ["the\\s+of", "\\bing"], "b": ["license"], "c": []}
    return samples(spark, sf).select("seq", augment.feedback_score(["a", "b", "c", "d"], p).alias("score"))


def wn16_length(spark, sf):
    return refine.too_long(samples(spark, sf), 3000).groupBy("rejection_reason").agg(F.count("*").alias("n"), F.sum("seq").alias("s"))


def coded(spark, sf):
    """Code with what augmentation looks at, drawn from documents."""
    return docs(spark, sf).selectExpr(
        "doc_id AS seq", "'i' AS instruction", "'n' AS input", "'code_reference' AS type", "'retrieval' AS sample_type", "concat('repos/m/F', doc_id, '.php') AS source", "CASE doc_id % 4 WHEN 0 THEN 'bugfix' WHEN 1 THEN 'refactor' WHEN 2 THEN 'write_from_spec' ELSE 'explain_and_implement' END AS augmentation_type",
        "concat('<?php', chr(10), CASE WHEN doc_id % 3 = 0 THEN 'declare(strict_types=1);' ELSE '' END, chr(10), 'use A;', chr(10), 'trait T', doc_id, ' {', chr(10), CASE WHEN doc_id % 5 = 0 THEN 'public function z() {}' ELSE 'function b() {}' END, chr(10), 'function a() {}', chr(10), text) AS output",
    )


def pj12_broken(spark, sf):
    return coded(spark, sf).select("seq", augment.broken("output", 6).alias("broken"))


def pj13_augmented(spark, sf):
    return augment.augmented(coded(spark, sf), 6, 20).select("seq", "instruction", F.md5("input").alias("input"), F.md5("output").alias("output"), "sample_type")


def fl20_checks(spark, sf):
    d = docs(spark, sf).selectExpr("doc_id", "CASE doc_id % 3 WHEN 0 THEN 'service_di' WHEN 1 THEN 'sdc_component' ELSE 'other' END AS prompt", "concat(text, CASE WHEN doc_id % 2 = 0 THEN ' Services: logger.factory' ELSE ' x.component.yml' END) AS output")
    checks = augment.prompt_checks("prompt", "output")
    return d.select("doc_id", F.size(F.filter(F.map_values(checks), lambda v: v)).cast("long").alias("held"), F.round(augment.required_share(checks), 4).alias("share"))


def sc12_branches(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(augment.branches("lang", ["main", "en", "1.x", "de"]), ",").alias("branches"))


def sc19_prefixes(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", augment.default_prefix(F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("https://symfony.com/"), "page_id")).otherwise(F.col("url"))).alias("prefix"))


def ag17_fetches(spark, sf):
    f = spark.read.parquet(f"{sf}/pages.parquet").select((F.col("page_id") % 5 > 0).alias("success"), (F.col("page_id") % 3).alias("pages"))
    return crawl.fetch_rollup(f)


def st01_sets(spark, sf):
    s = samples(spark, sf)
    tests, others = s.where(refine.test_rows()), s.where(~refine.test_rows())
    return tests.select("seq", F.lit("test").alias("part")).unionByName(others.join(wn01_first_pairs(spark, sf), "seq", "left_anti").select("seq", F.lit("repeat").alias("part")))


QUERIES = {
    f.__name__: f
    for f in (
        fn01_normalize, fn05_hashes, fn07_code_blocks, fn14_format_sanity, pj18_paths, fn21_labels, fl01_gate_rules, fl01_gate, ag02_gate_report, fl10_validation, fl13_categories, fl21_audit, wn14_line_chunks, wn15_char_chunks, wn01_first_pairs,
        wn02_exact_dedup, wn03_near_dedup, wn04_ranked_dedup, wn07_split, wn08_rebalance, wn09_share_cap, wn10_quota, wn11_round_robin, wn12_grouped_split, wn17_turn_pairs, ag04_percentiles, ag05_empty_inputs, ag06_ambiguity, ag07_duplicates, ag08_concentration,
        ag12_evaluation, ag11_feedback, fn17_scores, ag15_scorecard, fl22_failed_checks, sc11_metadata, ag13_dedup_summary, sc15_storage_paths, sc16_links, fn03_markdown, fl19_discovery, so01_ranking, pj05_doc_samples, pj01_code_samples, pj06_dispatch, fl12_candidates, fl09_prefixes, wn13_feedback, wn16_length,
        pj12_broken, pj13_augmented, fl20_checks, sc12_branches, sc19_prefixes, ag17_fetches, st01_sets,
    )
}


def entry(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: rejection reasons of the gate by type."""
    return ag02_gate_report(spark, sf)


from .oracles import SQL  # noqa: E402, F401
