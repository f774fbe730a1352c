"""Records as samples: code, configuration, template, bundle and document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .augment import CODE_SUFFIXES, DEFAULT_NAMESPACE, PLACEHOLDER

DECLARED = "(?m)^\\s*(?:abstract\\s+|final\\s+)?(class|interface|trait|enum)\\s+([A-Za-z_][A-Za-z0-9_]*)"
# Texts of samples.
CODE_PROMPT = f"Show me the implementation of the %s %s in the file {PLACEHOLDER}."
YAML_PROMPT = f"Provide the Drupal 11 YAML configuration from {PLACEHOLDER}."
YAML_TASK = "Task: Return the complete Drupal 11 YAML configuration."
TWIG_PROMPT = f"Show the Twig template implementation in {PLACEHOLDER} for Drupal 11 theming."
TWIG_TASK = "Task: Return the complete Drupal 11 Twig template implementation."
DOC_SUFFIXES = [".md", ".txt", ".html"]


def without_comments(content: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(content, "(?s)/\\*.*?\\*/", ""), "(?m)(//|#(?!\\[)).*$", "")


def symbol(content: Column | str, path: Column | str) -> Column:
    """kind, name and how they were found: the only declaration outside comments, or else the path."""
    bare = without_comments(t.c(content))
    one = (F.regexp_count(bare, F.lit(DECLARED)) == 1) & F.regexp_extract(bare, DECLARED, 2).rlike("^[A-Z]\\w*$")
    stem = F.regexp_replace(t.file_hint(path), "\\.[^.]*$", "")
    return F.when(one, F.struct(F.regexp_extract(bare, DECLARED, 1).alias("kind"), F.regexp_extract(bare, DECLARED, 2).alias("name"), F.lit("declaration").alias("method"))).otherwise(
        F.struct(t.kind_from_path(path).alias("kind"), t.symbol_name(stem).alias("name"), F.lit("path_fallback").alias("method"))
    )


def namespace(content: Column | str) -> Column:
    found = F.trim(F.regexp_extract(t.c(content), "(?m)^namespace\\s+([^;]+);", 1))
    return F.when(found == "", DEFAULT_NAMESPACE).otherwise(found)


SAMPLE = ["instruction", "input", "output", "source", "type", "sample_type", "topic", "symbol_kind", "symbol_name", "symbol_extraction_method"]


def sample(files: DataFrame, kind: str, instruction: Column, tail: list[Column], **more: Column) -> DataFrame:
    """A sample of each file: its place, then the lines of tail; its content is the output."""
    head = [F.lit(f"Source file: {PLACEHOLDER}"), F.concat(F.lit("File name hint: "), t.file_hint("path")), F.concat(F.lit("Module hint: "), t.module_hint("path"))]
    found = {"instruction": instruction, "input": F.concat_ws("\n", *head, *tail), "output": F.col("content"), "source": F.col("path"), "type": F.lit(kind), "sample_type": F.lit("retrieval")} | more
    return files.select(*(found.get(c, F.lit(None).cast("string")).alias(c) for c in SAMPLE))


def code_sample(files: DataFrame, kinds: bool = True) -> DataFrame:
    """kinds: name the kind of symbol in the prompt, rather than always a class."""
    made = files.withColumn("_s", symbol("content", "path"))
    kind, name = F.col("_s.kind"), F.col("_s.name")
    target = [F.concat(F.lit("Target symbol: "), kind, F.lit(" "), name), F.concat(F.lit("Namespace: "), namespace("content"))]
    prompt = F.format_string(CODE_PROMPT, kind if kinds else F.lit("class"), name)
    return sample(made, "code_reference", prompt, target, symbol_kind=kind, symbol_name=name, symbol_extraction_method=F.col("_s.method"))


def stem(path: Column | str) -> Column:
    """The file's name without its last suffix."""
    return F.regexp_replace(t.file_hint(path), "(?<=.)\\.[^.]+$", "")


def yaml_sample(files: DataFrame) -> DataFrame:
    topic = F.replace(stem("path"), F.lit("_"), F.lit(" "))
    return sample(files, "yaml_reference", F.lit(YAML_PROMPT), [F.concat(F.lit("Configuration topic: "), topic), F.lit(YAML_TASK)], topic=topic)


def twig_sample(files: DataFrame) -> DataFrame:
    return sample(files, "twig_reference", F.lit(TWIG_PROMPT), [F.lit(TWIG_TASK)])


def generated(files: DataFrame) -> DataFrame:
    """The samples of all files, each by the template of its suffix; files of other suffixes give none."""
    low = t.suffix("path")
    docs = doc_sample(files.where(low.isin(DOC_SUFFIXES)))
    code = code_sample(files.where(low.isin(CODE_SUFFIXES)))
    return code.unionByName(yaml_sample(files.where(low == ".yml"))).unionByName(twig_sample(files.where(low == ".twig"))).unionByName(docs, allowMissingColumns=True)


def title(content: Column | str, path: Column | str) -> Column:
    """The first heading, or the first line that isn't blank, or the file's stem; without anchors."""
    x = t.c(content)
    heading = F.regexp_extract(x, "(?m)^#\\s+(.+)$", 1)
    first = F.regexp_replace(F.regexp_extract(x, "(?m)^\\s*(\\S.*)$", 1), "^[# ]+|[# ]+$", "")
    stem = F.regexp_replace(t.file_hint(path), "\\.[^.]*$", "")
    found = F.when(heading != "", heading).when(first != "", first).otherwise(stem)
    return t.strip(F.regexp_replace(found, "\\{#[^}]*\\}", ""))


def paragraphs(content: Column | str, least: int = 50) -> Column:
    """Paragraphs of some length that are no heading, link list or table; links as their text."""
    parts = F.transform(F.split(t.c(content), "\\n\\s*\\n"), t.strip)
    good = F.filter(parts, lambda p: (F.length(p) >= least) & ~p.startswith("#") & (F.regexp_count(p, F.lit("http")) < 2) & ~p.startswith("|"))
    return F.transform(good, lambda p: F.regexp_replace(p, "\\[([^\\]]+)\\]\\([^)]*\\)", "$1"))


def doc_output(content: Column | str, named: Column, most: int = 6, cap: int = 6000) -> Column:
    body = paragraphs(content)
    text = F.when(F.size(body) > 0, F.array_join(F.slice(body, 1, most), "\n\n")).otherwise(F.left(t.c(content), F.lit(cap)))
    return t.strip(F.left(F.concat(F.lit("Topic: "), named, F.lit("\n\n"), text), F.lit(cap)))


def doc_sample(files: DataFrame, least: int = 120) -> DataFrame:
    made = files.withColumn("topic", title("content", "path"))
    made = made.withColumn("output", doc_output("content", F.col("topic"))).where((F.length("topic") >= 5) & (F.length("output") >= least))
    return made.select(F.concat(F.lit("Explain the following topic: "), F.col("topic")).alias("instruction"), F.concat(F.lit("Source: "), t.file_hint("path")).alias("input"), "output", F.col("path").alias("source"), F.lit("doc_summary").alias("type"), "topic")


def component_pairs(files: DataFrame) -> DataFrame:
    """Configuration and template files of one component: the first candidate path that is there.

    x.component.yml goes with x.twig; component.yml with component.twig or a template named like its folder.
    """
    yml = files.where(F.col("path").endswith(".component.yml") | (t.file_hint("path") == "component.yml")).select(F.col("path").alias("yaml_path"), F.col("content").alias("yaml"))
    folder = F.regexp_extract("yaml_path", "^(.*/)[^/]*$", 1)
    parent = F.try_element_at(F.split(folder, "/"), F.lit(-2))
    plain = t.file_hint("yaml_path") == "component.yml"
    named = F.array(F.regexp_replace("yaml_path", "\\.component\\.yml$", ".twig"))
    same = F.array_compact(F.array(F.concat(folder, F.lit("component.twig")), F.when(F.coalesce(parent, F.lit("")) != "", F.concat(folder, parent, F.lit(".twig")))))
    tries = F.when(plain, same).otherwise(named)
    twigs = files.where(F.col("path").endswith(".twig")).select(F.col("path").alias("twig_path"), F.col("content").alias("twig"))
    found = yml.select("yaml_path", "yaml", F.posexplode(tries).alias("rank", "twig_path")).join(twigs, "twig_path")
    return found.groupBy("yaml_path").agg(F.min_by(F.struct("yaml", "twig_path", "twig"), "rank").alias("m")).select("yaml_path", "m.*")


BUNDLES = ["files_bundle", "structure_and_files", "files_and_usage", "files_and_contract"]


def bundle_samples(pairs: DataFrame, variants: int = 4) -> DataFrame:
    name = F.regexp_replace(t.file_hint("yaml_path"), "\\.component\\.yml$", "")
    files = F.concat(F.lit("# "), t.file_hint("yaml_path"), F.lit("\n"), F.col("yaml"), F.lit("\n\n# "), t.file_hint("twig_path"), F.lit("\n"), F.col("twig"))
    some = F.slice(F.array(*map(F.lit, BUNDLES)), 1, max(1, variants))
    return pairs.select(F.explode(some).alias("variant"), F.col("yaml_path").alias("source"), F.col("twig_path").alias("related_template"), name.alias("symbol_name"), files.alias("output")).withColumn("instruction", F.format_string("Create the component %s (%s).", "symbol_name", "variant"))
