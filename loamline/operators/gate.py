"""The quality gate: an ordered cascade of rules that names the first one a sample fails.

Two rules look at what was accepted before: an output must be new, and a pair of
instruction and input may have so many outputs. Both are settled in rounds.
A row is accepted once no undecided row stands before it in its output's group
and fewer undecided rows than there are places left in its pair's; rows that
this blocks are out; the rest goes to the next round. That gives the order-
dependent result without a sequential pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..plans.shared import cut

# Word lists that decide results.
BOILERPLATE = ["cookie", "yes, please", "no, do not track me", "sign in", "log in", "create an account"]
GENERIC_TOPICS = ["contents of this file", "introduction", "readme", "license", "requirements", "installation", "configuration", "for developers", "description", "features", "support", "author", "maintainers", "copyright", "how it works", "prerequisites", "gnu general public license"]
IRRELEVANT_TOPICS = ["cookie", "web beacon", "sign in"]
OLD_VERSION, NEW_VERSIONS = "drupal 7", ["drupal 8", "drupal 9", "drupal 10", "drupal 11", "symfony"]
PROCEDURAL_SUFFIXES = [".module", ".install", ".inc", ".theme", ".profile"]
PROCEDURAL_FILES = ["index.php", "update.php", "autoload.php", ".ht.router.php", "authorize.php", "cron.php", "rebuild.php"]
SYMBOL_PROMPT = "^Show me the implementation of the (class|interface|trait|enum) ([A-Za-z_][A-Za-z0-9_]*) in the file (.+)\\.$"


@dataclass
class GateConfig:
    min_chars: int = 150
    max_chars: int = 50000
    min_by_type: dict = field(default_factory=dict)
    max_by_type: dict = field(default_factory=dict)
    leak_tokens: list = field(default_factory=lambda: ["repos/"])
    max_streak: int = 40
    max_repeated: float = 0.25
    normalise_hash: bool = False
    outputs_per_pair: int = 1
    need_input: list = field(default_factory=list)
    doc_sources: list = field(default_factory=list)
    denied_topics: list = field(default_factory=list)


def limit_of(kind: Column, default: int, by_type: dict) -> Column:
    out = F.lit(default)
    for name, n in by_type.items():
        out = F.when(kind == name, F.lit(n)).otherwise(out)
    return out


def any_of(tests: list[Column]) -> Column:
    out = F.lit(False)
    for x in tests:
        out = out | x
    return out


def procedural(source: Column) -> Column:
    base = F.lower(t.file_hint(source))
    return any_of([F.lower(source).endswith(s) for s in PROCEDURAL_SUFFIXES]) | base.isin(PROCEDURAL_FILES)


def first_failed(rules: list[tuple[Column, str]]) -> Column:
    """The reason of the first rule that holds. Nulls don't hold."""
    return F.coalesce(*(F.when(test, F.lit(reason)) for test, reason in rules))


def reasons_before(cfg: GateConfig) -> Column:
    """Rules between the two that look back. Columns: instruction, input, output, type, source, topic."""
    out, ins, kind, source = F.col("output"), F.lower("instruction"), F.coalesce("type", F.lit("unknown")), F.coalesce("source", F.lit(""))
    yaml, doc = kind == "yaml_reference", kind == "doc_summary"
    facing = F.lower(F.concat_ws("\n", "instruction", "input", "output"))
    allowed = any_of([F.lower(source).startswith(p) for p in cfg.doc_sources]) if cfg.doc_sources else F.lit(True)
    return first_failed([
        (kind.isin(cfg.need_input) & (t.strip("input") == ""), "missing_context_input") if cfg.need_input else (F.lit(False), ""),
        (yaml & (~F.contains(ins, F.lit("yaml configuration")) | ~F.contains(out, F.lit(":")) | F.contains(out, F.lit("<?php"))), "yaml_instruction_output_mismatch"),
        (doc & (~ins.startswith("explain the following topic") | (t.letters(out) < 80)), "doc_instruction_output_mismatch"),
        (doc & any_of([F.contains(F.lower(t.strip("topic")), F.lit(x)) for x in cfg.denied_topics]), "doc_topic_denied"),
        (doc & ~allowed, "doc_source_not_allowed"),
        (F.length(out) < limit_of(kind, cfg.min_chars, cfg.min_by_type), "too_short"),
        (F.length(out) > limit_of(kind, cfg.max_chars, cfg.max_by_type), "too_long"),
        (t.wrapper_echo(out), "prompt_wrapper_echo"),
        (any_of([F.contains(facing, F.lit(x)) for x in cfg.leak_tokens if x]), "path_leakage_token"),
        (t.numeric_streak(out) >= cfg.max_streak, "numeric_line_streak"),
        (t.repeated_line_ratio(out) >= cfg.max_repeated, "repetitive_output"),
        (t.numeric_fence(out), "numeric_code_block_artifact"),
    ])


def reasons_after() -> Column:
    out, ins, source = F.col("output"), F.lower("instruction"), F.coalesce("source", F.lit(""))
    topic = F.lower(t.strip(F.substring_index("instruction", ":", -1)))
    on_topic = F.contains(ins, F.lit("explain the following topic"))
    low = F.lower(out)
    full = F.filter(F.split(out, "\n"), lambda v: t.strip(v) != "")
    return first_failed([
        (any_of([F.contains(F.left(low, F.lit(200)), F.lit(x)) for x in BOILERPLATE]), "boilerplate_content"),
        (F.col("instruction").startswith("Show me the implementation of") & ~F.col("instruction").rlike(SYMBOL_PROMPT), "invalid_symbol_kind_prompt"),
        (on_topic & (F.length(topic) < 6), "poor_instruction"),
        (on_topic & topic.isin(GENERIC_TOPICS), "generic_topic"),
        (on_topic & any_of([F.contains(topic, F.lit(x)) for x in IRRELEVANT_TOPICS]), "irrelevant_topic"),
        ((F.size(full) < 3) & (F.length(out) < 500), "insufficient_detail"),
        ((F.col("type") == "doc_summary") & F.contains(low, F.lit(OLD_VERSION)) & ~any_of([F.contains(low, F.lit(x)) for x in NEW_VERSIONS]), "drupal_7_only"),
        (F.contains(out, F.lit("<?php")) & ~F.contains(out, F.lit("namespace")) & ~F.contains(out, F.lit("hook_")) & ~procedural(source), "missing_namespace_in_php"),
    ])


def stateless(samples: DataFrame, cfg: GateConfig | None = None) -> DataFrame:
    """samples with ``before`` and ``after``: the first failed rule on either side of the output's novelty."""
    return samples.withColumns({"before": reasons_before(cfg or GateConfig()), "after": reasons_after()})


def gated(samples: DataFrame, cfg: GateConfig | None = None) -> DataFrame:
    """samples (with seq) and their ``rejection_reason``, null for accepted ones."""
    cfg = cfg or GateConfig()
    n = cfg.outputs_per_pair
    keyed = stateless(samples, cfg).withColumns({"_hash": t.output_hash("output", cfg.normalise_hash), "_pair": F.sha2(F.concat_ws("\x00", t.strip("instruction"), t.strip("input")), 256)})
    keyed = cut(keyed)
    left = keyed.where("before is null and after is null").select("seq", "_hash", "_pair")
    accepted = cut(left.limit(0))
    while left.limit(1).count():
        used = accepted.groupBy("_pair").agg(F.count("*").alias("_used"))
        ranked = left.join(used, "_pair", "left").select(
            "seq", "_hash", "_pair", F.row_number().over(Window.partitionBy("_hash").orderBy("seq")).alias("_h"), F.row_number().over(Window.partitionBy("_pair").orderBy("seq")).alias("_p"), F.coalesce("_used", F.lit(0)).alias("_used")
        )
        now = ranked.where((F.col("_h") == 1) & ((F.col("_p") + F.col("_used") <= n) if n > 0 else F.lit(True))).select("seq", "_hash", "_pair")
        accepted = cut(accepted.unionByName(now))
        rest = left.join(accepted.select("_hash"), "_hash", "left_anti")
        if n > 0:
            full = accepted.groupBy("_pair").count().where(F.col("count") >= n).select("_pair")
            rest = rest.join(full, "_pair", "left_anti")
        left = cut(rest)
    pair = Window.partitionBy("_pair").orderBy("seq")
    full_at = accepted.withColumn("_n", F.row_number().over(pair)).where(F.col("_n") == max(n, 1)).select("_pair", F.col("seq").alias("_full"))
    same_pair = accepted.select("_pair", "_hash", F.col("seq").alias("_own"))
    same_hash = accepted.select("_hash", F.col("seq").alias("_first"))
    joined = keyed.join(full_at, "_pair", "left").join(same_pair, ["_pair", "_hash"], "left").join(same_hash, "_hash", "left")
    ambiguous = (F.col("_full") < F.col("seq")) & ~F.coalesce(F.col("_own") < F.col("seq"), F.lit(False)) if n > 0 else F.lit(False)
    reason = F.coalesce(F.when(ambiguous, "ambiguous_instruction_input_pair"), "before", F.when(F.col("_first") < F.col("seq"), "near_duplicate_content"), "after")
    return joined.select(*samples.columns, reason.alias("rejection_reason"))
