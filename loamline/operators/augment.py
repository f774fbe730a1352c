"""Augmented samples, noise in documents, checks of prompts, branches and prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .gate import any_of
from .refine import DECLARATION, matches, symbol_kind, test_rows

# Texts that decide results.
PLACEHOLDER, DEFAULT_NAMESPACE = "<source_file>", "Drupal\\Custom"
CODE_SUFFIXES = [".php", ".module", ".inc", ".install", ".theme"]
SWAPS = [("declare(strict_types=1);", "declare(strict_types=0);"), ("public function ", "function "), ("protected function ", "function "), ("#[", "[")]
BUG_NOTE = "\n// BUG: ensure this implementation follows Drupal 11 and PHP 8.3."
REQUIREMENTS = ["- Use Drupal 11 and PHP 8.3 compatible patterns.", "- Provide a complete %s implementation for %s."]
PLAN = "- Follow Drupal 11 architecture and PHP 8.3 typing.\n- Preserve expected behavior and APIs from the specification.\n- Keep implementation concise and production-ready.\n\n"
INSTRUCTIONS = {
    "bugfix": "Fix this broken Drupal 11 %s implementation and return corrected PHP code.",
    "refactor": "Refactor this Drupal 11 %s for readability and maintainability while preserving behavior.",
    "write_from_spec": "Implement this Drupal 11 component from the specification. Return complete PHP code.",
    "explain_and_implement": "Explain the implementation plan in up to 3 bullet points, then provide the complete Drupal 11 PHP implementation.",
}
CHECKS = {
    "block_attribute": {"has_php_tag": ["<?php"], "uses_block_attribute": ["#[Block"], "contains_block_id": ["~gym_stats"], "contains_block_label": ["~gym statistics"]},
    "service_di": {"has_services_yaml": ["~services:"], "references_logger_factory": ["~logger.factory"], "has_constructor": ["__construct("], "uses_injected_logger": ["~logger"]},
    "routing_yaml": {"mentions_routing_yml": ["~routing.yml"], "contains_path": ["~/gym/stats"], "contains_controller": ["~controller"]},
    "sdc_component": {"mentions_component_yml": ["~component.yml"], "mentions_components_directory": ["~components/", "~/components"], "mentions_template": ["~.twig", "~template"]},
}
NOT_REQUIRED = {"uses_injected_logger", "mentions_template"}
PREFIXES = [("symfony.com", "https://symfony.com/doc/7.0/"), ("drupal.org/docs", "https://www.drupal.org/docs/develop"), ("api.drupal.org", "https://api.drupal.org/api/drupal"), ("drupal.org/security", "https://www.drupal.org/security")]


def excerpt(output: Column | str, n: int) -> Column:
    return F.array_join(F.slice(t.lines(output), 1, max(1, n)), "\n")


def first_replaced(x: Column, old: str, new: str) -> Column:
    at = F.instr(x, old)
    return F.concat(x.substr(F.lit(1), at - 1), F.lit(new), x.substr(at + len(old), F.length(x)))


def broken(output: Column | str, n: int) -> Column:
    """The first lines with the first swap that applies made once; a note if none does."""
    x = excerpt(output, n)
    return F.coalesce(*(F.when(F.contains(x, F.lit(old)), first_replaced(x, old, new)) for old, new in SWAPS), F.concat(x, F.lit(BUG_NOTE)))


def symbol(output: str = "output", source: str = "source") -> tuple[Column, Column]:
    found = F.regexp_extract(output, DECLARATION, 2)
    base = t.file_hint(source)
    return symbol_kind(output, source), F.when(found != "", found).when(base == "", "UnknownSymbol").otherwise(F.regexp_replace(base, "\\.php$", ""))


def file_name(source: str = "source") -> Column:
    return F.when(t.file_hint(source) == "", "unknown.php").otherwise(t.file_hint(source))


def spec() -> Column:
    """Target, namespace and requirements; up to 8 imports in order and 12 distinct methods by name."""
    kind, name = symbol()
    found = F.trim(F.regexp_extract("output", "(?m)^namespace\\s+([^;]+);", 1))
    uses = F.slice(F.regexp_extract_all("output", F.lit("(?m)^use\\s+([^;]+);"), F.lit(1)), 1, 8)
    methods = F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all("output", F.lit("\\bfunction\\s+([A-Za-z_][A-Za-z0-9_]*)\\s*\\("), F.lit(1)))), 1, 12)
    part = lambda head, items, line: F.when(F.size(items) > 0, F.concat(F.lit(head + "\n"), F.array_join(F.transform(items, line), "\n")))
    return F.concat_ws(
        "\n", F.lit(f"Source file: {PLACEHOLDER}"), F.concat(F.lit("File name hint: "), file_name()), F.format_string("Target symbol: %s %s", kind, name), F.concat(F.lit("Namespace: "), F.when(found != "", found).otherwise(DEFAULT_NAMESPACE)),
        F.lit("Requirements:"), F.lit(REQUIREMENTS[0]), F.format_string(REQUIREMENTS[1], kind, name), part("- Include required imports:", uses, lambda x: F.concat(F.lit("  - "), x)), part("- Ensure these methods exist where relevant:", methods, lambda x: F.concat(F.lit("  - "), x, F.lit("()"))),
    )


def augmented(samples: DataFrame, excerpt_lines: int = 40, most_lines: int = 300) -> DataFrame:
    """samples (with augmentation_type) as tasks of that kind."""
    kind, name = symbol()
    of = F.col("augmentation_type")
    head = F.format_string(f"Symbol: %s\nSource file: {PLACEHOLDER}\nFile name hint: %s\n", name, file_name())
    ins = F.when(of == "bugfix", F.format_string(INSTRUCTIONS["bugfix"], kind)).when(of == "refactor", F.format_string(INSTRUCTIONS["refactor"], kind)).when(of == "write_from_spec", INSTRUCTIONS["write_from_spec"]).otherwise(INSTRUCTIONS["explain_and_implement"])
    inp = F.when(of == "bugfix", F.concat(head, F.lit("Broken snippet:\n"), broken("output", excerpt_lines))).when(of == "refactor", F.concat(head, F.lit("Current implementation:\n"), excerpt("output", excerpt_lines))).otherwise(spec())
    whole = F.when(of.isin("bugfix", "refactor", "write_from_spec"), F.col("output")).otherwise(F.concat(F.lit(PLAN), F.col("output")))
    out = F.when(F.size(t.lines(whole)) > most_lines, excerpt(whole, most_lines)).otherwise(whole)
    new = {"instruction": ins, "input": inp, "output": out, "sample_type": of}
    return samples.select(*(new.get(c, F.col(c)).alias(c) for c in samples.columns))


def prompt_checks(prompt: Column | str, output: Column | str) -> Column:
    """A map of the prompt's checks; unknown prompts only ask for some output."""
    x = t.c(output)
    holds = lambda s: F.contains(F.lower(x), F.lit(s[1:])) if s[0] == "~" else F.contains(x, F.lit(s))
    some = [F.lit("non_empty_output"), t.strip(x) != ""]
    out = F.create_map(*some)
    for name, checks in CHECKS.items():
        made = list(some)
        for check, terms in checks.items():
            test = holds(terms[0])
            for s in terms[1:]:
                test = test | holds(s)
            made += [F.lit(check), test]
        out = F.when(t.c(prompt) == name, F.create_map(*made)).otherwise(out)
    return out


def required_share(checks: Column | str) -> Column:
    needed = F.map_filter(t.c(checks), lambda k, v: ~k.isin(*NOT_REQUIRED))
    return F.size(F.filter(F.map_values(needed), lambda v: v)) / F.size(needed)


def without_noise(content: Column | str) -> Column:
    """Documents without badge menus, lists of other branches and main menus."""
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("skip"))

    def step(a: Column, raw: Column) -> Column:
        line, bare = t.rstrip(raw), t.strip(raw)
        low = F.lower(bare)
        mark = low == "same name and namespace in other branches"
        gone = bare.rlike("^(\\[!\\[|!\\[)") | bare.rlike("^\\d+(\\.\\d+)*\\.x ") | low.startswith("main menu")
        blank = a["skip"] & (bare == "")
        return F.struct(F.when(mark | gone | blank, a["out"]).otherwise(F.concat(a["out"], F.array(line))).alias("out"), F.when(mark, True).when(gone, a["skip"]).when(blank, False).otherwise(a["skip"]).alias("skip"))

    return t.strip(F.regexp_replace(F.aggregate(t.lines(content), zero, step, lambda a: F.array_join(a["out"], "\n")), "\n{3,}", "\n\n"))


def branches(default: Column | str, fallbacks: list[str]) -> Column:
    return F.array_distinct(F.filter(F.concat(F.array(t.c(default)), F.array(*map(F.lit, fallbacks))), lambda x: x.isNotNull()))


def default_prefix(url: Column | str) -> Column:
    out = t.c(url)
    for term, prefix in reversed(PREFIXES):
        out = F.when(F.contains(t.c(url), F.lit(term)), prefix).otherwise(out)
    return out


def candidate_reason() -> Column:
    """Why a sample can't be augmented, by source, output and chunk_total; null if it can."""
    source = F.lower(F.trim(t.c("source")))
    return (
        F.when(test_rows("source"), "augmentation_from_test_source").when(~any_of([source.endswith(x) for x in CODE_SUFFIXES]), "augmentation_non_php_source")
        .when(~F.regexp_replace(t.c("output"), "^\\s+", "").startswith("<?php"), "augmentation_non_php_output").when(F.coalesce("chunk_total", F.lit(1)) > 1, "augmentation_chunked_source")
    )


def feedback_score(weak: list[str], patterns: dict[str, list[str]] | None = None) -> Column:
    """How many weak categories a sample belongs to."""
    out = F.lit(0)
    for category in weak:
        out = out + matches(category, patterns).cast("int")
    return out
