"""Candidate projects: fields of semi-structured nodes, version constraints, ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gate import any_of, first_failed


def field(node: Column, *names: str) -> Column:
    """The first of the fields that is there, plain or as {"value": ...}."""
    return F.coalesce(*(x for n in names for x in (F.get_json_object(node, f"$.{n}.value"), F.when(~F.coalesce(F.get_json_object(node, f"$.{n}"), F.lit("{")).startswith("{"), F.get_json_object(node, f"$.{n}")))))


def composer_metadata(files: DataFrame) -> DataFrame:
    """Constraints of each project from the first of its branches whose file is there.

    files: machine_name, branch, place (order of preference) and content, null or empty where the branch has no file.
    A first file that isn't a JSON object gives nulls: later branches aren't looked at.
    """
    there = files.where(F.coalesce(F.length("content"), F.lit(0)) > 0)
    first = there.groupBy("machine_name").agg(F.min_by(F.struct("branch", "content"), "place").alias("f")).select("machine_name", "f.*")
    wide = F.try_parse_json("content")
    read = first.withColumns({"_v": wide, "_map": F.try_variant_get(wide, "$", "map<string,variant>")})
    part = lambda name: F.try_variant_get("_v", f"$['{name}']", "map<string,variant>")
    value = lambda m, key: F.nullif(F.try_variant_get(F.try_element_at(m, F.lit(key)), "$", "string"), F.lit(""))
    need, dev = part("require"), part("require-dev")
    tests = F.exists(F.coalesce(F.map_keys(dev), F.array().cast("array<string>")), lambda k: F.contains(F.lower(k), F.lit("phpunit")))
    return read.select(
        "machine_name", F.when(F.col("_map").isNotNull(), F.col("branch")).alias("branch"), F.coalesce(value(need, "drupal/core"), value(need, "drupal/core-recommended")).alias("core_constraint"),
        value(need, "php").alias("php_constraint"), F.when(F.col("_map").isNotNull(), tests).alias("has_tests"),
    )


def core_supported(constraint: Column, major: int = 11) -> Column:
    return F.coalesce(constraint.rlike(f"(^|[^0-9])\\^?{major}(\\.|$)"), F.lit(False))


def least_version(constraint: Column) -> Column:
    """The smallest major.minor pair that is named."""
    pairs = F.regexp_extract_all(constraint, F.lit("([0-9]+)\\.([0-9]+)"), F.lit(0))
    return F.array_min(F.transform(pairs, lambda p: F.struct(F.split(p, "\\.")[0].cast("int").alias("a"), F.split(p, "\\.")[1].cast("int").alias("b"))))


def supports(constraint: Column, a: int, b: int) -> Column:
    return F.coalesce(least_version(constraint) >= F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")), F.lit(False))


def archived(title: Column, name: Column, markers: list[str]) -> Column:
    text = F.lower(F.concat_ws(" ", title, name))
    return any_of([F.contains(text, F.lit(m)) for m in markers])


def discovery_reason(min_version: tuple[int, int], markers: list[str], core: int = 11) -> Column:
    """Columns: machine_name, title, has_composer, core_constraint, language_constraint."""
    return first_failed([
        (F.coalesce("machine_name", F.lit("")) == "", "missing_machine_name"), (archived(F.col("title"), F.col("machine_name"), markers), "archived_or_security_only"), (~F.col("has_composer"), "missing_composer"),
        (~core_supported(F.col("core_constraint"), core), "core_not_drupal11"), (~supports(F.col("language_constraint"), *min_version), "php_constraint_too_low"),
    ])


def ranked(projects: DataFrame, k: int) -> DataFrame:
    """Core and language support, recent, tests, usage, name, all descending; a top-k without a full sort."""
    return projects.orderBy(*(F.desc(c) for c in ("core_ok", "language_ok", "recent", "has_tests", "usage", "machine_name"))).limit(k)
