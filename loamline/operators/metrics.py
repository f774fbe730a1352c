"""Figures about a set of samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t


def nearest_rank(df: DataFrame, value: str, ps: list[float], by: list[str] | None = None) -> DataFrame:
    """For each p the element ``floor((n - 1) p)`` of the sorted values, from counts of distinct values; 0 for none."""
    from pyspark.sql import Window

    by = by or []
    counts = df.groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*by)
    ranked = counts.select(*by, "_v", F.sum("_n").over(whole.orderBy("_v")).alias("_upto"), F.sum("_n").over(whole).alias("_all"))
    picks = [F.min(F.when(F.col("_upto") > F.floor((F.col("_all") - 1) * p), F.col("_v"))).alias(f"p{round(p * 100)}") for p in ps]
    return ranked.groupBy(*by).agg(*picks)


def empty_input_share(samples: DataFrame) -> DataFrame:
    return samples.groupBy("type").agg(F.round(F.avg((t.strip(F.coalesce("input", F.lit(""))) == "").cast("double")), 4).alias("empty_share"))


def ambiguity(samples: DataFrame) -> DataFrame:
    keyed = samples.select(t.strip("instruction").alias("a"), t.strip("input").alias("b"), t.output_hash("output", True).alias("h"))
    pairs = keyed.groupBy("a", "b").agg(F.countDistinct("h").alias("outputs"), F.count("*").alias("n"))
    many = F.col("outputs") > 1
    rows = F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0))
    return pairs.agg(F.count_if(many).alias("pairs"), rows.alias("rows"), F.round(F.coalesce(F.try_divide(rows, F.sum("n")), F.lit(0.0)), 4).alias("row_ratio"))


def duplicate_ratio(samples: DataFrame) -> DataFrame:
    per = samples.groupBy(t.output_hash("output", True).alias("h")).agg(F.count("*").alias("n"))
    return per.agg(F.round(F.coalesce(F.try_divide(F.sum(F.col("n") - 1), F.sum("n")), F.lit(0.0)), 4).alias("duplicate_ratio"))


def concentration(samples: DataFrame, bucket: Column, top: int = 10) -> DataFrame:
    counts = samples.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.join(F.broadcast(total)).select("bucket", "n", F.round(F.col("n") / F.col("_total"), 4).alias("share")).orderBy(F.desc("n"), "bucket").limit(top)


def reasons_report(gated: DataFrame) -> DataFrame:
    """Counts by type and reason, by reason, by type and in all, in one pass."""
    return gated.rollup("type", "rejection_reason").agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def split_sizes(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("n"))


def pass_rate(gated: DataFrame) -> DataFrame:
    return gated.agg(F.count("*").alias("n"), F.count_if(F.col("rejection_reason").isNull()).alias("passed"), F.round(F.coalesce(F.try_divide(F.count_if(F.col("rejection_reason").isNull()), F.count("*")), F.lit(0.0)), 4).alias("pass_rate"))


def artifact_audit(rows: DataFrame, most_streak: int, most_repeated: float) -> DataFrame:
    streak, repeated, fence = t.numeric_streak("output") > most_streak, t.repeated_line_ratio("output") > most_repeated, t.numeric_fence("output")
    out = rows.agg(F.count("*").alias("n"), F.count_if(streak).alias("numeric_line_streak"), F.count_if(repeated).alias("repetitive_output"), F.count_if(fence).alias("numeric_code_block"), F.count_if(streak | repeated | fence).alias("failing"))
    return out.withColumn("passed", F.col("failing") == 0)


def quality_checks(figures: DataFrame, most_share: float, need_input: list[str], targets: dict[str, int]) -> DataFrame:
    """The eight checks of a refined set on one row of figures, and whether all hold.

    figures: malformed, yaml_short_share, largest_share, p95, ambiguous_ratio, duplicate_ratio, and the maps
    empty_share (by type) and coverage (by category). Types and categories that a map lacks count 0.
    """
    def figure(of: str, key: str) -> Column:
        return F.coalesce(F.try_element_at(of, F.lit(key)), F.lit(0))

    made = {
        # Fixed values.
        "malformed_instruction_class_slot": F.col("malformed") <= 50,
        "yaml_too_short_share": F.col("yaml_short_share") <= 0.10,
        "drupal_core_train_share": F.col("largest_share") <= most_share,
        "train_output_p95": F.col("p95") <= 9000,
        "ambiguous_pair_ratio": F.col("ambiguous_ratio") <= 0.01,
        "normalized_output_duplicate_ratio": F.col("duplicate_ratio") <= 0.01,
        "empty_input_share_by_type": every([figure("empty_share", k) <= 0.01 for k in need_input]),
        "weak_category_coverage": every([figure("coverage", k) >= n for k, n in targets.items()]),
    }
    out = figures.select(*(F.coalesce(v, F.lit(False)).alias(k) for k, v in made.items()))
    return out.withColumn("overall_passed", every([F.col(k) for k in made]))


def every(tests: list[Column]) -> Column:
    out = F.lit(True)
    for x in tests:
        out = out & x
    return out


def failed_checks(card: DataFrame) -> DataFrame:
    """Names of the checks that a scorecard fails; a set with any must not be trained on."""
    names = [c for c in card.columns if c != "overall_passed"]
    return card.select(F.explode(F.array_compact(F.array(*(F.when(~F.col(c), F.lit(c)) for c in names)))).alias("failed"))


def scorecard(values: DataFrame, checks: dict[str, tuple[str, str, float]]) -> DataFrame:
    """One row of figures held against limits: name -> (column, '<=' or '>=', limit); and whether all hold."""
    made = {name: (F.col(col) <= limit) if op == "<=" else (F.col(col) >= limit) for name, (col, op, limit) in checks.items()}
    out = values.select(*(F.coalesce(v, F.lit(False)).alias(k) for k, v in made.items()))
    every = F.lit(True)
    for k in made:
        every = every & F.col(k)
    return out.withColumn("overall_passed", every)
