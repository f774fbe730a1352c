"""Scores of outputs, and fine-tuned against baseline results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def avg4(x: Column) -> Column:
    return F.round(F.coalesce(F.avg(x), F.lit(0.0)), 4)


def result_score(required: Column, lints: list[Column], weight: float = 0.1) -> Column:
    """Share of required checks, of which each active linter (not null) takes the weight for its own share."""
    active = sum((F.when(x.isNotNull(), weight).otherwise(0.0) for x in lints), F.lit(0.0))
    product = F.lit(1.0)
    for x in lints:
        product = product * F.coalesce(x, F.lit(1.0))
    return F.round(required * (1 - active) + product * active, 4)


def deltas(results: DataFrame) -> DataFrame:
    """Fine-tuned results with the baseline of the same model and prompt; of several baselines the last."""
    base = results.where("variant = 'baseline'").groupBy("model_name", "prompt_id").agg(F.max_by("score", "seq").alias("baseline_score"))
    fine = results.where("variant = 'fine_tuned'")
    return fine.join(base, ["model_name", "prompt_id"]).withColumn("delta", F.round(F.col("score") - F.col("baseline_score"), 4))


def summary(results: DataFrame) -> DataFrame:
    """One row for each model, and one for all (null)."""
    fine, base = F.col("variant") == "fine_tuned", F.col("variant") == "baseline"
    of = lambda side, x: avg4(F.when(side, x))
    per = results.rollup("model_name").agg(
        of(fine, F.col("score")).alias("fine_tuned_avg_score"), of(base, F.col("score")).alias("baseline_avg_score"), of(fine, F.col("passed").cast("double")).alias("fine_tuned_pass_rate"), of(base, F.col("passed").cast("double")).alias("baseline_pass_rate"),
        of(fine, F.col("sanity")).alias("fine_tuned_format_sanity_avg"), of(base, F.col("sanity")).alias("baseline_format_sanity_avg"),
        of(fine, (~F.col("is_sane")).cast("double")).alias("fine_tuned_format_sanity_fail_rate"), of(base, (~F.col("is_sane")).cast("double")).alias("baseline_format_sanity_fail_rate"),
    )
    d = deltas(results).rollup("model_name").agg(F.count_if(F.col("delta") > 0).alias("fine_tuned_wins"), F.count_if(F.col("delta") < 0).alias("baseline_wins"), F.count_if(F.col("delta") == 0).alias("ties"))
    d = d.withColumnRenamed("model_name", "_m")
    out = per.join(d, per["model_name"].eqNullSafe(d["_m"]), "left").drop("_m").fillna(0, ["fine_tuned_wins", "baseline_wins", "ties"])
    return out.withColumns({"delta_avg_score": F.round(F.col("fine_tuned_avg_score") - F.col("baseline_avg_score"), 4), "delta_format_sanity_avg": F.round(F.col("fine_tuned_format_sanity_avg") - F.col("baseline_format_sanity_avg"), 4)})


def feedback_targets(changes: DataFrame) -> DataFrame:
    """Categories that became worse, the worst first."""
    return changes.where("delta < 0").groupBy("category").agg(F.count("*").alias("n"), F.round(F.avg("delta"), 4).alias("avg_delta")).orderBy("avg_delta", "category")
