"""Tables in the folder that driver and executors share, which cut the lineage of rounds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, beside the warehouse on a cluster and a temporary folder in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="loamline-") if spark.sparkContext.master.startswith("local[") else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return _own[app]


def cut(df: DataFrame) -> DataFrame:
    """df, written and read again."""
    spark, schema = df.sparkSession, df.schema
    path = f"{folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
