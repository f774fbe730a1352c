"""Scans and sinks: lines with their place, trees of files, samples as JSON lines, indexes and manifests."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t

SAMPLE = "instruction string, input string, output string, metadata struct<source:string,type:string,sample_type:string,topic:string,related_template:string,symbol_kind:string,symbol_name:string,symbol_extraction_method:string>"
# Fixed values.
BINARY_SUFFIXES = [".png", ".jpg", ".jpeg", ".gif", ".ico", ".svg", ".woff", ".woff2", ".ttf", ".eot"]


def read_samples(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """JSON lines by the fixed schema; lines that don't parse are in ``_corrupt``."""
    df = spark.read.schema(SAMPLE + ", _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return df.withColumn("_source_split", F.lit(split))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their number from 1 in each file; a file is one row of the scan and so keeps its order."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return files.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line", "value")).withColumn("line", F.col("line") + 1).where(F.trim("value") != "")


def read_tree(spark: SparkSession, path: str, suffixes: list[str] | None = None) -> DataFrame:
    """path and content of all text files below path. Images, fonts and files with NUL bytes are left out; bytes that aren't UTF-8 are dropped."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    low = t.suffix("path")
    keep = low.isin(suffixes) if suffixes else ~low.isin(BINARY_SUFFIXES)
    nul = F.contains("content", F.lit(b"\0"))
    text = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))
    return found.where(keep).where(~nul | low.isin(".php", ".module", ".inc")).select("path", text.alias("content"), "length")


def write_samples(samples: DataFrame, path: str) -> None:
    """JSON lines without private columns, whose names begin with an underscore."""
    samples.select(*(c for c in samples.columns if not c.startswith("_"))).write.mode("overwrite").json(path)


def write_routed(gated: DataFrame, passed: str, rejected: str) -> None:
    kept = gated.persist()
    write_samples(kept.where("rejection_reason is null").drop("rejection_reason"), passed)
    write_samples(kept.where("rejection_reason is not null"), rejected)
    kept.unpersist()


def file_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.sha2("content", 256).alias("sha256"), "length").orderBy("path")


def tree_digest(index: DataFrame, root: str = "") -> str:
    """SHA-256 of all paths and file hashes in order; empty for no files."""
    rows = index.select(F.replace("path", F.lit(root), F.lit("")).alias("path"), "sha256").groupBy().agg(F.sort_array(F.collect_list(F.struct("path", "sha256"))).alias("f"))
    out = rows.select(F.when(F.size("f") == 0, "").otherwise(F.sha2(F.array_join(F.transform("f", lambda x: F.concat(x["path"], x["sha256"])), ""), 256))).first()
    return out[0]


def manifest(stage: str, metrics: dict, now: Callable[[], str]) -> str:
    return json.dumps({"stage": stage, "created": now(), "metrics": metrics}, indent=2, sort_keys=True)


def upserted(index: DataFrame, entry: DataFrame, key: str = "version") -> DataFrame:
    """The index with the entry in place of any of the same key."""
    return index.join(entry.select(key), key, "left_anti").unionByName(entry, allowMissingColumns=True)
