"""What the operators share: tables in the shared folder, reading, and joins that stand skew."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_own: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where it is unset one is made: beside the warehouse on a cluster, in
    the temporary folder in local mode, as in tests.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        _own[app] = tempfile.mkdtemp(prefix="loamline-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return _own[app]


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Steps that run inside send rows to Python in smaller batches: ten thousand texts at once take much memory on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def light_batches(spark: SparkSession, most_bytes: int, rows: int = 256) -> Iterator[None]:
    """Steps that run inside send rows to Python in batches of about most_bytes, or one row, and read Parquet by few rows.

    Spark's reader holds 4,096 rows of a column in one array, which doubles as it fills, whatever the length of a text.
    """
    most = {"spark.sql.execution.arrow.maxBytesPerBatch": most_bytes, "spark.sql.parquet.columnarReaderBatchSize": rows}
    before = {name: spark.conf.get(name) for name in most}
    # Sizes may have units or mean no limit: those give way.
    held = {name: int(n) if (n := x.removesuffix("b")).isdigit() else 0 for name, x in before.items()}
    for name, n in most.items():
        spark.conf.set(name, str(min(n, held[name] or n)))
    try:
        yield
    finally:
        for name, x in before.items():
            spark.conf.set(name, x)


def stored(df: DataFrame, what: str, batch_rows: int | None = None) -> tuple[DataFrame, str]:
    """df written as Parquet to the shared folder and read again, which cuts its lineage; and the path."""
    spark, path = df.sparkSession, new_path(df.sparkSession, what)
    schema = df.schema
    with small_batches(spark, batch_rows) if batch_rows else contextlib.nullcontext():
        df.write.parquet(path)
    # What a result still reads can't go before the session ends.
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Removes tables of ``stored`` that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def released(spark: SparkSession) -> None:
    """Lets Spark drop shuffle files of finished steps, which it does once their plans are garbage."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def heavy_lookup(rows: DataFrame, facts: DataFrame, key: str, weight: str, share: int = 2000) -> DataFrame:
    """Left join of rows with facts (one row per key), keys of many rows apart.

    ``weight`` is the column of facts that counts the rows of a key. A key with
    more than 1/share of all rows is heavy; there are fewer than ``share`` of
    those at any size, so they are broadcast, and the rest is joined by shuffle.
    """
    total = facts.agg(F.sum(weight)).first()[0] or 0
    limit = max(1, total // share)
    heavy = F.broadcast(facts.where(F.col(weight) > limit).limit(share).withColumn("_heavy", F.lit(True)))
    light = facts.where(F.col(weight) <= limit)
    out = [c for c in facts.columns if c != key]
    first = rows.join(heavy, key, "left")
    # Null keys have no facts: they would all go to one task.
    there = first.where(F.col("_heavy") | F.col(key).isNull()).drop("_heavy")
    rest = first.where(F.col("_heavy").isNull() & F.col(key).isNotNull()).drop("_heavy", *out).join(light, key, "left")
    return there.unionByName(rest)


def sifted(rows: DataFrame, keys: DataFrame, key: str | list[str], most_bits: int = 1 << 26) -> DataFrame:
    """rows without most of those whose key is not among keys, so that an exact semi join after it shuffles less.

    A table of one bit for each hash is broadcast: 16 bits a key, ``most_bits`` (8 MB) at most. Beyond that it
    lets more rows pass, and in the end all.
    """
    spark = rows.sparkSession
    bits = min(most_bits, max(1 << 16, 1 << (16 * keys.count()).bit_length()))
    at = F.pmod(F.xxhash64(*([key] if isinstance(key, str) else key)), F.lit(bits))
    words = keys.select(at.alias("at")).groupBy(F.expr("shiftright(at, 6)").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")).toPandas()
    dense = np.zeros(bits // 64, np.int64)
    dense[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64)
    schema = T.StructType([T.StructField("_sieve", T.ArrayType(T.LongType(), False))])
    sieve = spark.createDataFrame(pa.table({"_sieve": pa.array([dense])}), schema)
    there = F.expr("bit_get(element_at(_sieve, cast(shiftright(_at, 6) as int) + 1), cast(_at & 63 as int)) = 1")
    return rows.withColumn("_at", at).join(F.broadcast(sieve), there, "left_semi").drop("_at")


def literal_table(spark: SparkSession, rows: list[tuple], schema: dict[str, str]) -> DataFrame:
    """A few rows as literals of the plan."""
    if not rows:
        return spark.range(0).select(*(F.lit(None).cast(t).alias(n) for n, t in schema.items()))
    return spark.range(1).select(F.inline(F.array(*(F.struct(*(F.lit(str(x) if t.startswith("decimal") else x).cast(t).alias(n) for x, (n, t) in zip(r, schema.items(), strict=True))) for r in rows))))


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def pieces(batches: Iterator[pa.RecordBatch], most_bytes: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about most_bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def trimmed() -> None:
    """Gives what a finished task used back to the system: a worker lives on and serves other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every libc can
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(docs: DataFrame, make: Callable[[], Callable[[list], list[Sequence]]], out: dict[str, str], most_bytes: int, text: str = "text") -> DataFrame:
    """docs without the text, and the columns ``out`` that make()(texts) gives. Names must not clash."""
    others = [c for c in docs.columns if c != text]
    types = [ARROW[t] for t in out.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for b in pieces(batches, most_bytes, text):
            made = of(b.column(b.schema.get_field_index(text)).to_pylist())
            cols = [b.column(b.schema.get_field_index(c)) for c in others] + [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=[*others, *out])
        del of
        trimmed()

    schema = T.StructType([*(docs.schema[c] for c in others), *T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in out.items())).fields])
    return docs.select(*(f"`{c}`" for c in others), text).mapInArrow(run, schema)


def whole_rows(docs: DataFrame) -> DataFrame:
    """The rows as the column ``_row``, beside the text: extra columns can't clash with any made from it."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text")


def with_text(made: DataFrame, schema: T.StructType, text: str) -> DataFrame:
    """Rows of ``whole_rows`` with another text, and n_chars counted anew."""
    new = {"text": F.col(text)}
    if "n_chars" in schema.names:
        new["n_chars"] = F.char_length(text).cast(schema["n_chars"].dataType)
    return made.select(*(new.get(c, F.col("_row").getField(c)).alias(c) for c in schema.names))
