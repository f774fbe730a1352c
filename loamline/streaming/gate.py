"""Incremental stages on streams of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import text as t
from ..operators import gate


def stateless(stream: DataFrame, cfg: gate.GateConfig | None = None) -> DataFrame:
    """Rules that need no state, on a batch or a stream."""
    both = gate.stateless(stream, cfg)
    from pyspark.sql import functions as F

    return both.withColumn("rejection_reason", F.coalesce("before", "after")).drop("before", "after")


def new_outputs(stream: DataFrame, watermark: tuple[str, str] | None = None, normalise: bool = True) -> DataFrame:
    """Samples whose output wasn't seen before; with a watermark, within its time."""
    keyed = stream.withColumn("output_hash", t.output_hash("output", normalise))
    if watermark:
        return keyed.withWatermark(*watermark).dropDuplicatesWithinWatermark(["output_hash"])
    return keyed.dropDuplicates(["output_hash"])
