"""Ranks over sorted ranges: no task holds a whole key, however many rows it has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.checkpoints import held

#: Bits of the place inside a partition in what ``monotonically_increasing_id`` counts.
PLACE_BITS = 33


def numbered(rows: DataFrame, keys: list[str], order: list[Column], into: str) -> DataFrame:
    """Add ``into``: 1, 2, 3... inside each key, in the order of ``order``; rows of equal order any way.

    Rows are dealt into ranges of (keys, order) and sorted there, so one key may fill many ranges.
    A small table of (key, range) holds where each begins and what the ranges before it hold. No
    keys number all rows. Null keys are keys like any others.
    """
    by = [F.col(k) for k in keys]
    dealt = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    fixed = held(dealt.withColumn("_rank_at", F.monotonically_increasing_id())).withColumn("_rank_range", F.shiftright("_rank_at", PLACE_BITS))
    before = Window.partitionBy(*by).orderBy("_rank_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        fixed.groupBy(*by, "_rank_range").agg(F.min("_rank_at").alias("_rank_first"), F.count("*").alias("_rank_n"))
        .select(*(F.col(k).alias(f"_rank_key_{i}") for i, k in enumerate(keys)), F.col("_rank_range").alias("_rank_run"), "_rank_first", F.coalesce(F.sum("_rank_n").over(before), F.lit(0)).alias("_rank_before"))
    )
    match = F.col("_rank_range") == F.col("_rank_run")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_rank_key_{i}"))
    out = fixed.join(runs, match).withColumn(into, F.col("_rank_before") + F.col("_rank_at") - F.col("_rank_first") + 1)
    return out.select(*rows.columns, into)
