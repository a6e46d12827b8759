"""Grouped statistics and bounded lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def middle(value: str, place: str, count: str) -> Column:
    """Median of a group whose rows know their place (from 0) in the order of the value and their number."""
    i, n = F.col(place), F.col(count)
    return F.avg(F.when((i == F.floor((n - 1) / 2)) | (i == F.floor(n / 2)), F.col(value)))


def numeric_pattern(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """count, min, median, mean, std (population; null below two), p90, max and cv of a value for each group.

    p90 is the value at place floor(0.9 (n - 1)) of the sorted values, the median the mean of the
    middle ones. Values are ranked in a window that can spill, so a group is never an array.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("v"))
    group = Window.partitionBy(*keys)
    ranked = rows.withColumns({"i": F.row_number().over(group.orderBy("v")) - 1, "n": F.count("*").over(group)})
    mean, std = F.avg("v"), F.stddev_pop("v")
    return ranked.groupBy(*keys).agg(
        F.count("*").alias("count"), F.round(F.min("v"), 3).alias("min"), F.round(middle("v", "i", "n"), 3).alias("median"), F.round(mean, 3).alias("mean"),
        F.when(F.count("*") > 1, F.round(std, 3)).alias("std"),
        F.round(F.max(F.when(F.col("i") == F.floor(F.lit(0.9) * (F.col("n") - 1)), F.col("v"))), 3).alias("p90"),
        F.round(F.max("v"), 3).alias("max"), F.when((F.count("*") > 1) & (mean > 0), F.round(std / mean, 3)).alias("cv"),
    )


def burstiness(mean: Column, std: Column, count: Column) -> Column:
    """(std - mean) / (std + mean); null below two values, 0 for a zero denominator."""
    return F.when(count >= 2, F.when(std + mean == 0, 0.0).otherwise(F.round((std - mean) / (std + mean), 3)))


def top_values(df: DataFrame, keys: list[str], value: str, order: str, k: int) -> DataFrame:
    """(keys, rank, value, n): the k most frequent values of each group, ties by first appearance in ``order``."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    best = Window.partitionBy(*keys).orderBy(F.desc("n"), "_first", value)
    return counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(*keys, "rank", F.col(value).alias("value"), "n")


def bounded_distinct(df: DataFrame, keys: list[str], value: str, order: str, k: int, fold_case: bool = False) -> DataFrame:
    """(keys, values): up to k different non-empty values in order of first appearance.

    With ``fold_case``, values that agree trimmed and in lower case are one. Rows are cut to k a group before they are collected.
    """
    key = F.lower(F.trim(value)) if fold_case else F.col(value)
    firsts = df.where(F.col(value).isNotNull() & ~F.trim(value).isin("", "-")).groupBy(*keys, key.alias("_key")).agg(F.min(F.struct(order, value)).alias("_first"))
    ranked = firsts.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("_first"))).where(F.col("_n") <= k)
    return ranked.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("_first")), lambda x: x[value]).alias("values"))


def first_values(df: DataFrame, keys: list[str], order: str, limits: dict[str, int]) -> DataFrame:
    """(keys, one array for each column of ``limits``): its different values as text, first seen first, up to the limit.

    Columns may hold single values or arrays. Case and blanks around don't count; null, empty and
    "-" are left out. All columns go through one shuffle, and rows are cut to the limits before
    they are collected. Groups without any value are missing.
    """
    kinds = dict(df.dtypes)

    def cells(c: str) -> Column:
        values = F.transform(F.col(c), lambda v: v.cast("string")) if kinds[c].startswith("array") else F.array(F.col(c).cast("string"))
        listed = F.transform(values, lambda v, i: F.struct(F.lit(c).alias("field"), i.alias("place"), v.alias("value")))
        return F.coalesce(listed, F.array().cast("array<struct<field:string,place:int,value:string>>"))

    rows = df.select(*keys, F.col(order).alias("_order"), F.explode(F.concat(*map(cells, limits))).alias("c")).select(*keys, "_order", "c.*")
    rows = rows.where(~F.trim("value").isin("", "-"))
    firsts = rows.groupBy(*keys, "field", F.lower(F.trim("value")).alias("_key")).agg(F.min(F.struct("_order", "place", "value")).alias("_first"))
    limit = F.coalesce(*(F.when(F.col("field") == c, n) for c, n in limits.items()))
    ranked = firsts.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "field").orderBy("_first"))).where(F.col("_n") <= limit)
    return ranked.groupBy(*keys).agg(*(F.transform(F.array_sort(F.collect_list(F.when(F.col("field") == c, F.col("_first")))), lambda x: x["value"]).alias(c) for c in limits))


def frequent_values(df: DataFrame, keys: list[str], order: str, limits: dict[str, int]) -> DataFrame:
    """(keys, one array of (value, count) for each column of ``limits``): its most frequent values as text, ties by first appearance.

    Null, empty and "-" are left out. All columns go through one shuffle, counts are added up
    before it, and rows are cut to the limits before they are collected.
    """
    cells = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in limits))
    rows = df.select(*keys, F.col(order).alias("_order"), F.explode(cells).alias("c")).select(*keys, "_order", "c.*").where("value is not null and value not in ('', '-')")
    counted = rows.groupBy(*keys, "field", "value").agg(F.count("*").alias("count"), F.min("_order").alias("_first"))
    limit = F.coalesce(*(F.when(F.col("field") == c, n) for c, n in limits.items()))
    ranked = counted.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "field").orderBy(F.desc("count"), "_first", "value"))).where(F.col("_n") <= limit)
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("field") == c, F.struct("_n", "value", "count")))), lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count")))
    return ranked.groupBy(*keys).agg(*(listed(c).alias(c) for c in limits))
