"""Typed merges of the rows of a group, built from the schema at every depth."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, NumericType, StringType, StructType

from ..functions.text import redact_sensitive_text
from .context import same_keys
from .evidence import filled

#: What is seen of a payload, best first; numbers that add up.
VISIBILITY = ("plaintext_http", "encrypted_tls", "metadata_only", "unknown")


def _adds_up(name: str, variant: str) -> bool:
    return variant == "group" and (name.endswith("body_len") or name == "total_files")


def _leaves(schema: StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], DataType]]:
    for f in schema:
        if isinstance(f.dataType, StructType):
            yield from _leaves(f.dataType, (*path, f.name))
        else:
            yield (*path, f.name), f.dataType


def _at(path: tuple[str, ...]) -> Column:
    out = F.col(f"`{path[0]}`")
    for name in path[1:]:
        out = out[name]
    return out


def _built(schema: StructType, made: dict[tuple[str, ...], str], path: tuple[str, ...] = ()) -> list[Column]:
    return [
        (F.struct(*_built(f.dataType, made, (*path, f.name))) if isinstance(f.dataType, StructType) else F.col(made[*path, f.name])).alias(f.name)
        for f in schema
    ]


def merge_values(rows: DataFrame, keys: list[str], order: str, limit: int = 12, variant: str = "group") -> DataFrame:
    """One row for each group: its other columns merged by type, those inside structs each by its own.

    Booleans: any. Numbers: the largest, but in variant ``group`` the sum of names that end in
    body_len and of total_files. Arrays: the first ``limit`` different values, first seen first
    (elements that aren't texts go by their JSON). Maps: value by value, as numbers. payload_visibility:
    the best that occurs. Anything else: the first that isn't empty in ``order``. Variant ``capture``
    redacts the texts of arrays and takes those that differ in case for one. Null and empty values
    take no part; a group without any gets null, or an empty array.
    """
    inner = StructType([f for f in rows.schema if f.name not in (*keys, order)])
    leaves = list(_leaves(inner))
    made = {path: f"_{i}" for i, (path, _) in enumerate(leaves)}
    plain, cells, entries = [], [], []
    for path, kind in leaves:
        c, name = _at(path), made[path]
        if isinstance(kind, ArrayType):
            text = F.transform(c, lambda x: x if isinstance(kind.elementType, StringType) else F.to_json(F.struct(x.alias("x"))))  # noqa: B023
            shown = F.transform(text, lambda x: redact_sensitive_text(x, 220)) if variant == "capture" and isinstance(kind.elementType, StringType) else text
            listed = F.transform(shown, lambda v, i: F.struct(F.lit(name).alias("leaf"), i.alias("place"), v.alias("value")))  # noqa: B023
            cells.append(F.coalesce(listed, F.array().cast("array<struct<leaf:string,place:int,value:string>>")))
        elif isinstance(kind, MapType):
            pairs = F.transform(F.map_entries(c), lambda e: F.struct(F.lit(name).alias("leaf"), e["key"].cast("string").alias("key"), e["value"].cast("double").alias("value"), F.lit(_adds_up(path[-1], variant)).alias("adds")))  # noqa: B023
            entries.append(F.coalesce(pairs, F.array().cast("array<struct<leaf:string,key:string,value:double,adds:boolean>>")))
        elif isinstance(kind, BooleanType):
            plain.append(F.bool_or(c).alias(name))
        elif isinstance(kind, NumericType):
            plain.append((F.sum if _adds_up(path[-1], variant) else F.max)(c).alias(name))
        elif path[-1] == "payload_visibility":
            best = [F.when(F.bool_or(c == v), v) for v in VISIBILITY]
            plain.append(F.coalesce(*best, F.min(F.when(filled(kind, c), F.struct(F.col(order), c.alias("v"))))["v"]).alias(name))
        else:
            plain.append(F.min(F.when(filled(kind, c), F.struct(F.col(order), c.alias("v"))))["v"].alias(name))
    out = rows.groupBy(*keys).agg(*plain) if plain else rows.select(*keys).distinct()
    if cells:
        values = rows.select(*keys, F.col(order).alias("_order"), F.explode(F.concat(*cells)).alias("c")).select(*keys, "_order", "c.*").where("value is not null and value not in ('', '-')")
        key = F.lower("value") if variant == "capture" else F.col("value")
        firsts = values.groupBy(*keys, "leaf", key.alias("_value")).agg(F.min(F.struct("_order", "place", "value")).alias("_first"))
        ranked = firsts.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "leaf").orderBy("_first"))).where(F.col("_n") <= limit)
        arrays = [(made[p], k) for p, k in leaves if isinstance(k, ArrayType)]
        kept = lambda n: F.transform(F.array_sort(F.collect_list(F.when(F.col("leaf") == n, F.col("_first")))), lambda x: x["value"])
        out = same_keys(out, ranked.groupBy(*keys).agg(*(kept(n).alias(n) for n, _ in arrays)), keys, "left")
        for n, kind in arrays:
            whole = F.col(n) if isinstance(kind.elementType, StringType) else F.transform(n, lambda v: F.from_json(v, StructType().add("x", kind.elementType))["x"])  # noqa: B023
            out = out.withColumn(n, F.coalesce(whole, F.array().cast(f"array<{kind.elementType.simpleString()}>")))
    if entries:
        pairs = rows.select(*keys, F.explode(F.concat(*entries)).alias("e")).select(*keys, "e.*").where("value is not null")
        each = pairs.groupBy(*keys, "leaf", "key").agg(F.when(F.bool_or("adds"), F.sum("value")).otherwise(F.max("value")).alias("value"))
        maps = [(made[p], k) for p, k in leaves if isinstance(k, MapType)]
        held = lambda n: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("leaf") == n, F.struct("key", "value")))))
        out = same_keys(out, each.groupBy(*keys).agg(*(held(n).cast(k).alias(n) for n, k in maps)), keys, "left")
    return out.select(*keys, *_built(inner, made))
