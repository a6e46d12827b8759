"""Helpers that several corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of the word rule, for SQL regular expressions and for byte strings.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of the tables that ``cut`` has written since the innermost ``scratch`` of this thread began.
_RUN: ContextVar[list[str] | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset and all tasks run on this machine, as in tests, a temporary folder is
    made and set; on a cluster the setting is needed.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", "")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


#: Spark's own setting: shuffle files go when the query that wrote them ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside leave no shuffle files; one that runs again shuffles again."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from its files.

    The table knows nothing of the plan that made it, so loops stay cheap to plan. It lies in the
    application's own folder until the ``scratch`` around it ends, if there is one, as later steps
    may read it again. A loop that only needs its last table names the one before: ``instead_of``
    is a DataFrame that ``cut`` returned, and its files go once the new ones are written. So do the
    shuffle files behind ``df``.
    """
    spark, run = df.sparkSession, _RUN.get()
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/cut-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    if run is not None:
        run.append(path)
    if instead_of is not None:
        discard(spark, instead_of._cut_path)
        if run is not None and instead_of._cut_path in run:
            run.remove(instead_of._cut_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``cut`` writes inside, in this thread, are removed at the end; results must be written by then."""
    run: list[str] = []
    token = _RUN.set(run)
    try:
        yield
    finally:
        _RUN.reset(token)
        for path in run:
            discard(spark, path)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows at the most, so that only their values are Python objects at once."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def utf8_size(text: Column) -> Column:
    """Bytes of the text in UTF-8; null counts as none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null counts as none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def spread(key: Column) -> Column:
    """A fixed mixing of an integer key to [0, 2**32): one multiplication, so that SQL engines agree on it."""
    low = F.pmod(F.coalesce(key.cast("long"), F.lit(0).cast("long")), F.lit(2147483648))
    return F.pmod(low * F.lit(2654435761), F.lit(4294967296))


def running_sum(df: DataFrame, key: str, value: Column, mix: Column, ties: list[Column], into: str, bits: int = 10) -> DataFrame:
    """Add ``into``, the sum of ``value`` over the rows of the same ``key`` that come earlier.

    Rows are ordered by (``mix``, ``ties``); ``mix`` lies in [0, 2**32) and is spread evenly over
    rows that differ. A key that holds a third of all rows would be one task of a plain window.
    Here its rows are cut by the top ``bits`` bits of ``mix`` into blocks that are summed and
    numbered apart, and a small table (key, block) carries the sums across the blocks.
    """
    block = F.shiftright(mix.cast("long"), 32 - bits).cast("int")
    rows = df.withColumns({"_sum_value": value, "_sum_mix": mix, "_sum_block": block})
    over = Window.partitionBy(key).orderBy("_sum_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy(key, "_sum_block")
        .agg(F.sum("_sum_value").alias("_sum"))
        .select(F.col(key).alias("_sum_key"), F.col("_sum_block").alias("_sum_b"), F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_sum_start"))
    )
    inside = Window.partitionBy(key, "_sum_block").orderBy("_sum_mix", *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_sum_here", F.coalesce(F.sum("_sum_value").over(inside), F.lit(0)))
        .join(totals, F.col(key).eqNullSafe(F.col("_sum_key")) & (F.col("_sum_block") == F.col("_sum_b")))
        .withColumn("_sum_all", F.col("_sum_start") + F.col("_sum_here"))
        .drop(into, "_sum_value", "_sum_mix", "_sum_block", "_sum_key", "_sum_b", "_sum_start", "_sum_here")
        .withColumnRenamed("_sum_all", into)
    )
