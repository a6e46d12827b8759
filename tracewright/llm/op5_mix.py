"""Mixing sources to target weights along a curriculum that changes with time.

Each source has a weight schedule over training time. Its integral is the source's cumulative
token demand; inverting it at a document's place in the source's stream gives the moment at which
the document is trained on. The mix is then sorted by that moment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, running_sum, spread, table, word_count

#: Weights of the sources in order, repeating; and how steeply each one's schedule falls or rises.
WEIGHTS, SLOPES = (3, 1, 2), (-0.5, 0.0, 0.5)
#: All targets as a share of all sizes; most of a source's size that a target may be.
SHARE, MOST = 1.5, 2.0


def _pick(values: tuple, number: Column) -> Column:
    return F.element_at(F.lit(list(values)), (number % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target, slope) from ``sizes(source, source_size)``, one row a source.

    Targets share ``share`` of all sizes by weight, none above ``most`` times its source's size,
    the excess going to the others by weight: sources fill in the order of limit over weight, up
    to the common level at which the rest still reaches the total. The table has a row a source,
    so its global windows are small.
    """
    ranked = sizes.withColumn("n", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    ranked = ranked.withColumns({"w": _pick(WEIGHTS, F.col("n")).cast("double"), "slope": _pick(SLOPES, F.col("n")), "limit": most * F.col("source_size").cast("double")})
    by_level = Window.orderBy(F.col("limit") / F.col("w"), "n")
    everything = Window.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    leveled = ranked.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("limit") / F.col("w"), F.struct(F.col("limit") / F.col("w"), "n", "level"))).over(everything)["level"]
    return leveled.select("source", "source_size", F.least("limit", F.coalesce(first * F.col("w"), F.col("limit"))).alias("target"), "slope")


def moment(words: Column, target: Column, slope: Column) -> Column:
    """When a source's cumulative demand reaches ``words``: time in 0 to 1.

    The schedule target * (1 + slope * (2 t - 1)) integrates to target * ((1 - slope) t + slope t**2).
    """
    part = F.when(target > 0, F.least(words / target, F.lit(1.0))).otherwise(0.0)
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * part)
    # the stable form of the quadratic formula; holds for slope 0 too
    return F.when(part > 0, 2 * part / ((1 - slope) + root)).otherwise(0.0)


def plan(docs: DataFrame, blocks_bits: int = 10) -> DataFrame:
    """Rows of ``docs(doc_id, source, size, ...)`` with source_size, target, taken and positions.

    A source's documents form a stream in a fixed mixed order, run through again and again until
    its target is taken; ``taken`` counts the words of a document in it, the last document being
    cut where the target is reached, so sources meet their targets to one word. ``positions`` has
    the moment of each run. A source may hold any share of the rows: sums run in blocks.
    Null sources are one source; null sizes count as 0; the result doesn't depend on row order.
    """
    size = F.coalesce(F.col("size"), F.lit(0)).cast("long")
    rows = docs.withColumn("size", size)
    totals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    totals = totals.select(F.col("source").alias("_source"), "source_size", "target", "slope")
    mixed = spread(F.pmod(F.coalesce("doc_id", F.lit(0).cast("long")), F.lit(2147483648)) * 131 + F.col("size"))
    placed = running_sum(rows, "source", F.col("size"), mixed, [F.col("doc_id"), F.col("size")], "_before", blocks_bits)
    wanted = F.round("target").cast("long")
    runs = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0)
    left = F.greatest(F.least(wanted - runs * F.col("source_size") - F.col("_before"), F.col("size")), F.lit(0))
    middle = lambda run: run * F.col("source_size") + F.col("_before") + F.col("size") / 2
    return (
        placed.join(totals, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("taken", (runs * F.col("size") + left).cast("long"))
        .withColumn("_copies", F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0))
        .withColumn("positions", F.transform(F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), F.col("_copies").cast("int")), lambda r: moment(middle(r), F.col("target"), F.col("slope"))))
        .drop("_source", "slope", "_before", "_copies")
    )


def mix(docs: DataFrame) -> DataFrame:
    """Columns of ``docs``, each row as often as the mix runs through it, sorted by training moment.

    Size is the number of words of ``text``. The document at which a source's target is reached
    stays whole if at least half of it is taken. Documents without words are kept once, at the
    start of their source's schedule, as no target counts them.
    """
    names = {c: f"_in_{c}" for c in docs.columns}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), *(F.col(c).alias(names[c]) for c in names))
    planned = plan(rows)
    whole = F.when(F.col("size") == 0, F.array(F.lit(0.0))).otherwise(F.slice(F.col("positions"), F.lit(1), F.round(F.col("taken") / F.col("size")).cast("int")))
    copies = planned.select(*names.values(), F.explode(whole).alias("_moment"))
    order = ["_moment", names["doc_id"]]
    return copies.repartitionByRange(*order).sortWithinPartitions(*order).select(*(F.col(n).alias(c) for c, n in names.items()))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target of each document's source, the words of the document that the mix takes, and its first training moment."""
    slim = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "source", word_count(F.col("text")).alias("size"))
    planned = plan(cut(slim))
    first = F.when(F.size("positions") > 0, F.element_at("positions", 1))
    return (
        planned.select("doc_id", "size", "source_size", "target", "taken", F.round(first, 9).alias("position"))
        .repartitionByRange(F.asc_nulls_last("position"), "doc_id")  # rows that aren't taken have no position
        .sortWithinPartitions(F.asc_nulls_last("position"), "doc_id")
    )


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, size, ((((coalesce(doc_id, 0) % 2147483648) * 131 + size) % 2147483648) * 2654435761) % 4294967296 AS h FROM
      (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM s),
w AS (SELECT *, [3, 1, 2][n % 3 + 1]::DOUBLE AS w, [-0.5, 0.0, 0.5][n % 3 + 1]::DOUBLE AS slope, 2.0::DOUBLE * source_size AS lim FROM r),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY lim / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, slope, least(lim, coalesce((SELECT level FROM l WHERE level <= lim / w ORDER BY lim / w, n LIMIT 1) * w, lim)) AS target FROM l),
p AS (SELECT d.*, t.source_size, t.target, t.slope, round(t.target)::BIGINT AS wanted,
             (coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS runs FROM p),
k AS (SELECT *, (runs * size + greatest(least(wanted - runs * source_size - before, size), 0))::BIGINT AS taken,
             least((before + size / 2) / nullif(target, 0), 1.0) AS part FROM q)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN round(2 * part / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * part)), 9) END AS position
FROM k
"""
