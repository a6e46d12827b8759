"""Exact top-k inner products by MaxScore over shards of dimension postings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Expected rows of a shard of candidates (least and most) and of a block of queries.
SHARD_ROWS, QUERY_ROWS = (4096, 65536), 2048
#: Stands for a null id inside tasks, so that it comes last.
NO_ID = 2**63 - 1
#: Dimensions that are probed before the threshold is held against the bounds again.
STEP = 8


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null for a null vector or one with a null or non-finite component."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.when(whole, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of longs; missing components are zero. Float64 while all sums are exact in it."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def maxscore(query_rows: np.ndarray, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, ids, scores) of the k best candidates of one shard but the query's own row, ties to smaller ids.

    Each dimension is a term whose posting list holds the shard's values. A term adds between its
    low and its high bound. Terms of large range are essential and traversed for all candidates;
    terms whose ranges together can't lift the k-th score are probed only for candidates that are
    still competitive.
    """
    low_v, high_v = vectors.min(axis=0), vectors.max(axis=0)
    largest = float(max(np.abs(queries).max(initial=1), 1)) * float(max(np.abs(vectors).max(initial=1), 1)) * queries.shape[1]
    if largest < 2**53:
        queries, vectors, low_v, high_v = (x.astype(np.float64) for x in (queries, vectors, low_v, high_v))
    postings = np.ascontiguousarray(vectors.T)
    seeds = np.unique(np.linspace(0, len(ids) - 1, min(len(ids), 16 * k)).astype(np.int64))
    seed_scores = queries @ postings[:, seeds]
    for own, q, seeded in zip(query_rows, queries, seed_scores, strict=True):
        ends = np.stack([q * low_v, q * high_v])
        least, most = ends.min(axis=0), ends.max(axis=0)
        terms = np.argsort(-(most - least), kind="stable")
        rest = np.concatenate([np.cumsum(most[terms][::-1])[::-1], [0]])  # the most that terms from i on can add
        others = seeded[rows[seeds] != own]
        floor = np.partition(others, len(others) - k)[len(others) - k] if len(others) >= k else -math.inf
        # terms stay essential until the others alone couldn't lift a candidate of least score to the floor
        gain = np.concatenate([np.cumsum((most - least)[terms][::-1])[::-1], [0]])
        essential = max(1, int(np.searchsorted(-gain, -(floor - least.sum()), "right"))) if floor > -math.inf else len(terms)
        essential = min(max(essential, len(terms) // 4), len(terms))
        score = q[terms[:essential]] @ postings[terms[:essential]]
        alive = np.flatnonzero((rows != own) & (score + rest[essential] >= floor))
        score, at = score[alive], essential
        while at < len(terms) and len(alive):
            chunk = terms[at : at + STEP]
            score = score + q[chunk] @ postings[np.ix_(chunk, alive)]
            at = min(at + STEP, len(terms))
            keep = score + rest[at] >= floor
            alive, score = alive[keep], score[keep]
        if len(alive) > k:
            edge = np.partition(score, len(score) - k)[len(score) - k]
            alive, score = alive[score >= edge], score[score >= edge]
        order = np.lexsort((ids[alive], -score))[:k]
        yield own, ids[alive[order]], score[order].astype(np.int64)


def top_k(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row of ``rows(vec_id, v)`` its k best other rows.

    Rows are dealt by hash into shards, query rows into blocks, and each pair of a shard and a
    block is one group of bounded size; shards grow with the square root of the table, their
    number with the rest. Only a query's own row is left out: rows that repeat an id are all
    candidates, and each is a query if its id is one. Fewer than k candidates: all. Ties go to
    smaller ids, null ids last. Rows with a null vector take no part; vectors of unequal length are
    filled with zeros, so an empty one scores 0. An empty table gives no rows.
    """
    numbered = cut(rows.where("v is not null").select(F.monotonically_increasing_id().alias("row"), F.coalesce("vec_id", F.lit(NO_ID)).alias("vec_id"), "v"))
    asked = numbered.where(is_query)
    n, m = numbered.count(), asked.count()
    size = min(SHARD_ROWS[1], max(SHARD_ROWS[0], 16 * math.isqrt(n)))
    shards, blocks = math.ceil(max(n, 1) / size), math.ceil(max(m, 1) / QUERY_ROWS)
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = asked.select(every(shards).alias("shard"), dealt(blocks).alias("part"), "row", "v")
    right = numbered.select(dealt(shards).alias("shard"), every(blocks).alias("part"), "row", "vec_id", "v")

    def pair(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(c):
            width = max(1, q["v"].map(len).max(), c["v"].map(len).max())
            for own, ids, scores in maxscore(q["row"].to_numpy(), _matrix(q["v"], width), c["row"].to_numpy(), c["vec_id"].to_numpy(), _matrix(c["v"], width), k):
                out.append(pd.DataFrame({"row": own, "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("row", "vec_id", "score")})

    found = left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInPandas(pair, "row long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = asked.select("row", F.col("vec_id").alias("query_id"))
    return ranked.join(names, "row").select("query_id", "rank", F.nullif(F.col("vec_id"), F.lit(NO_ID)).alias("vec_id"), "score")


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other rows of each embedding whose vec_id is divisible by 50, by inner product of quantised components."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long"), quantised(F.col("embedding")).alias("v"))
    return top_k(rows, F.expr(f"vec_id % 50 = 0 and vec_id <> {NO_ID}"), 5)


ORACLE_SQL = """
WITH e AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.n, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.n <> q.n),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INT AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
