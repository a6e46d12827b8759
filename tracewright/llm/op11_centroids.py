"""Centroid clustering of integer vectors; Ptolemaic pivots rule centroids out before exact distances."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .op4_maxscore import quantised

#: Share by which bounds give way, far above the rounding of a few operations on doubles.
SLACK = 2.0**-44
#: Largest component for which sums of squares of up to 128 dimensions fit in 64 bits; larger ones take Python's integers.
SMALL = 2**27
#: Vectors that a task holds against the centroids at once.
AT_ONCE = 4096
LONGEST = 2**63 - 1


def whole(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, exact."""
    d = rows - others
    return (d * d).sum(axis=-1)


class Pivots:
    """Fixed vectors, and fixed pairs of them that lie apart.

    Ptolemy: d(q, o) * d(p, s) >= |d(q, p) * d(o, s) - d(q, s) * d(o, p)| for any four points. With
    the distances of q to the pivots at hand, each pair (p, s) bounds d(q, o) from below.
    """

    def __init__(self, points: np.ndarray, pairs_each: int = 2):
        self.points = points
        gaps = {(p, s): float(whole(points[p], points[s])) for p, s in combinations(range(len(points)), 2)}
        far = lambda p: sorted((x for x in gaps if p in x and gaps[x] > 0), key=lambda x: (-gaps[x], x))[:pairs_each]
        self.pairs = sorted({x for p in range(len(points)) for x in far(p)})
        self.gaps = [math.sqrt(gaps[x]) for x in self.pairs]

    def squares(self, rows: np.ndarray) -> np.ndarray:
        """Exact squared distances to the pivots, one column each."""
        return np.stack([whole(rows, p) for p in self.points], axis=1)

    def least(self, near: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """A number that no exact squared distance is below, for each row of ``near`` and each centroid."""
        q, o = np.sqrt(near.astype(np.float64)), np.sqrt(self.squares(centroids).astype(np.float64))
        low = np.zeros((len(q), len(o)))
        for (p, s), gap in zip(self.pairs, self.gaps, strict=True):
            x, y = q[:, p, None] * o[None, :, s], q[:, s, None] * o[None, :, p]
            np.maximum(low, (np.abs(x - y) - SLACK * (x + y)) / gap, out=low)
        return low * low * (1 - SLACK)


def nearest(rows: np.ndarray, near: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of each row, ties to the smaller number; and how many distances were worked out.

    Centroids are taken by rising bound; once a bound exceeds the best distance, the rest can't win.
    """
    bounded = rows.dtype != object and pivots.points.dtype != object
    low = pivots.least(near, centroids) if bounded else np.zeros((len(rows), len(centroids)))
    order = np.argsort(low, axis=1, kind="stable")
    who = order[:, 0].copy()
    best = whole(rows, centroids[who])
    open_rows, tried = np.arange(len(rows)), len(rows)
    for j in range(1, len(centroids)):
        c = order[open_rows, j]
        going = low[open_rows, c] <= best[open_rows].astype(np.float64)
        open_rows, c = open_rows[going], c[going]
        if not len(open_rows):
            break
        d = whole(rows[open_rows], centroids[c])
        tried += len(d)
        wins = (d < best[open_rows]) | ((d == best[open_rows]) & (c < who[open_rows]))
        best[open_rows[wins]], who[open_rows[wins]] = d[wins], c[wins]
    return who, best, tried


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _exact(*arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays as they are, or as Python's integers if squares may not fit in 64 bits."""
    return arrays if all(len(a) == 0 or (a.min() >= -SMALL and a.max() <= SMALL) for a in arrays) else tuple(a.astype(object) for a in arrays)


def _near(vectors: DataFrame, pivots: Pivots, dims: int) -> DataFrame:
    """Add ``near``, the squared distances to the pivots; beyond 64 bits they are cut and not used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, points = _exact(_matrix(batch.column(1), dims), pivots.points)
            near = np.minimum(np.stack([whole(rows, p) for p in points], axis=1), LONGEST).astype(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * near.shape[1], pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "v", "near"])

    return vectors.mapInArrow(run, "vec_id long, v array<long>, near array<long>")


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, pivots: Pivots) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, rows, centroid of each, squared distance of each) for pieces of a batch."""
    for at in range(0, len(batch), AT_ONCE):
        piece = batch.slice(at, AT_ONCE)
        rows, c = _exact(_matrix(piece.column(1), centroids.shape[1]), centroids)
        who, best, _ = nearest(rows, _matrix(piece.column(2), len(pivots.points)), c, pivots)
        yield at, rows, who, best


def moved(vectors: DataFrame, centroids: np.ndarray, pivots: Pivots) -> np.ndarray:
    """The next centroids: floors of the exact means of their vectors; those of none stay.

    Each task adds up its vectors; the driver gets one number for each centroid and dimension.
    """
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, dtype=object), np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            for _, rows, who, _ in _assigned(batch, centroids, pivots):
                for c in np.unique(who):
                    mine = rows[who == c]
                    sums[c] += mine.sum(axis=0)
                    counts[c] += len(mine)
        used = np.flatnonzero(counts)
        c, d = np.repeat(used, dims), np.tile(np.arange(dims), len(used))
        total = pa.array([Decimal(int(x)) for x in sums[c, d]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), total, pa.array(counts[c])], ["c", "d", "total", "n"])

    found = vectors.mapInArrow(run, "c long, d long, total decimal(38,0), n long").groupBy("c", "d").agg(F.sum("total"), F.sum("n")).collect()
    out = centroids.copy()
    for c, d, total, n in found:
        out[c, d] = int(total) // n
    return out


def assign(vectors: DataFrame, centroids: np.ndarray, pivots: Pivots) -> DataFrame:
    """(vec_id, cluster, distance) of each vector; a distance beyond 64 bits is cut to the largest long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, who, best in _assigned(batch, centroids, pivots):
                distance = np.minimum(best, LONGEST).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(who)), pa.array(who.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(rows: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of each kept row of ``rows(vec_id, embedding)``.

    Kept are vectors of exactly ``dims`` components, none null or non-finite, as integers
    floor(scale * x). Centroids start as the k kept vectors of smallest sha256 of
    ``<seed>:<vec_id>``; rows that repeat an id are told apart by their components, and rows of null
    id come last. With fewer than k kept vectors there are as many centroids. The first centroids
    are also the pivots, whose distances to all vectors are stored once. Each of ``rounds`` rounds
    assigns all vectors and moves each centroid to the exact floor of its vectors' mean; then they
    are assigned once more. Every row counts, repeated ones too. Other columns are ignored; no kept
    rows give no rows. Integers beyond a long are cut to it, and so are sums of distances.
    """
    spark = rows.sparkSession
    v = F.when(F.size("embedding") == dims, quantised(F.col("embedding"), scale))
    kept = rows.select(F.col("vec_id").cast("long"), v.alias("v")).where("v is not null")
    first = kept.orderBy(F.asc_nulls_last(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)), "v").limit(k).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r.v for r in first], dtype=np.int64)
    pivots = Pivots(_exact(centroids)[0])
    vectors = cut(_near(kept, pivots, dims))
    for _ in range(rounds):
        centroids = moved(vectors, centroids, pivots)
    out = cut(assign(vectors, centroids, pivots))
    sums = {c: int(s) for c, s in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    cap = lambda n: min(n, LONGEST)
    about = [(c, cap(s), cap(sum(sums.values())), centroids[c].tolist()) for c, s in sums.items()]
    small = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return out.join(F.broadcast(small), "cluster").select(*(x.split()[0] for x in schema.split(", ")))  # at most k rows


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 clusters of all embeddings after 3 rounds, with squared distances and digests of the centroids."""
    out = cluster(table(spark, sf_dir, "embeddings"))
    return out.withColumn("centroid_sha256", F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)).drop("centroid")


def _sql(k: int = 16, rounds: int = 3) -> str:
    steps = [
        """e AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
         WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v FROM e QUALIFY k < {k})",
    ]
    for i in range(rounds + 1):
        distance = "list_dot_product(e.v, e.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(e.v, c.v)"
        steps.append(f"a{i} AS MATERIALIZED (SELECT e.n, min(ROW({distance}, c.k)) AS best FROM e, c{i} c GROUP BY e.n)")
        if i < rounds:
            steps.append(f"""p{i} AS (SELECT k, d, floor(sum(x) / count(*)) AS x FROM (
              SELECT a.best[2] AS k, unnest(range(1, 65)) AS d, unnest(e.v) AS x FROM a{i} a JOIN e USING (n)) GROUP BY k, d)""")
            steps.append(f"m{i} AS (SELECT k, list(x ORDER BY d) AS v FROM p{i} GROUP BY k)")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k))")
    return f"""WITH {", ".join(steps)}
SELECT e.vec_id, a.best[2]::INT AS cluster, a.best[1]::BIGINT AS distance, sum(a.best[1]) OVER (PARTITION BY a.best[2])::BIGINT AS cluster_inertia,
  sum(a.best[1]) OVER ()::BIGINT AS inertia, sha256(list_aggregate(list_transform(c.v, lambda x: x::BIGINT::VARCHAR), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} a JOIN e USING (n) JOIN c{rounds} c ON c.k = a.best[2]"""


ORACLE_SQL = _sql()
