"""Importance resampling towards a target text: hashed word runs, log ratios of their buckets, Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

BUCKETS = 10_000
#: Different features that a task keeps together with their buckets; then it starts anew.
REMEMBERED = 200_000
#: Lower-cases A-Z and blanks all ASCII that is no letter or digit, on UTF-8 bytes.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1).astype(np.uint32)
    return crc


CRC_TABLE = _crc_table()


def crc32_all(features: list[bytes]) -> np.ndarray:
    """Unsigned crc32 of each feature.

    Features of one length make a matrix of bytes; each column updates the sums of all its rows at
    once, and the sums go back to the features' places.
    """
    out = np.empty(len(features), dtype=np.uint32)
    if not features:
        return out
    lengths = np.fromiter(map(len, features), dtype=np.int64, count=len(features))
    order = np.argsort(lengths, kind="stable")
    values, starts = np.unique(lengths[order], return_index=True)
    for length, places in zip(values.tolist(), np.split(order, starts[1:]), strict=True):
        rows = np.frombuffer(b"".join([features[i] for i in places.tolist()]), dtype=np.uint8).reshape(len(places), length)
        crc = np.full(len(places), 0xFFFFFFFF, dtype=np.uint32)
        for column in rows.T:
            crc = CRC_TABLE[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
        out[places] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def runs(words: list[bytes], most: int) -> list[bytes]:
    """All runs of 1 to ``most`` consecutive words, joined by one blank."""
    return words + [b" ".join(words[i : i + n]) for n in range(2, most + 1) for i in range(len(words) - n + 1)]


class Buckets:
    """Buckets of features, remembered for those that have been seen."""

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, {}

    def of(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list({f for features in texts for f in features if f not in self.known})
        self.known.update(zip(new, (crc32_all(new) % np.uint32(self.buckets)).tolist(), strict=True))
        known = self.known
        return [np.array([known[f] for f in features], dtype=np.int64) for features in texts]


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about a megabyte of text."""
    step = max(1, len(batch) * 1_000_000 // max(1, batch.nbytes))
    for at in range(0, len(batch), step):
        yield batch.slice(at, step)


def bucket_counts(texts: DataFrame, most: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over the whole ``text`` column; the driver gets at most ``buckets`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, found = np.zeros(buckets, dtype=np.int64), Buckets(buckets)
        for batch in batches:
            for piece in _pieces(batch):
                for own in found.of([runs(words_of(t.as_py()), most) for t in piece.column(0)]):
                    seen += np.bincount(own, minlength=buckets)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used])], ["bucket", "n"])

    counts = np.zeros(buckets, dtype=np.int64)
    for bucket, n in texts.select(F.col("text").cast("binary")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature of each bucket adds to a weight, in thousandths of the log of the likelihood ratio."""
    k, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    ratio = lambda s, t: float(t + 1) * float(s_all + k) / (float(s + 1) * float(t_all + k))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, most: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Buckets(len(gain))
        for batch in batches:
            for piece in _pieces(batch):
                words = [words_of(t.as_py()) for t in piece.column(1)]
                own = found.of([runs(w, most) for w in words])
                columns = [np.array([len(w) for w in words], dtype=np.int64), np.array([len(x) for x in own], dtype=np.int64), np.array([gain[x].sum() for x in own], dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([piece.column(0), *map(pa.array, columns)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, most: int = 1, buckets: int = BUCKETS, seed: str = "2024") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of ``docs(doc_id, text)``.

    Features are the runs of 1 to ``most`` words of the lower-cased text (A-Z only; words are runs
    of ASCII letters, digits and all other non-ASCII characters). A weight is the sum of the gains
    of its features towards ``target(text)``; a score adds Gumbel noise that only hangs on the id,
    so the highest scores are a sample without replacement by importance. ``percent`` of the rows
    with at least ``least_words`` words are drawn; rank numbers them, ties to smaller ids and then
    any way between rows of one id; null for the others. Null or blank text: no features, weight 0.
    Null doc_id: noise of ``<seed>:``, after all other ids among ties. Other columns are ignored;
    an empty table gives no rows, an empty target gains over no target features.
    """
    gain = gains(bucket_counts(docs, most, buckets), bucket_counts(target, most, buckets))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(weighted(docs, gain, most).withColumn("score", F.col("weight") + noise).withColumn("_row", F.monotonically_increasing_id()))
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    # ranks over ranges: a place in its sorted partition, and what the partitions before hold
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    dealt = able.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = cut(dealt.withColumns({"_part": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(2**33 - 1)}).drop("_at"))
    starts, before = [], 0
    for part, n in sorted(placed.groupBy("_part").count().collect()):  # one row for each partition
        starts.append((part, before))
        before += n
    small = scored.sparkSession.createDataFrame(starts, "_part long, _start long")
    rank = F.col("_start") + F.col("_place") + 1
    ranked = placed.join(F.broadcast(small), "_part").withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank").unionByName(rest.select("doc_id", "n_features", "weight", "score", "rank"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark texts, and the tenth that importance resampling draws."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH RECURSIVE bits AS (SELECT i::BIGINT AS i, i::BIGINT AS crc, 0 AS round FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, round + 1 FROM bits WHERE round < 8),
crcs AS (SELECT list(crc ORDER BY i) AS t FROM bits WHERE round = 8),
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
s AS MATERIALIZED (SELECT doc_id, len(words) AS n, unnest(words) AS w FROM d),
feature AS MATERIALIZED (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM s UNION SELECT w FROM b)),
hashed AS MATERIALIZED (SELECT w, xor(list_reduce(list_transform(range(1, len(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT),
    lambda crc, v: xor(crc >> 8, t[(xor(crc, v) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket FROM feature, crcs),
raw AS (SELECT bucket, count(*) AS s FROM s JOIN hashed USING (w) GROUP BY 1),
target AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (w) GROUP BY 1),
gain AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM s) + 10000) / ((s + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)))) AS g FROM raw LEFT JOIN target USING (bucket)),
w AS (SELECT doc_id, sum(g)::BIGINT AS weight FROM s JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY 1),
v AS (SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM v WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM r) * 10 // 100 THEN rank END::BIGINT AS rank FROM v LEFT JOIN r USING (doc_id)
"""
