"""Document fingerprints by one-permutation MinHash with optimal densification.

Every shingle is hashed once; the top bits of the hash choose a bin and each bin keeps its least
hash. An empty bin borrows from the bins that a hash of its own number probes one after another
(Shrivastava, 2017), so equal sets borrow alike. Only the low bits of each bin are stored, and the
share of chance matches is taken out of the estimate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, table

#: Words of a shingle, bins (a power of two), bits stored for each.
WORDS, BINS, LOW_BITS = 5, 128, 8
#: Rows of a run of ids that are put in order together, while there are no more than so many runs.
RUN_ROWS, RUNS = 512, 16384


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """64-bit hashes of the shingles: of each word first, then of each run of words. Fewer words: one shingle of all."""
    one = F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        n = F.size(h)
        whole = F.when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(n <= words, whole).otherwise(F.transform(F.sequence(F.lit(0), n - words), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(words)))))

    return F.transform(F.array(one), runs)[0]


def bins_of(hashes: Column, bins: int = BINS, low_bits: int = LOW_BITS) -> Column:
    """Low bits of each bin's least hash after densification; all null for no hashes.

    In order of the unsigned hash, the first of each bin is its least.
    """
    width = bins.bit_length() - 1
    ordered = F.array_sort(F.transform(hashes, lambda h: h.bitwiseXOR(F.lit(-(2**63)))))  # signed order of the unsigned number
    bin_of = lambda h: F.shiftrightunsigned(h.bitwiseXOR(F.lit(-(2**63))), 64 - width).cast("int")

    def least(sorted_hashes: Column) -> Column:
        return F.filter(sorted_hashes, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(sorted_hashes, i - 1))))

    def fill(firsts: Column) -> Column:
        held = F.map_from_arrays(F.transform(firsts, bin_of), F.transform(firsts, lambda h: h.bitwiseAND(F.lit((1 << low_bits) - 1)).cast("int")))
        return F.transform(F.array(held), lambda m: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.get(F.array(m[b]), F.lit(0))))[0]

    def densify(values: Column) -> Column:
        def probe(b: Column, tries: int) -> Column:
            start, step = F.xxhash64(b, F.lit(1)), F.xxhash64(b, F.lit(2)).bitwiseOR(F.lit(1))
            places = F.sequence(F.lit(0), F.lit(tries - 1))
            at = lambda t: (start.bitwiseAND(F.lit(bins - 1)) + step.bitwiseAND(F.lit(bins - 1)) * t).bitwiseAND(F.lit(bins - 1)).cast("int")
            return F.get(F.filter(F.transform(places, lambda t: F.get(values, at(t))), lambda v: v.isNotNull()), F.lit(0))

        return F.transform(values, lambda v, b: F.coalesce(v, probe(b, 8), probe(b, bins)))

    step1 = F.transform(F.array(ordered), least)[0]
    step2 = F.transform(F.array(step1), fill)[0]
    return F.transform(F.array(step2), densify)[0]


def fingerprint(text: Column) -> Column:
    """Array of the stored low bits of each bin; equal texts give equal arrays, null text is empty text."""
    return bins_of(shingle_hashes(F.coalesce(text, F.lit(""))))


def packed(values: Column, low_bits: int = LOW_BITS) -> Column:
    """Hex string of the fingerprint; empty for a text without words."""
    return F.array_join(F.transform(values, lambda v: F.lpad(F.lower(F.hex(v.cast("long"))), (low_bits + 3) // 4, "0")), "")


def likeness(a: Column, b: Column, low_bits: int = LOW_BITS) -> Column:
    """Estimated resemblance, 0 to 1, without the bias of stored bits that agree by chance. Two texts without words: 1; one: 0."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: F.coalesce(e, F.lit(False)))) / F.size(a)
    chance = 2.0**-low_bits
    empty_a, empty_b = F.get(a, F.lit(0)).isNull(), F.get(b, F.lit(0)).isNull()
    return F.when(empty_a & empty_b, 1.0).when(empty_a | empty_b, 0.0).otherwise(F.greatest((same - chance) / (1 - chance), F.lit(0.0)))


def with_next(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add next_<name> of the following row by (doc_id, text), the first one's after the last.

    Ids are cut into runs at quantiles, so that a run has about RUN_ROWS rows however ids are
    spread, at most RUNS runs. Null ids come first; ids that fill whole runs are cut by
    the first characters of the text. Values are worked out for each row where it stands. The
    first row of each run is also put behind the run before it, so that nothing but these few
    rows moves once more, however many runs there are.
    """
    n = rows.count()
    parts = min(RUNS, n // RUN_ROWS) + 1
    edges = rows.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    hot = sorted({int(e) for e, after in zip(edges, edges[1:], strict=False) if e == after})
    edges = sorted({int(e) for e in edges})
    whole = F.col("doc_id").isNull() | F.col("doc_id").isin(hot)
    run = F.struct(_place(edges, F.col("doc_id")).alias("ids"), F.when(whole, 0).otherwise(1).alias("later"), F.when(whole, F.left("text", F.lit(2))).otherwise("").alias("text"))
    rows = rows.withColumn("run", run)
    starts = cut(rows.groupBy("run").agg(F.min(F.struct("doc_id", "text")).alias("first")))
    runs = Window.orderBy("run")
    before = starts.select("run", F.coalesce(F.lag("run").over(runs), F.max("run").over(Window.partitionBy())).alias("before"))
    ahead = cut(starts.join(before, "run").select("first", F.col("before").alias("run")))
    both = rows.withColumn("ahead", F.lit(False)).unionByName(ahead.select("first.*", "run", F.lit(True).alias("ahead")), allowMissingColumns=True)
    order = Window.partitionBy("run").orderBy("ahead", "doc_id", "text")
    both = both.withColumns(values)
    both = both.withColumns({f"next_{v}": F.lead(v).over(order) for v in values})
    return both.where(~F.col("ahead")).drop("run", "ahead")


def _place(edges: list[int], value: Column) -> Column:
    """Number of sorted edges that are at most the value, by blocks of edges first; -1 for null."""
    step = max(1, math.isqrt(len(edges)))
    blocks = [edges[at : at + step] for at in range(0, len(edges), step)]
    if not blocks:
        return F.when(value.isNull(), -1).otherwise(0)
    listed = lambda x: F.expr("array(" + ",".join(f"{e}L" for e in x) + ")")
    block = F.size(F.filter(listed(b[0] for b in blocks), lambda e: e <= value))
    inside = F.size(F.filter(F.slice(listed(edges), (block - 1) * step + 1, step), lambda e: e <= value))
    return F.when(value.isNull(), -1).when(value < edges[0], 0).otherwise((block - 1) * step + inside)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, with their likeness and that to the next document; null text is empty."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(docs, {"own": fingerprint(F.col("text")), "text": F.col("text")})
    n = F.length("text")
    part = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - part), F.left("next_text", part))
    rows = rows.select("doc_id", "own", "next_own", n.cast("long").alias("n_chars"), edited.alias("edited"))
    rows = rows.select("*", fingerprint(F.col("edited")).alias("other"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), packed(F.col("own")).alias("fingerprint"), packed(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
