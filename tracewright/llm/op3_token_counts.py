"""Token counts of documents in flat, unindexed token files.

A file is a run of token numbers in which an end-of-document number closes each document. It is
read as blocks that know nothing of documents: each block is searched for the number at once, and
a prefix scan over the blocks of a file joins what lies on either side of a block's edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Token numbers are unsigned 16-bit; bytes are their own tokens, so the next number is free.
TOKEN, SEPARATOR = np.dtype("<u2"), 256
#: Tokens of a block, documents of a file.
BLOCK, FILE_DOCS = 1 << 18, 256


def filed(docs: DataFrame, docs_per_file: int = FILE_DOCS) -> DataFrame:
    """(file, piece, doc_no, doc_id, text): where each document lies; it is number ``doc_no`` of its file's piece.

    A file takes the ids from one multiple of ``docs_per_file`` to the next; rows without an id
    make up file null. Where ids are missing or repeated, a file has too many rows and is cut
    into pieces by a hash of the text, of about ``docs_per_file`` rows each; piece 0 is the only
    one elsewhere. Documents are in order of doc_id, then of a hash of the text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.floor(F.col("doc_id") / docs_per_file).cast("long").alias("file"), F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("_hash"))
    large = rows.groupBy("file").count().where(F.col("count") > docs_per_file).select(F.col("file").alias("_file"), F.ceil(F.col("count") / docs_per_file).alias("_pieces"))
    if large.isEmpty():  # nothing to cut, so texts needn't move for it
        cut = rows.withColumn("piece", F.lit(0).cast("long"))
    else:
        cut = rows.join(large, F.col("file").eqNullSafe(F.col("_file")), "left").withColumn("piece", F.pmod("_hash", F.coalesce("_pieces", F.lit(1))).cast("long"))
    order = Window.partitionBy("file", "piece").orderBy("doc_id", "_hash")
    return cut.withColumn("doc_no", F.row_number().over(order).cast("long") - 1).select("file", "piece", "doc_no", "doc_id", "text")


def pack(docs: DataFrame, docs_per_file: int = FILE_DOCS, block: int = BLOCK) -> DataFrame:
    """Lay the bytes of each text into flat files as ``filed`` says: (file, piece, block, payload).

    Null or empty text is a document of no tokens.
    """

    def run(file: pa.Table) -> pa.Table:
        end = np.array([SEPARATOR], dtype=TOKEN)
        parts = []
        for text in file.sort_by("doc_no")["text"]:
            parts += [np.frombuffer(text.as_py().encode("utf-8", "replace"), dtype=np.uint8).astype(TOKEN), end]
        tokens = np.concatenate(parts)
        payloads = [tokens[at : at + block].tobytes() for at in range(0, len(tokens), block)]
        names = [pa.repeat(file[c][0], len(payloads)) for c in ("file", "piece")]
        return pa.table([*names, pa.array(range(len(payloads)), pa.int64()), pa.array(payloads, pa.binary())], names=["file", "piece", "block", "payload"])

    return filed(docs, docs_per_file).select("file", "piece", "doc_no", "text").groupBy("file", "piece").applyInArrow(run, "file long, piece long, block long, payload binary")


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """(file, piece, doc_no, start, n_tokens, closed) for each document of ``blocks(file, piece, block, payload)``.

    ``start`` is the offset in the file, ``doc_no`` counts from 0. What follows a file's last
    separator is a document that isn't ``closed``; nothing follows if the file ends with one.
    Blocks may have any length, none included; a null payload is empty. Only block sizes and
    separator places leave the search, so the scan over blocks moves no tokens.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, places = [], []
            for payload in batch.column(3):
                tokens = np.frombuffer(payload.as_buffer() or b"", dtype=TOKEN) if payload.is_valid else np.empty(0, TOKEN)
                size.append(len(tokens))
                places.append(np.flatnonzero(tokens == separator))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(size, pa.int64()), pa.array(places, pa.list_(pa.int64()))], ["file", "piece", "block", "size", "places"])

    found = blocks.select("file", "piece", "block", "payload").mapInArrow(search, "file long, piece long, block long, size long, places array<long>")
    order = Window.partitionBy("file", "piece").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("places") > 0, F.col("base") + F.element_at("places", -1) + 1)
    scanned = (
        found.withColumn("base", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .withColumn("first_doc", F.coalesce(F.sum(F.size("places")).over(earlier), F.lit(0)).cast("long"))
        .withColumn("open", F.coalesce(F.max(last).over(earlier), F.lit(0).cast("long")))
        .withColumn("final", F.lead("block").over(order).isNull())
    )
    stops = F.transform("places", lambda p: F.col("base") + p)
    tail = F.array(F.col("base") + F.col("size"))
    begins = F.concat(F.array("open"), F.transform(stops, lambda s: s + 1))
    rows = scanned.select(
        "file", "piece", "first_doc", F.size("places").alias("closed_docs"), "final",
        F.posexplode(F.arrays_zip(begins.alias("start"), F.concat(stops, tail).alias("stop"))).alias("i", "doc"),
    )
    return (
        rows.withColumn("closed", F.col("i") < F.col("closed_docs"))
        .where(F.col("closed") | (F.col("final") & (F.col("doc.stop") > F.col("doc.start"))))
        .select("file", "piece", (F.col("first_doc") + F.col("i")).alias("doc_no"), F.col("doc.start").alias("start"), (F.col("doc.stop") - F.col("doc.start")).alias("n_tokens"), "closed")
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, counted in flat files of all documents, with its doc_id; null text has none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = filed(docs).select(F.col("file").alias("_file"), F.col("piece").alias("_piece"), F.col("doc_no").alias("_doc_no"), "doc_id")
    place = F.col("file").eqNullSafe(F.col("_file")) & (F.col("piece") == F.col("_piece")) & (F.col("doc_no") == F.col("_doc_no"))
    return count_tokens(pack(docs)).join(names, place).select("doc_id", "file", "piece", "doc_no", "start", "n_tokens", "closed")


ORACLE_SQL = f"""
SELECT doc_id, doc_id // {FILE_DOCS} AS file, 0::BIGINT AS piece, row_number() OVER w - 1 AS doc_no,
       (sum(coalesce(octet_length(encode(text)), 0) + 1) OVER w - coalesce(octet_length(encode(text)), 0) - 1)::BIGINT AS start,
       coalesce(octet_length(encode(text)), 0)::BIGINT AS n_tokens, true AS closed
FROM documents WINDOW w AS (PARTITION BY doc_id // {FILE_DOCS} ORDER BY doc_id, text ROWS UNBOUNDED PRECEDING)
"""
