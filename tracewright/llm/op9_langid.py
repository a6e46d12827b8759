"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

#: Cells of the hash, lengths of the n-grams, additive smoothing.
CELLS, GRAMS, SMOOTH = 1 << 16, (1, 2, 3), 0.5
#: Languages of one matrix; more make more matrices, which are scored one after another.
LANGUAGES_AT_ONCE = 64
#: Characters that are scored at once, and rows whose texts are taken out of a batch at once.
AT_ONCE, ROWS_AT_ONCE = 200_000, 512
UNDETERMINED = "und"


@cache
def _letters() -> np.ndarray:
    """For each code point: itself if a letter, else a space."""
    known = np.full(0x110000, 32, dtype=np.uint32)
    codes = [c for c in range(0x110000) if chr(c).isalpha()]
    known[codes] = codes
    return known


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of each n-gram of the lower-case letters, other characters being one space."""
    joined = "\n".join(texts).lower() if len(texts) == 1 else None
    parts = [joined] if joined is not None else [t.lower() for t in texts]
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    code = _letters()[np.frombuffer(" ".join(parts).encode("utf-32-le", "replace") + b" \0\0\0", dtype=np.uint32)]
    row = np.repeat(np.arange(len(parts)), lengths + 1)
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = (code[1:] != 32) | (code[:-1] != 32) | (row[1:] != row[:-1])  # what stands before a text doesn't count
    code, row = code[keep], row[keep]
    rows, cells = [], []
    for n in GRAMS:
        if len(code) < n:
            continue
        h = np.full(len(code) - n + 1, n, dtype=np.uint32)
        for k in range(n):
            h = (h ^ code[k : len(code) - n + 1 + k]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        fits = row[: len(h)] == row[n - 1 :]
        if n == 1:
            fits = fits & (code != 32)
        rows.append(row[: len(h)][fits])
        cells.append((h[fits] ^ (h[fits] >> np.uint32(16))) & np.uint32(CELLS - 1))
    return np.concatenate(rows), np.concatenate(cells)


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= AT_ONCE):
            size += len(texts[stop])
            stop += 1
        yield start, stop
        start = stop


class Model:
    """languages: sorted; prior: log share of all documents; weight[cell, language]: log probability."""

    def __init__(self, languages: list[str], prior: np.ndarray, counts: np.ndarray):
        self.languages, self.prior = languages, prior
        self.weight = np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * CELLS)).astype(np.float32)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log of prior and likelihood by text and language, and whether the text has letters."""
        score = np.tile(self.prior, (len(texts), 1))
        letters = np.zeros(len(texts), dtype=bool)
        for start, stop in _parts(texts):
            rows, cells = _grams(texts[start:stop])
            if len(rows):
                letters[start + np.unique(rows)] = True
                for k in range(len(self.languages)):
                    score[start:stop, k] += np.bincount(rows, weights=self.weight[cells, k], minlength=stop - start)
        return score, letters


def fit(docs: DataFrame, at_once: int = LANGUAGES_AT_ONCE) -> list[Model]:
    """Train on all rows with text and lang; an empty list if there are none.

    n-grams are counted inside tasks and only (language, cell) sums are shuffled. Each matrix has
    ``at_once`` languages at most, so that is what one broadcast and one result for the driver
    are bounded by; more languages make more matrices, none is left out.
    """
    labelled = docs.where("text is not null and lang is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    names, total = sorted(sizes), sum(sizes.values())
    return [_fitted(labelled, part := names[at : at + at_once], np.log(np.array([sizes[x] for x in part]) / total)) for at in range(0, len(names), at_once)]


def _fitted(labelled: DataFrame, languages: list[str], prior: np.ndarray) -> Model:
    number = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(languages) * CELLS, dtype=np.int64)
        for batch in slices(batches, ROWS_AT_ONCE):
            known = [(number[x], t) for x, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) if x in number]
            own, texts = np.array([k for k, _ in known], dtype=np.int64), [t for _, t in known]
            for start, stop in _parts(texts):
                rows, cells = _grams(texts[start:stop])
                sums += np.bincount(own[start:stop][rows] * CELLS + cells, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["at", "n"])

    got = labelled.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(languages) * CELLS)
    counts[got["at"].to_numpy()] = got["n"].to_numpy()
    return Model(languages, prior, counts.reshape(len(languages), CELLS).T)


def predict(docs: DataFrame, models: list[Model]) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (posterior probability, 0 to 1) to rows with ``text``.

    Null text, or text without letters: ``und`` and 0; without a model ``und`` and 0 for all
    rows. Ties go to the language that sorts first. Columns of these names are replaced. The whole
    text counts.
    """
    docs = docs.drop("lang_pred", "score")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at = docs.columns.index("text")
    out = docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0), "_top": F.lit(float("-inf")).cast("double")})
    for model in models:
        out = out.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model), at), f"{columns}, lang_pred string, score double, _top double")
    return out.drop("_top")


def _scorer(shared, at: int):
    """Better languages of one more matrix; ``score`` and ``_top`` carry the share and the log score of the best so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            before, share, top = batch.column("lang_pred").to_pylist(), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("score", "_top"))
            scores, letters = shared.value.scores([t or "" for t in batch.column(at).cast(pa.string()).to_pylist()])
            best = scores.argmax(axis=1) if len(scores) else np.empty(0, dtype=np.int64)
            new = scores[np.arange(len(best)), best]
            high = np.maximum(new, top)
            mass = np.exp(scores - high[:, None]).sum(axis=1) + np.where(share > 0, np.exp(top - high) / np.where(share > 0, share, 1), 0)
            languages = [UNDETERMINED if not ok else shared.value.languages[b] if x > t else old for ok, b, x, t, old in zip(letters, best, new, top, before, strict=True)]
            columns = [pa.array(languages, pa.string()), pa.array(np.where(letters, 1 / mass, 0.0)), pa.array(np.where(letters, high, -np.inf))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *columns], batch.schema.names)

    return run


def held_out(doc_id="doc_id"):
    """One of three documents, by the CRC of its number as text. Null id: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def keep_sure(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose text has letters and a language of posterior probability ``least`` or more.

    Where no row has text and lang to learn from, all rows whose text has letters stay.
    """
    models = fit(docs.where(~held_out()))
    if not models:
        return docs.where(F.col("text").cast("string").rlike(r"\p{L}"))
    names = {c: c if c == "text" else f"_in_{i}" for i, c in enumerate(docs.columns)}  # so that no column is taken for a prediction
    inner = docs.select(*(F.col(c).alias(n) for c, n in names.items()))
    sure = predict(inner, models).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return sure.select(*(F.col(n).alias(c) for c, n in names.items()))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each whole text, learned from the documents that aren't held out."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "lang", held_out().alias("held_out"))
    model = fit(docs.where("not held_out"))
    return predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
