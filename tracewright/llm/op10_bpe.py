"""Byte-level BPE over Arrow batches with the tokenizers library, and the way back to bytes."""

from __future__ import annotations

import base64
import codecs
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

#: Different pieces whose ids a task remembers; past it the memory is emptied.
REMEMBERED = 200_000
#: Characters with the property White_Space, as a class of a regular expression.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters of text that are encoded before ids go on to Spark, and rows whose texts are taken out of a batch at once.
AT_ONCE, ROWS_AT_ONCE = 500_000, 512


def default_vocabulary() -> tuple[str, str]:
    """Rank file and pattern of the production query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def tokenizer(path: str):
    """A tokenizers model over byte characters that merges as the ranks say.

    Any neighbouring pair whose bytes joined are a token may merge, with that token's rank; so
    every split of a token into two tokens is a merge, in the order of ranks.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, models

    char, known = byte_characters(), ranks(path)
    shown = {token: "".join(char[b] for b in token) for token in known}
    by_rank = sorted(known, key=known.get)
    merges = [(shown[t[:i]], shown[t[i:]]) for t in by_rank for i in range(1, len(t)) if t[:i] in known and t[i:] in known]
    return Tokenizer(models.BPE(vocab={shown[t]: r for t, r in known.items()}, merges=merges, ignore_merges=True))


@cache
def byte_table(path: str) -> pa.Array:
    """Bytes of each id, from the model's own token strings read back through the byte table."""
    back = {c: b for b, c in enumerate(byte_characters())}
    tokens = {i: bytes(back[c] for c in token) for token, i in tokenizer(path).get_vocab().items()}
    return pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.binary())


#: Characters past the first 65,536; classes without them are much faster tables.
BEYOND = re.compile("[\U00010000-\U0010ffff]")


@cache
def splitter(pattern: str, codes: int) -> re.Pattern:
    """``pattern`` for Python's re, which has no letter and number classes and another idea of white space.

    It holds for texts of characters below ``codes``.
    """
    of = {"L": [], "N": []}
    for c in range(codes):
        if (kind := unicodedata.category(chr(c))[0]) in of:
            spans = of[kind]
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    inside = {rf"\p{{{k}}}": "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in v) for k, v in of.items()}
    inside[r"\s"] = WHITE
    out, in_class = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        if part == r"\S" and not in_class:
            out.append(f"[^{WHITE}]")
        elif part in inside:
            out.append(inside[part] if in_class else f"[{inside[part]}]")
        elif re.match(r"\\[A-Za-z]", part):
            raise ValueError(f"{part} isn't supported in a pattern")
        else:
            in_class = part == "[" or in_class and part != "]"
            out.append(part)
    return re.compile("".join(out))


class Pieces:
    """Ids of pieces; each different piece goes through the tokenizer once, many in one call."""

    def __init__(self, path: str):
        self.model, self.table = tokenizer(path), "".join(byte_characters())
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.first, self.ids, self.ends = np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int32)

    def learn(self, texts: list[list[str]], offsets: bool) -> None:
        if len(self.known) > REMEMBERED:
            self.clear()
        new = [p for p in {*chain.from_iterable(texts)} if p not in self.known]
        ids, ends, sizes = [self.ids], [self.ends], []
        for at in range(0, len(new), 5_000):
            part = new[at : at + 5_000]
            # bytes become characters, one for one
            got = self.model.encode([codecs.charmap_decode(p.encode("utf-8", "replace"), "strict", self.table)[0] for p in part], is_pretokenized=True, add_special_tokens=False)
            word = np.array(got.word_ids, dtype=np.int64)
            ids.append(np.array(got.ids, dtype=np.int32))
            sizes.append(np.bincount(word, minlength=len(part)))
            if offsets:  # from bytes of the piece to characters
                begins = [np.cumsum([(c & 0xC0) != 0x80 for c in p.encode("utf-8", "replace")]) for p in part]
                ends.append(np.array([begins[w][end - 1] for w, (_, end) in zip(word.tolist(), got.offsets, strict=True)], dtype=np.int32))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.ids, self.ends = np.concatenate(ids), np.concatenate(ends)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate([*sizes, np.empty(0, dtype=np.int64)]))]).astype(np.int64)


@cache
def _pieces(path: str, offsets: bool) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """(doc_id, ids[, ends]): the ids of each whole text; with ``offsets`` the character where each token ends.

    Each match of ``pattern`` is encoded by itself; what lies between matches is left out, and no
    special tokens are made. A token that holds part of a character ends where the character
    ends. Null or empty text: no ids. Rows keep their order and number; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, full, pieces = splitter(pattern, 0x10000), splitter(pattern, 0x110000), _pieces(path, offsets)

        def out(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
            split = [full if BEYOND.search(t) else plain for t in texts]
            found = [s.findall(t) for s, t in zip(split, texts, strict=True)]
            pieces.learn(found, offsets)
            number = np.fromiter(map(pieces.known.__getitem__, chain.from_iterable(found)), np.int64)
            first, size = pieces.first[number], np.diff(pieces.first)[number]
            after = np.concatenate([[0], np.cumsum(size)])
            token = np.arange(after[-1]) + np.repeat(first - after[:-1], size)
            at = pa.array(after[np.concatenate([[0], np.cumsum([len(f) for f in found])])].astype(np.int32))
            columns = [keys, pa.ListArray.from_arrays(at, pa.array(pieces.ids[token]))]
            if offsets:
                begin = np.fromiter((m.start() for s, t in zip(split, texts, strict=True) for m in s.finditer(t)), np.int32)
                columns.append(pa.ListArray.from_arrays(at, pa.array(pieces.ends[token] + np.repeat(begin, size))))
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "ends"][: len(columns)])

        for batch in slices(batches, ROWS_AT_ONCE):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            size = np.cumsum([len(t) for t in texts])
            start = 0
            while start < len(texts):
                done = size[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(size, done + AT_ONCE, "right")))
                yield out(batch.column(0).slice(start, stop - start), texts[start:stop])
                start = stop

    schema = "doc_id long, ids array<int>" + ", ends array<int>" * offsets
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded`` (binary) to rows with ``ids``: the tokens' bytes joined, so characters split over tokens are whole again.

    Unknown ids raise an error. Null ids give null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = byte_table(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            tokens = of.take(ids.flatten())
            if tokens.null_count:
                raise ValueError("an id that the vocabulary doesn't have")
            size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            at = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            joined = pc.binary_join(pa.ListArray.from_arrays(at, tokens), b"")
            joined = pc.if_else(ids.is_valid(), joined, pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, joined], [*batch.schema.names, "decoded"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{columns}, decoded binary")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of each document, and the digest of the bytes they decode to; null text is empty."""
    path, pattern = default_vocabulary()
    both = decode(encode(table(spark, sf_dir, "documents"), path, pattern), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
