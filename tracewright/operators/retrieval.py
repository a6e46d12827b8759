"""Knowledge retrieval: chunks, an inverted index and exact keyword ranking."""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.values import tokenize, word_count
from ..sources.checkpoints import held


#: What ends a line; the character that stands between units, which no line can hold then.
LINE_END, BETWEEN = r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]", "\u001e"


def _units(text: Column) -> Column:
    """Headings (lines that start with #) and paragraphs (lines between blank ones) in order, without blanks around."""
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), LINE_END, "\n")
    parted = F.regexp_replace(F.regexp_replace(lines, "(?m)^(#.*)$", f"{BETWEEN}$1{BETWEEN}"), r"(?U)\n(?:[^\S\n]*\n)+", BETWEEN)
    return F.filter(F.transform(F.split(parted, BETWEEN), lambda u: F.regexp_replace(u, r"(?U)^\s+|\s+$", "")), lambda u: u != "")


def chunk_documents(docs: DataFrame, low: int = 80, most: int = 180, joined: int = 220) -> DataFrame:
    """(doc_id, chunk_no, words, text): headings and paragraphs packed greedily into chunks, numbered from 1.

    A chunk is closed at ``low`` words. A unit that would lift it above ``most`` begins the next
    one, and no unit is split. What is left at the end joins the chunk before if both stay
    within ``joined``. Units are joined by an empty line. Null or blank text: no chunks.
    """
    chunk = "struct<text:string,words:int>"
    pairs = F.transform(_units(F.col("text")), lambda u: F.struct(u.alias("text"), word_count(u).alias("words")))
    closed = lambda units, words: F.array(F.struct(F.array_join(units, "\n\n").alias("text"), words.alias("words")))
    begin = F.struct(F.array().cast("array<string>").alias("units"), F.lit(0).alias("words"), F.array().cast(f"array<{chunk}>").alias("chunks"))

    def step(s: Column, x: Column) -> Column:
        full = (F.size(s["units"]) > 0) & (s["words"] + x["words"] > most)
        chunks = F.when(full, F.concat(s["chunks"], closed(s["units"], s["words"]))).otherwise(s["chunks"])
        units = F.when(full, F.array(x["text"])).otherwise(F.concat(s["units"], F.array(x["text"])))
        words = F.when(full, x["words"]).otherwise(s["words"] + x["words"])
        return F.when(words >= low, F.struct(F.array().cast("array<string>").alias("units"), F.lit(0).alias("words"), F.concat(chunks, closed(units, words)).alias("chunks"))).otherwise(
            F.struct(units.alias("units"), words.alias("words"), chunks.alias("chunks"))
        )

    def end(s: Column) -> Column:
        last, n = F.element_at(s["chunks"], -1), F.size(s["chunks"])
        both = F.concat(F.slice(s["chunks"], 1, n - 1), closed(F.concat(F.array(last["text"]), s["units"]), last["words"] + s["words"]))
        return F.when(F.size(s["units"]) == 0, s["chunks"]).when((n > 0) & (F.try_element_at(s["chunks"], F.lit(-1))["words"] + s["words"] <= joined), both).otherwise(F.concat(s["chunks"], closed(s["units"], s["words"])))

    rows = docs.select("doc_id", F.posexplode(F.aggregate(pairs, begin, step, end)).alias("n", "chunk"))
    return rows.select("doc_id", (F.col("n") + 1).alias("chunk_no"), F.col("chunk.words").cast("long").alias("words"), "chunk.text")


def keyword_index(chunks: DataFrame, fields: tuple[str, ...] = ("doc_id", "title", "category", "keywords", "attack_type", "attack_stage", "text")) -> DataFrame:
    """(token, chunk_id, tf): how often a token occurs in all fields of a chunk together. Fields that chunks lack count as null."""
    kinds = dict(chunks.dtypes)
    text = F.concat_ws(" ", *(F.col(c) if kinds[c].startswith("array") else F.col(c).cast("string") for c in fields if c in kinds))
    return chunks.select("chunk_id", F.explode(tokenize(text)).alias("token")).groupBy("token", "chunk_id").agg(F.count("*").alias("tf"))


def index_totals(index: DataFrame) -> DataFrame:
    """One row over ``keyword_index``: different tokens, chunks with any token, postings and occurrences."""
    tokens = index.groupBy("token").agg(F.count("*").alias("n"), F.sum("tf").alias("tf")).agg(F.count("*").alias("tokens"), F.sum("n").alias("postings"), F.sum("tf").alias("occurrences"))
    return tokens.join(F.broadcast(index.select("chunk_id").distinct().agg(F.count("*").alias("chunks"))))  # one row each


#: What a query's tokens and a chunk must hold for extra score, and how much.
METADATA_BONUS = (
    ("arrays_overlap(tokens, array('port_scan', 'scan'))", "array_contains(attack_type, 'port_scan') OR array_contains(attack_stage, 'reconnaissance')", 2),
    ("arrays_overlap(tokens, array('c2', 'cnc', 'command_and_control'))", "array_contains(attack_type, 'c2') OR array_contains(attack_stage, 'command_and_control')", 2),
    ("arrays_overlap(tokens, array('exploit', 'ms17-010'))", "array_contains(attack_type, 'exploit') OR array_contains(attack_stage, 'initial_access')", 2),
    ("array_contains(tokens, 'protocol') AND array_contains(tokens, 'anomaly')", "category IN ('false_positive_rules', 'signatures', 'protocols')", 3),
    ("array_contains(tokens, 'low') AND array_contains(tokens, 'confidence')", "category = 'false_positive_rules'", 2),
)
SIGNATURE_NAMES, SIGNATURE_BONUS = ("strrat", "ms17-010", "doublepulsar", "sql injection", "xss", "dns tunnel"), 8
WEIGHTS = tuple(w for _, _, w in METADATA_BONUS) + (SIGNATURE_BONUS,) * len(SIGNATURE_NAMES)


def _bits(tests: list) -> Column:
    """One number with a bit for each test that holds."""
    return reduce(lambda total, x: total + F.when(x[1], 1 << x[0]).otherwise(0), enumerate(tests), F.lit(0))


def _bonus(a: Column, b: Column) -> Column:
    both = a.bitwiseAND(b)
    return reduce(lambda total, x: total + F.when(both.bitwiseAND(F.lit(1 << x[0])) != 0, x[1]).otherwise(0), enumerate(WEIGHTS), F.lit(0))


def _query_bits() -> Column:
    """Which bonuses a query with columns tokens and named is open to."""
    return _bits([F.expr(q) for q, _, _ in METADATA_BONUS] + [F.contains("named", F.lit(n)) for n in SIGNATURE_NAMES])


def _chunk_bits() -> Column:
    """Which bonuses a chunk with all fields and blob is open to."""
    return _bits([F.expr(c) for _, c, _ in METADATA_BONUS] + [F.contains("blob", F.lit(n)) for n in SIGNATURE_NAMES])


#: Columns of a chunk that may be missing; they count as null then.
CHUNK_FIELDS = {"title": "string", "keywords": "string", "text": "string", "category": "string", "attack_type": "array<string>", "attack_stage": "array<string>"}
#: Shortest term that is looked for as a substring, and what one is worth; what a token is worth in title, keywords and text.
TERM_LENGTH, TERM, TITLE, KEYWORD, TEXT = 4, 3.0, 3.0, 4.0, 0.5
#: Where words end: after a blank of any kind.
AFTER_BLANK = r"(?<=\s)"
#: Stands before terms among tokens.
AS_TERM = "\u0001"
#: Tokens of a text in lower case, the marks that go from their ends, and blanks of any kind, as ``tokenize`` and Spark's patterns have them.
TOKENS, EDGES, BLANK = re.compile("[A-Za-z0-9_.:/+-]+|[\u4e00-\u9fff]+"), ".,;()[]{}<>\"'", re.compile("[ \t\n\u000b\f\r]+")


def _plain(chunks: DataFrame) -> DataFrame:
    """Chunks with all fields, keywords as one string, and ``blob``: title, keywords and text in lower case."""
    full = chunks.withColumns({c: F.lit(None).cast(t) for c, t in CHUNK_FIELDS.items() if c not in chunks.columns})
    full = full.withColumn("keywords", F.concat_ws(" ", "keywords"))
    return full.withColumn("blob", F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), "keywords", F.coalesce("text", F.lit("")))))


def _token_set(field: str) -> Column:
    return F.array_distinct(F.coalesce(tokenize(F.col(field)), F.array().cast("array<string>")))


def token_postings(chunks: DataFrame) -> DataFrame:
    """(key, chunk_id, worth, texts, exact): each token of a chunk, what it is worth beside the text, and whether it is in the text."""
    rows = chunks.select("chunk_id", *(_token_set(c).alias(n) for c, n in (("title", "a"), ("keywords", "b"), ("text", "t"))))
    entry = lambda inside: lambda x: F.struct(x.alias("key"), (F.when(F.array_contains("a", x), TITLE).otherwise(0.0) + F.when(F.array_contains("b", x), KEYWORD).otherwise(0.0)).alias("worth"), F.lit(inside).alias("texts"))
    listed = F.concat(F.transform("t", entry(1)), F.transform(F.array_except(F.array_union("a", "b"), "t"), entry(0)))
    return rows.select("chunk_id", F.explode(listed).alias("x")).select("x.key", "chunk_id", "x.worth", "x.texts", F.lit(TERM).alias("exact"))


def terms_inside(runs: Iterable[str], terms: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """(run, term) by their places: which terms, of four characters or more, occur anywhere in which runs; a pair may come twice.

    A term is looked up as a whole wherever its first four characters stand, once for each length
    of the terms that begin so, never term by term.
    """
    places, lengths = {t: i for i, t in enumerate(terms)}, {}
    for t in places:
        lengths.setdefault(t[:TERM_LENGTH], set()).add(len(t))
    found = [(r, j) for r, run in enumerate(runs) for i in range(len(run) - TERM_LENGTH + 1) for n in lengths.get(run[i : i + TERM_LENGTH], ()) if (j := places.get(run[i : i + n])) is not None]
    out = np.array(found, dtype=np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def phrases_inside(texts: Iterable[bytes], phrases: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, phrase) by their places: which phrases, of four bytes or more, occur anywhere in which texts; a pair may come twice.

    All phrases are looked for at once by eight bytes from their middle (short ones as a whole); the
    rest of a phrase is compared only where these stand.
    """
    texts = list(texts)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    data = b"".join(texts)
    every = np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))
    kinds: dict[int, dict[int, list[tuple[int, bytes, int]]]] = {}
    for j, p in enumerate(phrases):
        n = min(8, len(p))
        middle = (len(p) - n) // 2
        kinds.setdefault(n, {}).setdefault(int.from_bytes(p[middle : middle + n], "little"), []).append((middle, p, j))
    found = []
    for n, wanted in kinds.items():
        mask, mixer, shift = np.uint64(2 ** (8 * n) - 1), np.uint64(0x9E3779B97F4A7C15), np.uint64(44)
        sought = np.array(sorted(wanted), dtype=np.uint64)
        likely = np.zeros(2**20, dtype=bool)
        likely[sought * mixer >> shift] = True
        for at in range(0, len(data), 2**20):
            part = every[at : at + 2**20] & mask
            here = np.flatnonzero(likely[part * mixer >> shift])
            place = np.minimum(np.searchsorted(sought, part[here]), len(sought) - 1)
            here, place = here[sought[place] == part[here]] + at, place[sought[place] == part[here]]
            rows = np.searchsorted(ends, here, "right")
            for i, r, w in zip(here.tolist(), rows.tolist(), sought[place].tolist(), strict=True):
                low, high = int(ends[r - 1]) if r else 0, int(ends[r])
                found += [(r, j) for middle, p, j in wanted[w] if i - middle >= low and i - middle + len(p) <= high and data.startswith(p, i - middle)]
    out = np.array(found, dtype=np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def phrase_matches(phrases: DataFrame, chunks: DataFrame) -> DataFrame:
    """(term, chunk_id) of the chunks whose ``blob`` holds a term with blanks of any kind as it stands.

    The blob and the terms are cut after each blank, tab or line end, which stays with the word before
    it. A term begins with the end of a piece, ends with the begin of one, and its other words are whole
    pieces in a row between them. Each term is looked up by the word that matches fewest positions; the
    others are compared only where that one stands, at the positions before and after.
    """
    positions = chunks.select("chunk_id", F.posexplode(F.split("blob", AFTER_BLANK)).alias("at", "piece"))
    words = phrases.select("term", F.split("term", AFTER_BLANK).alias("words")).select("term", F.size("words").alias("n"), F.posexplode("words").alias("j", "word"))
    side = F.when(F.col("j") == 0, "end").when(F.col("j") == F.col("n") - 1, "begin").otherwise("whole")
    short = F.least(F.length("word"), F.when(F.col("side") == "end", 5).otherwise(4))
    key = F.when(F.col("side") == "end", F.right("word", short)).when(F.col("side") == "begin", F.left("word", short)).otherwise(F.col("word"))
    words = words.withColumn("side", side).withColumn("key", key)
    pieces = positions.groupBy("piece").agg(F.count("*").alias("times"))
    ends = F.transform(F.sequence(F.lit(0), F.least(F.length("piece"), F.lit(5))), lambda i: F.struct(F.lit("end").alias("side"), F.right("piece", i).alias("key")))
    begins = F.transform(F.sequence(F.lit(0), F.least(F.length("piece"), F.lit(4))), lambda i: F.struct(F.lit("begin").alias("side"), F.left("piece", i).alias("key")))
    whole = F.array(F.struct(F.lit("whole").alias("side"), F.col("piece").alias("key")))
    keyed = pieces.select("piece", "times", F.explode(F.concat(whole, ends, begins)).alias("x")).select("piece", "times", "x.side", "x.key")
    holds = lambda piece: F.when(F.col("side") == "end", F.endswith(piece, F.col("word"))).when(F.col("side") == "begin", F.startswith(piece, F.col("word"))).otherwise(piece == F.col("word"))
    fits = held(words.join(keyed, ["side", "key"]).where(holds(F.col("piece"))).select("term", "n", "j", "piece", "times"))
    rarest = fits.groupBy("term", "j").agg(F.sum("times").alias("times")).groupBy("term").agg(F.min(F.struct("times", "j"))["j"].alias("j"))
    starts = positions.join(fits.join(rarest, ["term", "j"]), "piece").select("term", "n", "chunk_id", (F.col("at") - F.col("j")).alias("start"), "j")
    others = starts.withColumnRenamed("j", "anchor").where("start >= 0").join(words.select("term", "j", "word", "side"), "term").where("j <> anchor")
    wanted = others.select("term", "n", "chunk_id", "start", "word", "side", (F.col("start") + F.col("j")).alias("at"))
    right = wanted.join(positions, ["chunk_id", "at"]).where(holds(F.col("piece")))
    return right.groupBy("term", "n", "chunk_id", "start").agg(F.count("*").alias("met")).where("met = n - 1").select("term", "chunk_id").distinct()


def _asked(queries: DataFrame) -> DataFrame:
    """(query_id, tokens, terms, named) of each query; without ``terms``, its tokens are its terms."""
    given = "terms" in queries.columns
    joined = F.concat_ws(" ", "terms") if given else F.coalesce("query", F.lit(""))
    said = F.concat_ws(" ", joined, F.coalesce("query", F.lit(""))) if given else joined
    tokens = F.array_distinct(tokenize(said))
    terms = F.array_distinct(F.transform(F.coalesce("terms", F.array().cast("array<string>")), F.lower)) if given else tokens
    return queries.select("query_id", tokens.alias("tokens"), F.filter(terms, lambda t: F.length(t) >= TERM_LENGTH).alias("terms"), F.lower(joined).alias("named"))


def candidates(asks: DataFrame, postings: DataFrame, asked: DataFrame, room: int, text_cap: int, seeds: int) -> DataFrame:
    """(query_id, chunk_id, worth, texts): what the postings add to each pair that can be among the ``room`` best of its query.

    ``asks(query_id, key, factor)``: a term counts ``factor`` times what its posting is worth as
    one. Each query's rarest keys, of some ``seeds`` postings, give scores that its ``room``-th best
    can't fall below. Its commonest keys, as long as all they could add together with the bonuses
    stays below that, are no reason to look at a chunk: only chunks under the other keys are
    gathered, and of these only those that the common ones may still lift so far are probed for them.
    """
    most = postings.groupBy("key").agg(F.count("*").alias("n"), F.max("worth").alias("w"), F.max("exact").alias("x"), F.max("texts").alias("t"))
    sized = asks.join(most, "key").withColumn("up", F.col("w") + F.col("x") * F.col("factor"))
    rare, common = (Window.partitionBy("query_id").orderBy(o("n"), o("key")) for o in (F.asc, F.desc))
    sized = held(sized.withColumn("_seen", F.sum("n").over(rare)).withColumn("_first", F.row_number().over(rare) == 1))
    hit = lambda keys: keys.join(postings, "key").select("query_id", "chunk_id", (F.col("worth") + F.col("exact") * F.col("factor")).alias("worth"), "texts")
    summed = lambda rows: rows.groupBy("query_id", "chunk_id").agg(F.sum("worth").alias("worth"), F.sum("texts").alias("texts"))
    score = F.col("worth") + TEXT * F.least("texts", F.lit(text_cap))
    seeded = summed(hit(sized.where(F.col("_first") | (F.col("_seen") <= seeds)))).select("query_id", score.alias("score"))
    last = seeded.withColumn("_n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))).where(F.col("_n") == room)
    floor = last.select("query_id", F.col("score").alias("floor"))
    reach = F.sum("up").over(common) + TEXT * F.least(F.sum("t").over(common), F.lit(text_cap)) + F.col("extra")
    parted = sized.join(floor, "query_id", "left").join(asked.select("query_id", _bonus(F.col("q_bits"), F.col("q_bits")).alias("extra")), "query_id").withColumn("probe", F.coalesce(reach < F.col("floor"), F.lit(False)))
    parted = held(parted.select("query_id", "key", "factor", "floor", "extra", "probe", "up", "t"))
    rest = parted.where("probe").groupBy("query_id").agg(F.sum("up").alias("more"), F.sum("t").alias("more_texts"), F.first("floor").alias("floor"), F.first("extra").alias("extra"))
    found = summed(hit(parted.where("not probe"))).join(rest, "query_id", "left")
    best = F.col("worth") + F.col("more") + TEXT * F.least(F.col("texts") + F.col("more_texts"), F.lit(text_cap)) + F.col("extra")
    able = held(found.where(F.col("floor").isNull() | (best >= F.col("floor"))).select("query_id", "chunk_id", "worth", "texts", F.col("floor").isNotNull().alias("open")))
    probed = able.where("open").select("query_id", "chunk_id").join(parted.where("probe").select("query_id", "key", "factor"), "query_id").join(postings, ["key", "chunk_id"])
    more = probed.select("query_id", "chunk_id", (F.col("worth") + F.col("exact") * F.col("factor")).alias("worth"), "texts")
    return summed(able.select("query_id", "chunk_id", "worth", "texts").unionByName(more))


#: Expected chunks of a shard (least and most) and queries of a block.
SHARD_CHUNKS, BLOCK_QUERIES = (1024, 4096), 16384


def _values(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Items of all lists, and the row of each."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    return lists.flatten(), np.repeat(np.arange(len(lists), dtype=np.int32), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))


def _shard_postings(keys: pa.Array, rows: pa.Table) -> tuple[np.ndarray, ...]:
    """(starts, at, worth, both, texts): postings of the keys over the rows of a shard, by key, then row.

    Worth is what the key adds beside the text, ``both`` that and a term, ``texts`` whether it is in the text.
    """
    n, known = max(1, len(rows)), {t: i for i, t in enumerate(keys.to_pylist())}
    fields, runs, code, at, blobs = [array("q") for _ in range(3)], {}, array("q"), array("q"), []
    for r, texts in enumerate(zip(*(rows[c] for c in ("title", "keywords", "text")), strict=True)):
        texts = [t.as_py() for t in texts]
        for found, text in zip(fields, texts, strict=True):
            found.extend(known[t] * n + r for t in {x.strip(EDGES) for x in TOKENS.findall(text)} if len(t) > 1 and t in known)
        blob = " ".join(texts)
        own = {x for x in BLANK.split(blob) if len(x) >= TERM_LENGTH}
        code.extend(runs.setdefault(x, len(runs)) for x in own)
        at.extend([r] * len(own))
        blobs.append(blob.encode())
    fields, code, at = [np.array(x, dtype=np.int64) for x in fields], np.array(code, dtype=np.int64), np.array(at, dtype=np.int64)
    tokens = np.unique(np.concatenate(fields))
    title, keyword, text = (np.isin(tokens, x, assume_unique=True).astype(np.float32) for x in fields)
    # terms without blanks inside runs, and phrases in whole texts: each once a row, unless the row has it as a token
    named = np.flatnonzero(np.asarray(pc.starts_with(keys, AS_TERM)))
    terms = pc.utf8_slice_codeunits(keys.take(pa.array(named)), 1)
    spoken = terms.to_pylist()
    parted = np.array([bool(BLANK.search(t)) for t in spoken], dtype=bool)
    run, term = terms_inside(runs, [t for t, blank in zip(spoken, parted, strict=True) if not blank])
    order = np.argsort(run, kind="stable")
    first = np.searchsorted(run[order], np.arange(len(runs) + 1))
    times = (first[1:] - first[:-1])[code]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    inside = np.flatnonzero(~parted)[term[order[np.repeat(first[:-1][code], times) + within]]] * n + np.repeat(at, times)
    row, phrase = phrases_inside(blobs, [t.encode() for t, blank in zip(spoken, parted, strict=True) if blank])
    hits = np.unique(np.concatenate([inside, np.flatnonzero(parted)[phrase] * n + row]))
    as_token = np.asarray(pc.fill_null(pc.index_in(keys, value_set=terms), -1)).astype(np.int64)[tokens // n]
    hits = np.setdiff1d(hits, (as_token * n + tokens % n)[as_token >= 0], assume_unique=True)
    places = np.concatenate([tokens, named[hits // n] * n + hits % n])
    order = np.argsort(places, kind="stable")
    filled = lambda x: np.concatenate([x, np.zeros(len(hits), np.float32)])[order]
    worth, texts = filled(np.float32(TITLE) * title + np.float32(KEYWORD) * keyword), filled(text)
    return np.searchsorted(places[order], np.arange(len(keys) + 1) * n), (places[order] % n).astype(np.int32), worth, worth + np.float32(TERM), texts


def _shard_best(queries: pa.Table, rows: pa.Table, room: int, text_cap: int, seeds: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, scores): the ``room`` best rows of a shard for each query, best first, ties to earlier rows; only positive scores.

    Each query's rarest keys, of some ``seeds`` postings, give scores that its ``room``-th best can't
    fall below. Its commonest keys, as long as all they could add together with the bonuses stays
    below that, are only probed for rows that they may still lift so far.
    """
    asked, asker = _values(queries["asks"])
    keys = pc.unique(asked.field("key"))
    starts, at, worth, both, texts = _shard_postings(keys, rows)
    wanted, factor = np.asarray(pc.index_in(asked.field("key"), value_set=keys)), np.asarray(asked.field("factor"))
    ends, n = np.searchsorted(asker, np.arange(len(queries) + 1)), len(rows)
    most = np.zeros((2, len(keys)), np.float32)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    if len(full):
        most[:, full] = np.maximum.reduceat(worth, starts[full]), np.maximum.reduceat(texts, starts[full])
    kinds, kind = np.unique(np.asarray(rows["c_bits"]), return_inverse=True)
    bonuses = {}
    for q, bits in enumerate(queries["q_bits"].to_pylist()):
        if bits not in bonuses:
            bonuses[bits] = np.array([sum(w for i, w in enumerate(WEIGHTS) if int(bits) & int(c) & 1 << i) for c in kinds], np.float32)[kind]
        bonus = bonuses[bits]
        own = np.arange(ends[q], ends[q + 1])
        size = starts[wanted[own] + 1] - starts[wanted[own]]
        own = own[size > 0][np.argsort(size[size > 0], kind="stable")]
        sum_worth, sum_texts = np.zeros(n, np.float32), np.zeros(n, np.float32)

        def add(j: int) -> None:
            part = slice(starts[wanted[j]], starts[wanted[j] + 1])
            sum_worth[at[part]] += both[part] if factor[j] else worth[part]  # noqa: B023
            sum_texts[at[part]] += texts[part]  # noqa: B023

        score = lambda: sum_worth + TEXT * np.minimum(sum_texts, text_cap)  # noqa: E731, B023
        seen = np.cumsum(starts[wanted[own] + 1] - starts[wanted[own]])
        rare = max(1, int(np.searchsorted(seen, seeds, "right")))
        for j in own[:rare]:
            add(j)
        rest, floor = own[rare:], np.float32(0)
        if len(rest) and n > room:
            floor = np.partition(score(), n - room)[n - room]
        # what the keys from here on to the commonest can add at the most
        up = np.cumsum((most[0][wanted[rest]] + TERM * factor[rest])[::-1])[::-1]
        up_texts = np.cumsum(most[1][wanted[rest]][::-1])[::-1]
        probed = int(np.count_nonzero(up + TEXT * np.minimum(up_texts, text_cap) + bonus.max(initial=0) < floor))
        near, common = rest[: len(rest) - probed], rest[len(rest) - probed :]
        for j in near:
            add(j)
        alive = np.arange(n)
        if probed:
            alive = np.flatnonzero(sum_worth + up[len(near)] + TEXT * np.minimum(sum_texts + up_texts[len(near)], text_cap) + bonus >= floor)
            for j in common:
                listed = at[starts[wanted[j]] : starts[wanted[j] + 1]]
                place = np.minimum(np.searchsorted(listed, alive), len(listed) - 1)
                there, place = alive[listed[place] == alive], place[listed[place] == alive] + starts[wanted[j]]
                sum_worth[there] += both[place] if factor[j] else worth[place]
                sum_texts[there] += texts[place]
        total = (score() + bonus)[alive]
        least = np.partition(total, len(total) - room)[len(total) - room] if len(total) > room else 0
        best = np.flatnonzero((total >= least) & (total > 0))
        best = best[np.argsort(-total[best], kind="stable")][:room]
        if len(best):
            yield q, alive[best], total[best]


def best_chunks(asked: DataFrame, chunks: DataFrame, room: int, text_cap: int, seeds: int) -> DataFrame:
    """(query_id, doc_id, chunk_id, score): the ``room`` best chunks of each query, ties to the smaller document, then chunk.

    ``asked(query_id, q_bits, asks)`` and ``chunks(chunk_id, doc_id, c_bits, title, keywords, text)`` (in lower case, not null):
    chunks are dealt by hash into shards, queries into blocks, and each pair of a shard and a block is
    one group of bounded size that gives at most ``room`` rows a query. Shards grow with the
    square root of the table, their number with the rest.
    """
    n, m = chunks.count(), asked.count()
    shards = math.ceil(max(n, 1) / min(SHARD_CHUNKS[1], max(SHARD_CHUNKS[0], 16 * math.isqrt(n))))
    blocks = math.ceil(max(m, 1) / BLOCK_QUERIES)
    dealt = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("long")
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    left = asked.select("*", every(shards).alias("shard"), dealt("query_id", blocks).alias("block"))
    right = chunks.select("*", dealt("chunk_id", shards).alias("shard"), every(blocks).alias("block"))
    schema = StructType([asked.schema["query_id"], chunks.schema["doc_id"], chunks.schema["chunk_id"], StructField("score", DoubleType())])

    def pair(queries: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("doc_id", "ascending"), ("chunk_id", "ascending")], null_placement="at_start"))
        found = list(_shard_best(queries, rows, room, text_cap, seeds)) if len(queries) and len(rows) else []
        joined = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        who, where = pa.array(joined([np.full(len(r), q) for q, r, _ in found], np.int64)), pa.array(joined([r for _, r, _ in found], np.int64))
        return pa.table({"query_id": queries["query_id"].take(who), "doc_id": rows["doc_id"].take(where), "chunk_id": rows["chunk_id"].take(where), "score": joined([s for _, _, s in found], np.float64)})

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(pair, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id", "chunk_id")
    return found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= room).drop("_n")


def retrieve_top_k(queries: DataFrame, chunks: DataFrame, k: int = 5, text_cap: int = 20, pinned: DataFrame | None = None, most_pinned: int = 3, seeds: int = 2000) -> DataFrame:
    """(query_id, rank, chunk_id, score, pinned) of ``queries(query_id, query, terms)`` over ``chunks(chunk_id, doc_id, title, keywords, text, ...)``.

    Score: 3 for each query token in the title, 4 in the keywords, half for each in the text (up
    to ``text_cap``), and 3 for each query term of four characters or more, of one or several words,
    that occurs anywhere in them as a substring; then the bonuses for metadata (attack_type,
    attack_stage, category) and for signature names among the terms. Tokens are those of terms and
    query together; without a column ``terms`` the query's tokens are its terms. Case doesn't count.
    Only positive scores count; ties to the smaller document, then chunk. Columns that chunks lack
    count as null; null or blank queries find nothing.

    ``pinned(query_id, place, doc_id)`` names documents whose chunks come first whatever their
    score (1000, 999, ...): the first ``most_pinned`` documents and of them as many chunks. They
    don't count among the k.

    Each shard of the chunks is scored for a block of queries at once (``best_chunks``), so a pair of a
    query and a chunk is a place in an array and never a row; only a shard's best are. Texts move
    once for a block, as they stand; their words, and where phrases are in them, never are rows.
    """
    asks = F.concat(
        F.transform("tokens", lambda t: F.struct(t.alias("key"), F.array_contains("terms", t).cast("int").alias("factor"))),
        F.transform("terms", lambda t: F.struct(F.concat(F.lit(AS_TERM), t).alias("key"), F.lit(1).alias("factor"))),
    )
    asked = held(_asked(queries).where("query_id is not null").select("query_id", _query_bits().alias("q_bits"), asks.alias("asks")))
    full = _plain(chunks).where("chunk_id is not null")
    lowered = [F.lower(F.coalesce(c, F.lit(""))).alias(c) for c in ("title", "keywords", "text")]
    listed = full.select("chunk_id", "doc_id", _chunk_bits().alias("c_bits"), *lowered)
    room = k + most_pinned
    scored = best_chunks(asked, listed, room, text_cap, seeds)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id", "chunk_id")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if pinned is None:
        return ranked(scored).select("query_id", "rank", "chunk_id", "score", F.lit(False).alias("pinned"))
    firsts = pinned.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy("place"))).where(F.col("n") <= most_pinned)
    fixed = firsts.join(chunks.select("doc_id", "chunk_id"), "doc_id")
    fixed = fixed.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("place", "chunk_id"))).where(F.col("rank") <= most_pinned)
    fixed = fixed.select("query_id", "rank", "chunk_id", (1001.0 - F.col("rank")).alias("score"), F.lit(True).alias("pinned"))
    before = fixed.groupBy("query_id").agg(F.count("*").alias("before"))
    rest = ranked(scored.join(fixed, ["query_id", "chunk_id"], "left_anti")).join(before, "query_id", "left")
    rest = rest.select("query_id", (F.col("rank") + F.coalesce("before", F.lit(0))).cast("int").alias("rank"), "chunk_id", "score", F.lit(False).alias("pinned"))
    return fixed.unionByName(rest)


def query_terms(records: DataFrame, rules: tuple[tuple[str, str], ...], most: int = 100) -> DataFrame:
    """(record_id, terms, low_signal): terms of all rules whose SQL condition holds, in rule order, each once; none is low signal."""
    terms = F.flatten(F.array(*(F.when(F.expr(test), F.split(F.lit(words), " ")).otherwise(F.array().cast("array<string>")) for test, words in rules)))
    return records.select("record_id", F.slice(F.array_distinct(terms), 1, most).alias("terms")).withColumn("low_signal", F.size("terms") == 0)
