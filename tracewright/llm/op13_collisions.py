"""MinHash near-duplicates by an inverted join of signature coordinates.

Two sets whose signatures agree in at least ``t`` of K coordinates share one of the K - t + 1 rarest
coordinate values of either. So each signature is only posted under those, and values that one
signature alone has need no posting at all.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .components import components
from .op7_simhash import _fixed, contracted, forest, shingle_hashes, tokens_of

#: Coordinates of a signature; odd multipliers that make the hashes of each out of one hash.
COORDINATES = 96
FACTORS = np.random.default_rng(13).integers(2**62, size=COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Standard errors by which agreeing coordinates may fall short of the similarity before a pair is ruled out, and
#: exceed it so that a pair needs no more tests in the first pass.
DOUBT, SURE = 5.0, 2.0
#: Signatures of one posting that are held against each other at once; blocks of a long posting at most.
BLOCK, BLOCKS, ROWS, COLUMNS = 2048, 24, 64, 512
#: Rows, bytes and edges that a task holds at once.
ROWS_AT_ONCE, BYTES_AT_ONCE, EDGES_AT_ONCE = 300_000, 48_000_000, 1_000_000


def least_matches(percent: int, coordinates: int = COORDINATES) -> int:
    """Agreeing coordinates below which a pair isn't looked at: DOUBT standard errors under ``percent``."""
    s = percent / 100
    return max(1, math.ceil((s - DOUBT * math.sqrt(s * (1 - s) / coordinates)) * coordinates))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the least hash of each coordinate over a set of hashes that isn't empty."""
    least = np.full(COORDINATES, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        least = np.minimum(least, (shingles[at : at + 2048, None] * FACTORS).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles; chance collisions are beyond reach of any table."""
    return np.unique(shingle_hashes(tokens_of(text), words))


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, t, n, digest, sig) of each row: set size, and for sets that aren't empty digest and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sigs = [], [], []
            for text in batch.column(2):
                own = shingle_set(text.as_py(), words)
                sizes.append(len(own))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                sigs.append(signature(own).tobytes() if len(own) else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "t", "n", "digest", "sig"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("t"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, t long, n long, digest binary, sig binary")


def postings(classes: DataFrame, percent: int) -> DataFrame:
    """(item, f, node): each class under the rarest of its coordinate values that others share.

    ``item`` is a coordinate and its value, ``f`` the number of classes that have it. Of K values, a
    class needs the K - t + 1 rarest (ties by item); those that it alone has come first and lead to
    no one, so a class with that many of its own is posted nowhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                piece = batch.slice(at, 2000)
                values = np.frombuffer(b"".join(x.as_py() for x in piece.column(1)), dtype=np.uint32).reshape(len(piece), -1).astype(np.int64)
                items = (np.arange(values.shape[1], dtype=np.int64) << 32) + values
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(piece.column(0).to_numpy(), values.shape[1])), pa.array(items.ravel())], ["node", "item"])

    items = classes.select("node", "sig").mapInArrow(run, "node long, item long")
    shared = items.groupBy("item").agg(F.count("*").alias("f")).where("f > 1")
    own = items.join(shared, "item").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("f", "item"))).alias("shared"))  # at most K a node
    prefix = COORDINATES - least_matches(percent) + 1
    wanted = F.slice("shared", 1, F.greatest(F.lit(0), F.size("shared") - (COORDINATES - prefix)))
    return own.select("node", F.explode(wanted).alias("x")).select("x.item", "x.f", "node")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with key ``k`` and their ``side``: a long posting is cut into blocks, each pair of which is one key."""
    blocks = F.least(F.lit(BLOCKS), F.ceil(F.col("f") / BLOCK)).cast("int")
    at = F.pmod(F.xxhash64("node", F.lit(13)), F.col("_blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda j: F.struct(F.least(j, F.col("_at")).alias("i"), F.greatest(j, F.col("_at")).alias("j"), (j < F.col("_at")).alias("side")))
    spread = rows.withColumn("_blocks", blocks).withColumn("_at", at).withColumn("_pair", F.explode(pair))
    return spread.withColumns({"k": F.xxhash64("item", "_pair.i", "_pair.j"), "side": F.col("_pair.side")}).drop("_blocks", "_at", "_pair", "f")


def matches(a: np.ndarray, b: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of a, rows of b, agreeing coordinates) of the pairs that agree in ``least`` coordinates or more.

    The first third of the coordinates is counted for all pairs; the others only for pairs that can still get there.
    """
    third = a.shape[1] // 3
    head = (a[:, None, :third] == b[None, :, :third]).sum(axis=2, dtype=np.int16)
    x, y = np.nonzero(head + (a.shape[1] - third) >= least)
    count = head[x, y] + (a[x, third:] == b[y, third:]).sum(axis=1, dtype=np.int16)
    good = count >= least
    return x[good], y[good], count[good]


class Merge:
    """Finds a spanning forest of the links of whole keys; exact where rows carry their sets."""

    def __init__(self, percent: int):
        self.percent, self.least = percent, least_matches(percent)
        s = percent / 100
        self.sure = math.ceil(min(1.0, s + SURE * math.sqrt(s * (1 - s) / COORDINATES)) * COORDINATES)

    def links(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        k, item, node, n = (rows.column(c).to_numpy() for c in ("k", "item", "node", "n"))
        side = rows.column("side").to_numpy(zero_copy_only=False)
        part = rows.column("part").to_numpy() if "part" in rows.column_names else node
        exact = "set" in rows.column_names
        sets = _views(rows.column("set").combine_chunks()) if exact else []
        # a pair meets under every value that both post; it is compared under the first of them only
        before = [frozenset(x for x in xs if x < i) for xs, i in zip(rows.column("items").to_pylist(), item.tolist(), strict=True)] if exact else []
        sig = _fixed(rows.column("sig").combine_chunks())
        names, place = np.unique(node, return_inverse=True)
        parts, label = np.unique(part, return_inverse=True)
        root = np.arange(len(parts))  # pieces that are one already; without parts, classes
        ends: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cuts = np.flatnonzero((k[1:] != k[:-1]) | (item[1:] != item[:-1])) + 1
        for lo, hi in zip(np.append(0, cuts).tolist(), np.append(cuts, len(k)).tolist(), strict=True):
            if hi - lo < 2 or len(np.unique(root[label[lo:hi]])) < 2:
                continue
            left = np.arange(lo, hi)[~side[lo:hi]]
            right = np.arange(lo, hi)[side[lo:hi]] if side[lo:hi].any() else left
            for i in range(0, len(left), ROWS):
                for j in range(0, len(right), COLUMNS):
                    own, other = left[i : i + ROWS], right[j : j + COLUMNS]
                    if len(np.unique(root[label[np.append(own, other)]])) < 2:
                        continue
                    x, y, count = matches(sig[own], sig[other], self.least)
                    x, y = own[x], other[y]
                    fits = (root[label[x]] != root[label[y]]) & (100 * np.minimum(n[x], n[y]) >= self.percent * np.maximum(n[x], n[y]))
                    x, y, count = x[fits], y[fits], count[fits]
                    if exact:
                        keep = []
                        for at, (u, v) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
                            if root[label[u]] != root[label[v]] and before[u].isdisjoint(before[v]) and alike(sets[u], sets[v], self.percent):
                                a, b = root[label[u]], root[label[v]]
                                root[root == max(a, b)] = min(a, b)
                                keep.append(at)
                        x, y, count = x[keep], y[keep], count[keep]
                    else:
                        surely = count >= self.sure
                        root = _merged(root, label[x[surely]], label[y[surely]])
                    ends.append((place[x], place[y], COORDINATES - count.astype(np.int64)))
        if not ends:
            return names[:0], names[:0]
        a, b, d = (np.concatenate(e) for e in zip(*ends, strict=True))
        kept = forest(a, b, d)
        return names[a[kept]], names[b[kept]]

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Forests (a, b) of some whole keys at a time; rows come sorted by key."""
        held: list[pa.RecordBatch] = []

        def edges(whole: pa.Table) -> pa.RecordBatch:
            a, b = self.links(whole)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= ROWS_AT_ONCE or sum(b.nbytes for b in held) >= BYTES_AT_ONCE:
                whole = pa.Table.from_batches(held).combine_chunks()
                k = whole.column("k").to_numpy()
                end = int(np.searchsorted(k, k[-1], "left"))
                if end:
                    yield edges(whole.slice(0, end))
                held = pa.Table.from_batches(whole.slice(end).to_batches()).combine_chunks().to_batches()
        if held:
            yield edges(pa.Table.from_batches(held).combine_chunks())


def _views(column: pa.Array) -> list[np.ndarray]:
    """The sets of a binary column, each where it lies."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    values = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return [values[a:b].view(np.uint64) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining the places a and b."""
    while len(left := np.flatnonzero(root[a] != root[b])):
        low, high = np.minimum(root[a[left]], root[b[left]]), np.maximum(root[a[left]], root[b[left]])
        root = root.copy()
        root[high] = low
        while not np.array_equal(root, root[root]):
            root = root[root]
    return root


def candidate_links(posted: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) with the same components as all links of ``posted(item, f, node)``.

    ``about(node, n, sig, ...)`` has sizes and signatures as bytes; with ``set`` and ``items`` (all
    that the node is posted under) too, links are exact, with ``part``, nodes of one part have none.
    Edges may repeat.
    """
    dealt = _dealt(posted).join(about, "node")
    columns = ["k", "item", "side", "node", "n", "sig", *(c for c in ("part", "set", "items") if c in about.columns)]
    rows = dealt.select(columns).repartition("k").sortWithinPartitions("k", "item")
    return rows.mapInArrow(Merge(percent).run, "a long, b long").distinct()


def _whole_sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(node, set) of ``classes(node, first)``: the sorted shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 100):
                piece = batch.slice(at, 100)
                sets = [shingle_set(t.as_py(), words).tobytes() for t in piece.column(1)]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sets, pa.binary())], ["node", "set"])

    wanted = classes.select("node", F.col("first.doc_id").alias("_id"), F.col("first.t").alias("_t"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")).withColumn("_t", F.xxhash64("text"))
    return texts.join(wanted, ["_id", "_t"]).dropDuplicates(["_id", "_t"]).select("node", "text").mapInArrow(run, "node long, set binary")


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, good): whether each edge holds on the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [alike(*(np.frombuffer(z.as_py(), dtype=np.uint64) for z in pair), percent) for pair in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good, pa.bool_())], ["a", "b", "good"])

    first, second = (sets.select(F.col("node").alias(c), F.col("set").alias(f"{c}_set")) for c in "ab")
    return edges.join(first, "a").join(second, "b").select("a", "b", "a_set", "b_set").mapInArrow(run, "a long, b long, good boolean")


def drawn_together(edges: DataFrame) -> DataFrame:
    """Edges with the same components as ``edges(a, b)``, but short ways: what meets in a task goes to its least node.

    Edges meet by either end in turn. A task looks at a bounded number at a time, so a node may
    have any number of edges. ``components`` then has few rounds left to make.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> pa.RecordBatch:
            a, b = (np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1))
            held.clear()
            names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            root = names[_merged(np.arange(len(names)), at[: len(a)], at[len(a) :])]
            far = root != names
            return pa.RecordBatch.from_arrays([pa.array(root[far]), pa.array(names[far])], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= EDGES_AT_ONCE:
                yield stars()
        if held:
            yield stars()

    for end in ("b", "a", "b"):
        edges = edges.select("a", "b").repartition(end).mapInArrow(run, "a long, b long")
    return edges


def groups(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root): the components of all links between ``classes``; nodes without a link may be missing.

    First, a forest of likely links, closest first, is confirmed on the whole sets; what holds makes
    pieces. An edge between two pieces that fails may hide others that hold: where there is one, all
    candidates between the pieces around it are compared by their whole sets.
    """
    posted = cut(postings(classes, percent))
    about = classes.select("node", "n", F.col("low").alias("sig"))
    tried = cut(candidate_links(posted, about, percent))
    ends = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    sets = cut(_whole_sets(docs, classes.join(ends, "node").select("node", "first"), words))
    tested = cut(_confirmed(tried, sets, percent))
    pieces = cut(components(drawn_together(tested.where("good")))).withColumnRenamed("root", "part")
    broken = cut(contracted(tested.where("not good").select("a", "b"), pieces))
    if broken.isEmpty():
        return pieces.withColumnRenamed("part", "root")
    around = broken.select(F.col("a").alias("part")).union(broken.select("b")).distinct()
    parted = cut(ends.join(pieces, "node", "left").select("node", F.coalesce("part", "node").alias("part")))
    inside = cut(parted.join(around, "part"))
    # only postings that reach several of these pieces can add a link
    met = posted.drop("f").join(inside, "node")
    several = met.groupBy("item").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("f")).where("p <> q")
    again = cut(met.join(several.select("item", "f"), "item").select("item", "f", "node"))
    lists = again.groupBy("node").agg(F.collect_list("item").alias("items"))  # no more than a node posts
    whole = about.join(inside, "node").join(sets, "node").join(lists, "node")
    merged = components(drawn_together(contracted(candidate_links(again, whole, percent), pieces))).select(F.col("node").alias("part"), "root")
    return parted.join(merged, "part", "left").select("node", F.coalesce("root", "part").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs(doc_id, text)``.

    Rows are linked if 100 * intersection >= ``percent`` * union of their sets of different shingles
    of ``words`` words, lower-cased A-Z; fewer words make one shingle. Null or blank text: an empty
    set, linked with nothing, not even its like. ``component_id`` is the smallest doc_id over links,
    the row's own included. Rows of one doc_id count by their texts. Null doc_id: such a row makes
    no links, but belongs to the component of its set, if a row with an id has that set; else its
    component is null and it is kept. Other columns are ignored; an empty table gives no rows.

    Equal sets are one class, so thousands of copies cost one signature.
    """
    rows = cut(_sets(docs, words))
    first = F.min(F.struct("doc_id", "t")).alias("first")
    found = rows.where("doc_id is not null and digest is not null").groupBy("digest").agg(first, F.min("n").alias("n"), F.min("sig").alias("sig"))
    low = F.unhex(F.regexp_replace(F.hex("sig"), "(..)......", "$1"))
    classes = cut(found.select(F.monotonically_increasing_id().alias("node"), "digest", "first", "n", "sig", low.alias("low")))
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    if classes.isEmpty():
        named = out.withColumn("component_id", F.col("doc_id"))
    else:
        roots = groups(docs, classes, words, percent)
        known = cut(classes.join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root")))
        least = known.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
        named = out.join(known.join(least, "root").select("digest", F.col("component_id").alias("_component")), "digest", "left")
        named = named.withColumn("component_id", F.coalesce("_component", "doc_id"))
    return named.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents at 85 % of five-word shingles, with their components."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
d AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM t),
c AS MATERIALIZED (SELECT md5(array_to_string(s, chr(10))) AS h, min(doc_id) AS first, any_value(s) AS s FROM d WHERE len(s) > 0 GROUP BY 1),
p AS MATERIALIZED (SELECT first, len(s) AS n, unnest(list_transform(s, lambda x: hash(x))) AS x FROM c),
l AS MATERIALIZED (SELECT p.first AS a, q.first AS b FROM p JOIN p q ON p.x = q.x AND p.first < q.first AND 100 * least(p.n, q.n) >= 85 * greatest(p.n, q.n)
    GROUP BY p.first, q.first, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT first AS a, first AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
g AS (SELECT a, min(b) AS root FROM r GROUP BY a)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(g.root, d.doc_id) AS component_id, d.doc_id = coalesce(g.root, d.doc_id) AS kept
FROM d LEFT JOIN c ON md5(array_to_string(d.s, chr(10))) = c.h AND len(d.s) > 0 LEFT JOIN g ON g.a = c.first
"""
