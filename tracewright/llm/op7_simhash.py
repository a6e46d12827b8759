"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints within ``tau`` bits, cut into m groups of bits, must lie within T_i bits of each
other on some group i as soon as the thresholds T_i sum to tau - m + 1 (-1 skips a group). Groups
hold correlated bits, so that the others stay selective; each fingerprint gets thresholds of its
own, by dynamic programming on the number of candidates that each group would bring it.

Rows are dealt by a few bits of a group's value only, and the probes are made where they arrive: so
the rows of a text that are shuffled hardly grow with the table, however many probes it needs.
Where links ask for a likeness of sets too, rows are dealt by bands of set size besides.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table
from .components import components

BITS = 64
#: What a shuffled row and a probe inside a task cost, in comparisons of two fingerprints.
ROW_COST, PROBE_COST = 300, 8
#: Counts of each group, over all bands, that the driver gets: two to this power at most.
COUNT_BITS = 17
#: Rows of one key that a task holds, comparisons that it makes for it; keys with more are cut into blocks.
ROWS_OF_KEY, PAIRS_OF_KEY, BLOCKS = 131_072, 1_000_000_000, 1_000
#: Bands of set sizes at most; all greater sets are in the last one.
BANDS = 64
#: Rows and bytes that a task holds at once, comparisons and sketch tests that it makes at once.
ROWS_AT_ONCE, BYTES_AT_ONCE, PAIRS_AT_ONCE, TESTS_AT_ONCE = 150_000, 24_000_000, 500_000, 100_000
#: Min-hashes of a sketch, four bits each; odd multipliers that make them out of one hash.
MINS = 64
FACTORS = np.random.default_rng(64).integers(2**62, size=MINS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Standard errors of a sketch: pairs further below the similarity are no links; pairs further above surely are.
DOUBT, SURE = 4.0, 2.0
#: Equal four-bit numbers of two bytes, by the bits in which they differ.
EQUAL_HALVES = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], dtype=np.uint8)


def bits_for(similarity: float) -> int:
    """Largest Hamming distance that stands for a shingle-set similarity of at least ``similarity``.

    A Jaccard similarity s of equally large sets is a cosine of 2s / (1 + s), and a bit differs
    with probability angle / pi.
    """
    return math.floor(BITS * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def shingle_hashes(tokens: list[bytes], words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``words`` words in order, repeats included; fewer words make one run."""
    import xxhash

    if not tokens:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(tokens)
    starts = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1, out=starts[1:])
    n = max(1, len(tokens) - words + 1)
    ends = starts[min(words, len(tokens)) :][:n] - 1
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)], dtype=np.uint64)


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; zero for none."""
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 50_000):
        set_bits += np.unpackbits(hashes[at : at + 50_000].byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(hashes)).tobytes(), "big")


def fingerprint_of(text: str | None, words: int) -> int:
    """SimHash of a text as an unsigned 64-bit number."""
    return majority(shingle_hashes(tokens_of(text), words))


def sketch_of(distinct: np.ndarray) -> bytes:
    """Number of different hashes (4 bytes) and four bits of each of MINS min-hashes."""
    least = np.full(MINS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(distinct), 4096):
        least = np.minimum(least, (distinct[at : at + 4096, None] * FACTORS).min(axis=0))
    low = (least >> np.uint64(40)).astype(np.uint8) & 15
    return np.array([len(distinct)], dtype="<u4").tobytes() + (low[::2] << 4 | low[1::2]).tobytes()


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) for each row; fp holds the 64 bits as a signed long. Null text: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint_of(t.as_py(), words) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, t) of the rows with a doc_id; t is a hash of the text as it stands."""
    text = F.col("text").cast("string")
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("t"))


def text_classes(docs: DataFrame, words: int) -> DataFrame:
    """(node, fp, sketch, first) for each different text of ``docs``; first is the least (doc_id, t) that has it.

    Texts of equal words are one text; texts that only share their fingerprint or doc_id aren't.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, digests, sketches = np.zeros(len(batch), dtype=np.uint64), [], []
            for i, text in enumerate(batch.column(1)):
                tokens = tokens_of(text.as_py())
                hashes = shingle_hashes(tokens, words)
                fps[i] = majority(hashes)
                digests.append(hashlib.blake2b(b" ".join(tokens), digest_size=16).digest())
                sketches.append(sketch_of(np.unique(hashes)))
            columns = [batch.column(0), batch.column(2), pa.array(fps.view(np.int64)), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t", "fp", "digest", "sketch"])

    rows = _keyed(docs).mapInArrow(run, "doc_id long, t long, fp long, digest binary, sketch binary")
    firsts = rows.groupBy("fp", "digest", "sketch").agg(F.min(F.struct("doc_id", "t")).alias("first"))
    return firsts.select(F.monotonically_increasing_id().alias("node"), "fp", "sketch", "first")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint64).byteswap().view(np.uint8).reshape(-1, 8), axis=1)


def correlated_groups(counts: np.ndarray, n: int, m: int) -> list[list[int]]:
    """Deal 64 bits into m groups of nearly equal size, each grown from the bit most correlated with it.

    counts[i, j]: fingerprints with bits i and j set.
    """
    mean = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    tie = np.abs(counts / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    free, groups = set(range(BITS)), []
    for g in range(m):
        width = (BITS - sum(map(len, groups)) + m - g - 1) // (m - g)
        seed = max(free, key=lambda b: (tie[b, sorted(free)].sum(), -b))
        group = [seed]
        free.remove(seed)
        while len(group) < width:
            best = max(free, key=lambda b: (tie[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(group)
    return groups


def group_count(n: float, tau: int, part: int, row_cost: int = ROW_COST) -> int:
    """Number of groups that keeps rows, probes and candidates cheapest if bits were independent; keys hold ``part`` bits of a value."""

    def cost(m: int) -> float:
        width, budget = BITS / m, tau - m + 1
        low, more = divmod(budget, m)
        ball = lambda w, e: sum(math.comb(w, k) for k in range(e + 1))
        both = lambda w: more * ball(w, low + 1) + (m - more) * ball(w, low)
        return (m + both(min(part, math.floor(width)))) * row_cost + both(math.floor(width)) * (PROBE_COST + n / 2**width)

    return min(range(2, tau + 2), key=cost) if tau else 1


def masks_within(width: int, radius: int) -> np.ndarray:
    """All ways to flip at most ``radius`` of ``width`` bits."""
    return np.array([sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(width), k)], dtype=np.int64)


class Pigeonhole:
    """Groups, candidate estimates and thresholds; small enough to send to each task.

    ``seen[i]`` has at most 2**COUNT_BITS counts, whatever the number of fingerprints. A row of band b
    probes the keys of band b and stands in the index of the bands b - s, for each s of ``sides``.
    """

    def __init__(self, groups: list[list[int]], tau: int, similarity: float | None = None, bands: int = 1, sides: tuple[int, ...] = (0,), part: int = 0, most_rows: int = ROWS_OF_KEY):
        self.groups, self.tau, self.similarity, self.bands, self.sides, self.most_rows = groups, tau, similarity, bands, sides, most_rows
        self.budget = tau - len(groups) + 1
        self.most = max(1, -(-self.budget // len(groups)) + 1) if self.budget > 0 else min(1, tau)
        self.masks = [[masks_within(len(g), e) for e in range(self.most + 1)] for g in groups]
        self.cells = [min(len(g), COUNT_BITS - (bands - 1).bit_length()) for g in groups]
        self.part = [min(part, c) for c in self.cells]  # low bits of a value that its key holds
        self.turns = [[masks_within(p, min(e, p)) for e in range(self.most + 1)] for p in self.part]
        self.inside = [[{t: masks[masks & ((1 << p) - 1) == t] for t in turns.tolist()} for masks, turns in zip(*of, strict=True)] for *of, p in zip(self.masks, self.turns, self.part, strict=True)]

    def value(self, fps: np.ndarray, i: int) -> np.ndarray:
        return _bits(fps)[:, self.groups[i]].astype(np.int64) @ (1 << np.arange(len(self.groups[i]), dtype=np.int64))

    def values(self, fps: np.ndarray) -> np.ndarray:
        return np.stack([self.value(fps, i) for i in range(len(self.groups))], axis=1)

    def indexed(self, rows: np.ndarray) -> np.ndarray:
        """From what each band has, what stands in the index of each."""
        out = np.zeros_like(rows)
        for s in self.sides:
            out[max(0, -s) : len(rows) - max(0, s)] += rows[max(0, s) : len(rows) - max(0, -s)]
        return out

    def learn(self, seen: list[np.ndarray]) -> None:
        """From counts by band and cell: candidates by group, radius, band and cell; blocks of each key, 0 if nothing stands there."""
        self.near, self.block, self.pairs = [], [], 0.0
        for i, g in enumerate(self.groups):
            own, share = seen[i].astype(np.float32), 1 << (len(g) - self.cells[i])
            found, at = self.indexed(own), np.arange(1 << self.cells[i])
            near, rings = [], [0, *map(len, self.masks[i])]
            for a, b in zip(rings, rings[1:], strict=False):
                near.append(sum((found[:, at ^ (x & (len(at) - 1))] for x in self.masks[i][-1][a:b]), np.zeros_like(found)) / share + (near[-1] if near else 0))
            self.near.append(near)
            hot = lambda x: np.maximum(0, x - 2 * x.mean(axis=1, keepdims=True)) if share > 1 else 0 * x  # noqa: B023, E731
            pairs = own * near[min(self.most, max(0, -(-self.budget // len(self.groups))))] + hot(own) * hot(found)
            total = lambda x: x.reshape(self.bands, -1, 1 << self.part[i]).sum(axis=1, dtype=np.float64)  # noqa: B023, E731
            self.pairs += pairs.sum(dtype=np.float64)
            blocks = np.ceil(np.maximum(np.sqrt(total(pairs) / PAIRS_OF_KEY), total(own + found) / (2 * self.most_rows)))
            self.block.append(np.where(total(found) > 0, np.clip(blocks, 1, BLOCKS), 0).astype(np.int64))

    def thresholds(self, values: np.ndarray, bands: np.ndarray) -> np.ndarray:
        """For each row, thresholds of least cost that sum to the budget."""
        n, m, top = len(values), len(self.groups), self.most
        least = {-0: np.zeros(n)}
        picked: list[dict[int, np.ndarray]] = []
        for i in range(m):
            cell = values[:, i] & ((1 << self.cells[i]) - 1)
            cost = {-1: np.zeros(n)} | {e: self.near[i][e][bands, cell] + PROBE_COST * len(self.masks[i][e]) + ROW_COST * len(self.turns[i][e]) for e in range(top + 1)}
            then: dict[int, np.ndarray] = {}
            pick: dict[int, np.ndarray] = {}
            for s, c in least.items():
                for e, x in cost.items():
                    if not self.budget - top * (m - 1 - i) <= s + e <= self.budget + m - 1 - i:
                        continue
                    total = c + x
                    if s + e not in then:
                        then[s + e], pick[s + e] = total, np.full(n, e, dtype=np.int64)
                    else:
                        better = total < then[s + e]
                        then[s + e] = np.where(better, total, then[s + e])
                        pick[s + e] = np.where(better, e, pick[s + e])
            least = then
            picked.append(pick)
        out, left = np.empty((n, m), dtype=np.int64), np.full(n, self.budget, dtype=np.int64)
        for i in reversed(range(m)):
            for s, e in picked[i].items():
                rows = left == s
                out[rows, i] = e[rows]
            left -= out[:, i]
        return out


def _explode(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers repeated counts times, and the running number inside each row."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def set_sizes(sketch: pa.Array) -> np.ndarray:
    """Number of different shingles that each sketch states."""
    return np.ascontiguousarray(_fixed(sketch)[:, :4]).view("<u4")[:, 0].astype(np.int64)


def bands_of(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Bands of set sizes; sets of at least the similarity lie in one band or in two neighbours."""
    return np.minimum(BANDS - 1, np.log(np.maximum(sizes, 1)) / math.log(1.01 / similarity)).astype(np.int64)


def route(plan: Pigeonhole, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows (k, role, ...) of some rows (fp, node, ...); k: group, band, a few bits of the value and a pair of blocks.

    role: 1 if the row stands in the index of its key, plus twice its threshold and two if it probes there.
    Rows whose ``seek`` is false are only found, they make no probes.
    """
    fps, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    seek = batch.column("seek").to_numpy(zero_copy_only=False) if "seek" in batch.schema.names else np.ones(len(batch), dtype=bool)
    band = np.minimum(plan.bands - 1, bands_of(set_sizes(batch.column("sketch")), plan.similarity)) if plan.similarity else np.zeros(len(batch), dtype=np.int64)
    values = plan.values(fps)
    limits = np.where(seek[:, None], plan.thresholds(values, band), -1)
    mixed = ((fps.view(np.uint64) ^ (nodes.view(np.uint64) * np.uint64(0xD1B54A32D192ED03))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)

    def rows(i: int, of: np.ndarray, at_band: np.ndarray, at: np.ndarray, limit: int, both: np.ndarray) -> pa.RecordBatch:
        """limit: of the probes, -1 for index rows. both: the key has a probe and an index row, which are one row where their blocks meet."""
        b = plan.block[i][at_band, at]
        own = (mixed[of] % np.maximum(b, 1).astype(np.uint64)).astype(np.int64)
        r, other = _explode(b)
        meet = both[r] & (own[r] == other)
        if limit < 0:
            r, other, meet = r[~meet], other[~meet], meet[~meet]
        first, second = (own[r], other) if limit >= 0 else (other, own[r])
        key = (((at[r] * plan.bands + at_band[r]) * len(plan.groups) + i) << np.int64(20)) + (first << np.int64(10)) + second
        role = 2 * (limit + 1) + (meet if limit >= 0 else np.ones(len(r), dtype=bool))
        own_rows = pa.array(of[r])
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(role.astype(np.int8)), *(c.take(own_rows) for c in batch.columns)], ["k", "role", *batch.schema.names])

    for i in range(len(plan.groups)):
        part = values[:, i] & ((1 << plan.part[i]) - 1)
        for s in plan.sides:
            of = np.flatnonzero((band >= s) & (band - s < plan.bands))
            yield rows(i, of, band[of] - s, part[of], -1, (limits[of, i] >= 0) & (s == 0))
        for e in range(plan.most + 1):
            of, turns = np.flatnonzero(limits[:, i] == e), plan.turns[i][e]
            if len(of):
                yield rows(i, np.repeat(of, len(turns)), np.repeat(band[of], len(turns)), (part[of][:, None] ^ turns).ravel(), e, np.tile(turns == 0, len(of)))


def forest(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Places of some of the edges (a, b) at distance d that span the same components, shorter ones first."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(names))
    taken: list[np.ndarray] = []
    for level in np.unique(d):
        left = np.flatnonzero(d == level)
        while len(left := left[label[x[left]] != label[y[left]]]):
            low, high = np.minimum(label[x[left]], label[y[left]]), np.maximum(label[x[left]], label[y[left]])
            hooked, first = np.unique(high, return_index=True)  # each root but the least hooks to a smaller one
            taken.append(left[first])
            label[hooked] = low[first]
            while not np.array_equal(label, label[label]):
                label = label[label]
    return np.concatenate([*taken, np.empty(0, dtype=np.int64)]).astype(np.int64)


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of components after the edges (a, b) between places of ``label``."""
    while len(left := np.flatnonzero(label[a] != label[b])):
        low, high = np.minimum(label[a[left]], label[b[left]]), np.maximum(label[a[left]], label[b[left]])
        label = label.copy()
        label[high] = low
        while not np.array_equal(label, label[label]):
            label = label[label]
    return label


def _fixed(column: pa.Array) -> np.ndarray:
    """Rows of bytes of a binary column whose values are of one length."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), -1)


class Closeness:
    """Tests pairs of rows by distance of fingerprints alone, by sketches too, or by whole shingle sets."""

    def __init__(self, tau: int, similarity: float | None = None):
        self.tau, self.similarity = tau, similarity
        if similarity:
            share = similarity + (1 - similarity) / 16  # of equal four-bit numbers
            error = math.sqrt(share * (1 - share) / MINS)
            self.least, self.sure = math.ceil((share - DOUBT * error) * MINS), math.ceil(min(1.0, share + SURE * error) * MINS)

    def sketched(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal min-hashes of each pair of sketches; 0 if they or the sizes rule the similarity out."""
        out = np.zeros(len(a), dtype=np.int64)
        for at in range(0, len(a), TESTS_AT_ONCE):
            x, y = a[at : at + TESTS_AT_ONCE], b[at : at + TESTS_AT_ONCE]
            equal = EQUAL_HALVES[x[:, 4:] ^ y[:, 4:]].sum(axis=1, dtype=np.int64)
            n, m = (np.ascontiguousarray(z[:, :4]).view("<u4")[:, 0].astype(np.float64) for z in (x, y))
            fits = (np.minimum(n, m) >= self.similarity * np.maximum(n, m)) & (equal >= self.least)
            out[at : at + TESTS_AT_ONCE] = np.where(fits, np.maximum(equal, 1), 0)
        return out


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of different numbers; of two empty ones 1."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def probes(plan: Pigeonhole, k: np.ndarray, role: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, ...]]]:
    """Index rows, by key and value; then again and again (rows, start, count): where in them the values stand that a row probes.

    Rows come sorted by key.
    """
    m, width = len(plan.groups), np.int64(32)
    lead = k >> np.int64(20)
    group, at = lead % m, lead // (m * plan.bands)
    value = np.empty(len(k), dtype=np.int64)
    for i in np.unique(group):
        own = np.flatnonzero(group == i)
        value[own] = plan.value(fp[own], i)
    key = np.cumsum(np.append(0, k[1:] != k[:-1])).astype(np.int64) << width
    index = np.flatnonzero(role & 1)
    index = index[np.argsort((key + value)[index], kind="stable")]
    codes, start, count = np.unique((key + value)[index], return_index=True, return_counts=True)

    def found() -> Iterator[tuple[np.ndarray, ...]]:
        for i, e in np.unique(np.stack([group, (role >> 1) - 1])[:, role > 1], axis=1).T.tolist():
            own = np.flatnonzero((group == i) & (role >> 1 == e + 1))
            turn = (value[own] & ((1 << plan.part[i]) - 1)) ^ at[own]
            for t in np.unique(turn).tolist():
                q, masks = own[turn == t], plan.inside[i][e][t]
                step = max(1, PAIRS_AT_ONCE // max(1, len(masks)))
                for a in range(0, len(q) if len(masks) else 0, step):
                    wanted = ((key + value)[q[a : a + step]][:, None] ^ masks).ravel()
                    place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
                    hit = np.flatnonzero(codes[place] == wanted)
                    yield q[a : a + step][hit // len(masks)], start[place[hit]], count[place[hit]]

    return index, found() if len(index) else iter(())


def compare(rows: pa.Table, close: Closeness, plan: Pigeonhole) -> tuple[np.ndarray, np.ndarray]:
    """A forest (a, b) of the links between probes and index rows of the same key, closest first.

    With sketches, a link is what they don't rule out; with whole sets, a link is exact. Rows of one
    part aren't linked. Pairs that sure links join already need no test.
    """
    k, role, fp, node = (rows.column(c).to_numpy() for c in ("k", "role", "fp", "node"))
    fp = fp.view(np.uint64)
    part = rows.column("part").to_numpy() if "part" in rows.column_names else node
    sketch = _fixed(rows.column("sketch").combine_chunks()) if close.similarity else None
    size = set_sizes(rows.column("sketch").combine_chunks()) if close.similarity else np.zeros(len(rows), dtype=np.int64)
    shingles = rows.column("shingles").combine_chunks() if "shingles" in rows.column_names else None
    one_side = "seek" not in rows.column_names  # the lesser set finds the greater, of equal ones the later node the earlier
    names, place = np.unique(node, return_inverse=True)
    label = np.arange(len(names))
    index, asked = probes(plan, k, role, fp)
    found = tuple(np.empty(0, np.int64) for _ in range(3))
    forested = 0
    for asker, lo, count in asked:
        steps = np.cumsum(count)
        start = 0
        while start < len(asker):
            done = steps[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(steps, done + PAIRS_AT_ONCE, "right")))
            r, inside = _explode(count[start:stop])
            q, x = asker[start:stop][r], index[lo[start:stop][r] + inside]
            start = stop
            d = np.bitwise_count(fp[q] ^ fp[x]).astype(np.int64)
            good = np.flatnonzero(d <= close.tau)
            q, x, d = q[good], x[good], d[good]
            good = (size[q] < size[x]) | (size[q] == size[x]) & (node[q] > node[x]) if one_side else part[q] != part[x]
            good = np.flatnonzero(good & (label[place[q]] != label[place[x]]))
            q, x, d = q[good], x[good], d[good]
            if not len(q):
                continue
            if close.similarity:
                equal = close.sketched(sketch[q], sketch[x])
                order = np.argsort(-equal, kind="stable")[: np.count_nonzero(equal)]
                q, x, d = q[order], x[order], MINS - equal[order]
                if shingles is None:
                    label = _joined(label, *(place[z[d <= MINS - close.sure]] for z in (q, x)))
                else:
                    keep = []
                    for i, (u, v) in enumerate(zip(q.tolist(), x.tolist(), strict=True)):
                        a, b = label[place[u]], label[place[v]]
                        if a != b and overlap(*(np.frombuffer(shingles[z].as_py(), dtype=np.uint32) for z in (u, v))) >= close.similarity:
                            label[label == max(a, b)] = min(a, b)
                            keep.append(i)
                    q, x, d = q[keep], x[keep], d[keep]
            else:
                label = _joined(label, place[q], place[x])
            found = tuple(np.append(f, g) for f, g in zip(found, (place[q], place[x], d), strict=True))
            if len(found[0]) > forested + TESTS_AT_ONCE:
                kept = forest(*found)
                found = tuple(f[kept] for f in found)
                forested = len(kept)
    kept = forest(*found)
    return names[found[0][kept]], names[found[1][kept]]


def links(batches: Iterator[pa.RecordBatch], close: Closeness, plan: Pigeonhole) -> Iterator[pa.RecordBatch]:
    """The forests of some whole keys at a time; rows come sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= ROWS_AT_ONCE or sum(b.nbytes for b in held) >= BYTES_AT_ONCE:
            whole = pa.Table.from_batches(held).combine_chunks()
            k = whole.column("k").to_numpy()
            end = int(np.searchsorted(k, k[-1], "left"))
            if end:
                yield _edges(*compare(whole.slice(0, end), close, plan))
            held = pa.Table.from_batches(whole.slice(end).to_batches()).combine_chunks().to_batches()
    if held:
        yield _edges(*compare(pa.Table.from_batches(held).combine_chunks(), close, plan))


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def linked(classes: DataFrame, tau: int, similarity: float | None = None) -> DataFrame:
    """Edges (a, b) with the same components as all links of ``classes(fp, node, ...)``.

    A link lies within tau bits. With a similarity, ``classes`` has a ``sketch`` that must not rule
    it out, and may have whole sets of ``shingles`` that must reach it. Classes of one ``part`` have
    no links; those whose ``seek`` is false have none among each other. Each task leaves a forest
    of its links. Edges may repeat.

    The driver gets 64 x 64 bit counts and at most 2**COUNT_BITS counts for each group, never rows.
    """
    spark, sketched = classes.sparkSession, ["sketch"] if similarity else []
    sides = (0,) if not similarity else (-1, 0, 1) if "seek" in classes.columns else (0, 1)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, sizes = np.zeros((BITS, BITS), dtype=np.int64), np.zeros(BANDS, dtype=np.int64)
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
            sizes += np.bincount(bands_of(set_sizes(batch.column(1)), similarity), minlength=BANDS) if similarity else np.bincount([0], [len(batch)], BANDS).astype(np.int64)
        every = np.append(both, sizes)
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(every[at])], ["at", "n"])

    counts = np.zeros(BITS * BITS + BANDS, dtype=np.int64)
    for at, k in classes.select("fp", *sketched).mapInArrow(together, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        counts[at] = k
    sizes = counts[BITS * BITS :]
    n, bands = int(sizes.sum()), int(np.flatnonzero(sizes).max(initial=0)) + 1
    near = sum(int(sizes[b] * sizes[b + s]) for b in range(bands) for s in sides if 0 <= b + s < bands) / max(n, 1)  # index rows that a probe meets
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    weight = 32 if "shingles" in classes.columns else 1  # whole sets make large rows
    most_rows = ROWS_OF_KEY // weight
    part = max(0, math.ceil(math.log2(max(near, 1) / most_rows)))
    m = group_count(near, tau, part, ROW_COST * weight)
    plan = Pigeonhole(correlated_groups(counts[: BITS * BITS].reshape(BITS, BITS), n, m), tau, similarity, bands, sides, part, most_rows)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = plan.values(batch.column(0).to_numpy(zero_copy_only=False))
            band = bands_of(set_sizes(batch.column(1)), similarity) if similarity else 0
            for i in range(m):
                v, k = np.unique((band << plan.cells[i]) + (values[:, i] & ((1 << plan.cells[i]) - 1)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((i << COUNT_BITS) + v), pa.array(k)], ["at", "n"])

    got = classes.select("fp", *sketched).mapInArrow(cells, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    at, seen = got["at"].to_numpy(), []
    for i in range(m):
        own = at >> COUNT_BITS == i
        seen.append(np.bincount(at[own] & ((1 << COUNT_BITS) - 1), got["n"].to_numpy()[own], bands << plan.cells[i]).reshape(bands, -1))
    plan.learn(seen)
    shared = spark.sparkContext.broadcast(plan)
    close = Closeness(tau, similarity)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, min(1_000, len(batch) * 1_000_000 // max(1, batch.nbytes)))
            for at in range(0, len(batch), step):
                yield from route(shared.value, batch.slice(at, step))

    rows = classes.select("fp", "node", *(c for c in ("part", "seek", "sketch", "shingles") if c in classes.columns))
    keyed = rows.mapInArrow(routed, "k long, role byte, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema))
    shuffled = n * sum(len(sides) + len(t[min(plan.most, max(0, -(-plan.budget // m)))]) for t in plan.turns)
    parts = max(asked, math.ceil(shuffled * weight / 500_000 + plan.pairs / 1_000_000_000))
    dealt = keyed.repartition(parts, "k").sortWithinPartitions("k")
    return dealt.mapInArrow(lambda batches: links(batches, close, shared.value), "a long, b long")


def simhash_components(docs: DataFrame, words: int = 3, tau: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs(doc_id, text)``.

    component_id is the smallest doc_id that can be reached over links of fingerprints that differ
    in at most ``tau`` bits, the row's own included. Rows of equal fingerprints are one node of
    the search, so thousands of copies cost one probe. Null or blank text: fingerprint zero, linked
    like any other. Null doc_id: such a row gets the component of its fingerprint, or null if no
    row with an id has that fingerprint. Other columns are ignored; an empty table gives no rows.
    """
    prints = cut(fingerprints(docs, words))
    classes = cut(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    roots = components(linked(classes, tau)) if not classes.isEmpty() else None
    if roots is None:
        return prints.withColumn("component_id", F.lit(None).cast("long"))
    named = cut(classes.join(roots, "node", "left").select(F.col("fp").alias("_fp"), F.coalesce("root", "node").alias("component_id")))
    return prints.join(named, prints.fp == named._fp, "left").select("doc_id", "fp", "component_id")


def shingle_sets(docs: DataFrame, firsts: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of ``firsts(node, first)``: the sorted 32-bit hashes of the text's different shingles, as bytes.

    Chance collisions change a similarity by less than one in a thousand up to millions of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                sets = [np.unique(shingle_hashes(tokens_of(t.as_py()), words) >> np.uint64(32)).astype(np.uint32).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    wanted = firsts.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.t").alias("t"))
    texts = _keyed(docs).join(wanted, ["doc_id", "t"]).dropDuplicates(["doc_id", "t"]).select("node", "text")
    return texts.mapInArrow(run, "node long, shingles binary")


def checked(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b, good): whether the shingle sets of each edge have at least the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2), batch.column(3), strict=True)
            good = [overlap(*(np.frombuffer(z.as_py(), dtype=np.uint32) for z in pair)) >= similarity for pair in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(good, pa.bool_())], ["a", "b", "good"])

    first, second = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "ab")
    both = edges.join(first, "a").join(second, "b").select("a", "b", "a_set", "b_set")
    return both.mapInArrow(run, "a long, b long, good boolean")


def contracted(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges (a, b) between the parts of their ends, by ``parts(node, part)``; nodes without one are parts of their own."""
    ends = edges
    for c in "ab":
        of = parts.select(F.col("node").alias(c), F.col("part").alias(f"_{c}"))
        ends = ends.join(of, c, "left").withColumn(f"_{c}", F.coalesce(f"_{c}", c))
    return ends.where("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()


def near_groups(docs: DataFrame, classes: DataFrame, words: int, similarity: float, margin: int) -> DataFrame:
    """(node, root): the components of all pairs of ``classes`` that are candidates and similar; nodes without a link may be missing.

    Candidates lie within the bits that stand for ``similarity`` plus ``margin``. First, sketches
    that travel with the fingerprints rule out unlike candidates, and a forest of the rest, likest
    first, is checked on the whole shingle sets; the edges that hold make pieces. An edge between
    two pieces that doesn't hold may hide links that do: where there is one, all candidates
    between the pieces around it are compared again by their whole sets.
    """
    tau = bits_for(similarity) + margin
    tried = cut(linked(classes, tau, similarity).distinct())
    ends = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    sets = cut(shingle_sets(docs, classes.join(ends, "node").select("node", "first"), words))
    tested = cut(checked(tried, sets, similarity))
    pieces = cut(components(tested.where("good").select("a", "b"))).withColumnRenamed("root", "part")
    broken = cut(contracted(tested.where("not good").select("a", "b"), pieces))
    if broken.isEmpty():
        return pieces.withColumnRenamed("part", "root")
    trees = cut(components(broken)).select(F.col("node").alias("part"), F.col("root").alias("tree"))
    parted = ends.join(pieces, "node", "left").select("node", F.coalesce("part", "node").alias("part"))
    inside = cut(parted.join(trees, "part"))
    most = inside.groupBy("tree", "part").count().groupBy("tree").agg(F.max(F.struct("count", "part"))["part"].alias("largest"))
    again = inside.join(most, "tree").withColumn("seek", F.col("part") != F.col("largest"))
    again = cut(again.join(classes, "node").join(sets, "node").select("fp", "node", "part", "seek", "sketch", "shingles"))
    merged = components(contracted(linked(again, tau, similarity).distinct(), pieces)).select(F.col("node").alias("part"), "root")
    return parted.join(merged, "part", "left").select("node", F.coalesce("root", "part").alias("root"))


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, margin: int = 4) -> DataFrame:
    """Rows of ``docs`` that stay when each group of near-duplicates keeps the row of its smallest doc_id.

    Two texts are near-duplicates if their fingerprints lie within the bits that stand for
    ``similarity``, plus ``margin`` so that fewer pairs are lost to the spread of the estimate,
    and their sets of ``words``-word shingles have a Jaccard similarity of at least ``similarity``;
    groups are the components of such pairs. Texts of equal words are copies; texts that only share
    a fingerprint are compared like any others. Rows that share a doc_id count by their texts: of
    different texts each stays unless a near-duplicate goes before it; of equal ones the least row
    stays. Null text is empty text. Rows without a doc_id stay. Columns are those of ``docs``.
    """
    classes = cut(text_classes(docs, words))
    if classes.isEmpty():
        return docs
    roots = near_groups(docs, classes, words, similarity, margin)
    grouped = classes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    keys = ["_near_id", "_near_text"]
    firsts = grouped.select(F.col("first.doc_id").alias(keys[0]), F.col("first.t").alias(keys[1]))
    rows = docs.where("doc_id is not null").withColumns({keys[0]: F.col("doc_id").cast("long"), keys[1]: F.xxhash64(F.col("text").cast("string"))})
    order = Window.partitionBy(*keys).orderBy(*(f.name for f in docs.schema if "map<" not in f.dataType.simpleString()))
    kept = rows.join(firsts, keys, "left_semi").withColumn("_near_row", F.row_number().over(order)).where("_near_row = 1")
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document (3-word shingles) and the smallest doc_id that links of 3 bits or fewer reach; null text: zero."""
    out = simhash_components(table(spark, sf_dir, "documents"), words=3, tau=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
