"""Centroids, importance resampling and collision joins: brute force, planted cases, awkward rows."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tracewright.llm import op6_licenses, op11_centroids, op12_importance, op13_collisions, queries

QUERIES = queries.queries()
LONG = " ".join(f"w{i % 977}é" for i in range(30_000))


def plain_clusters(rows, k=16, rounds=3):
    """Python's integers all the way."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    firsts = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in firsts[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    near = lambda v: min((far(v, c), i) for i, c in enumerate(centroids))  # noqa: E731, B023
    for _ in range(rounds):
        mine = [near(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            own = [v for (_, v), m in zip(kept, mine, strict=True) if m == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    out = [(i, *reversed(near(v))) for i, v in kept]
    inertia = Counter()
    for _, c, d in out:
        inertia[c] += d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in out), key=str)


def clusters(df):
    out = op11_centroids.cluster(df)
    sha = F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)
    return sorted((tuple(r) for r in out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", sha).collect()), key=str)


def test_clusters_against_plain_integers(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in QUERIES["op11_centroids"](spark, DATA).collect()), key=str)
    assert got == plain_clusters(rows)


def test_clusters_of_awkward_rows(spark):
    schema = "vec_id long, embedding array<double>, cluster string, distance string, v string"
    make = lambda rows: spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    assert clusters(make([])) == []
    rows = [(i % 7, [float((i * j) % 11) / 8 for j in range(64)]) for i in range(40)] + [(1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 65), (5, [None] * 64), (6, [float("nan")] * 64), (7, [float("inf")] + [0.0] * 63), (None, [0.5] * 64)]
    assert clusters(make(rows)) == plain_clusters(rows)
    few = [(9, [0.25] * 64), (8, [0.25] * 64), (9, [-3.0] * 64)]
    assert clusters(make(few)) == plain_clusters(few) and len({c for _, c, *_ in clusters(make(few))}) < 3
    large = [(i, [2.0**20 * (i + 1)] + [float(i)] * 63) for i in range(20)]  # beyond SMALL, so by Python's integers
    assert clusters(make(large)) == plain_clusters(large)


def test_bounds_never_exclude_the_nearest():
    rng = np.random.default_rng(5)
    for scale in (3, 1000, 2**26):
        rows = rng.integers(-scale, scale, size=(400, 64))
        rows[:200] = rows[rng.integers(0, 10, 200)] + rng.integers(-2, 3, size=(200, 64))
        centroids, pivots = rows[rng.integers(0, 400, 16)] + rng.integers(-1, 2, size=(16, 64)), op11_centroids.Pivots(rows[:16])
        near = pivots.squares(rows)
        every = ((rows[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (pivots.least(near, centroids) <= every).all()
        who, best, tried = op11_centroids.nearest(rows, near, centroids, pivots)
        assert (best == every.min(axis=1)).all() and (who == every.argmin(axis=1)).all()
        near_few = op11_centroids.nearest(rows[:200], near[:200], rows[:10], pivots)[2]
        assert scale < 1000 or near_few < 0.3 * 200 * 10  # the bounds rule centroids out where vectors lie in clusters


def test_crc_of_columns():
    words = [b"", b"a", b"bc", "é𝔘".encode(), b"x" * 5000, b"123456789", b"a"]
    assert op12_importance.crc32_all(words).tolist() == [zlib.crc32(w) for w in words]


def plain_resample(docs, target, percent=10, least=20):
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    count = lambda texts: Counter(zlib.crc32(w.encode()) % 10000 for t in texts for w in words(t))
    raw, aim = count(t for _, t in docs), count(target)
    s_all, t_all = sum(raw.values()), sum(aim.values())
    gain = lambda w: (lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10000) / ((raw[b] + 1) * (t_all + 10000)))))(zlib.crc32(w.encode()) % 10000)
    out = []
    for i, t in docs:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(w) for w in words(t))
        out.append([i, len(words(t)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = {id(r): n + 1 for n, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((*r, drawn.get(id(r))) for r in out), key=str)


def test_resampling_against_plain_python(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in QUERIES["op12_importance"](spark, DATA).collect()), key=str) == plain_resample(docs, target)


def test_resampling_of_awkward_rows(spark):
    texts = [None, "", " \t", "One two", LONG, LONG, "é " * 30, "A b C d " * 20, "\x00x\x85y z" * 10, "日本 語 " * 25]
    docs = [(i, t) for i, t in enumerate(texts)] + [(4, LONG), (None, "word " * 40), (None, None)]
    df = spark.createDataFrame([(i, t, "r", 1) for i, t in docs], "doc_id long, text string, rank string, weight int")
    target = spark.createDataFrame([("two b",), (None,)], "text string")
    run = lambda d, t, **how: sorted((tuple(r) for r in op12_importance.resample(d, t, **how).collect()), key=str)
    assert run(df, target, percent=50) == plain_resample(docs, ["two b", None], 50)
    assert run(df, target.limit(0), percent=100) == plain_resample(docs, [], 100)
    assert run(df.limit(0), target) == []


def plain_groups(docs, percent=85):
    sets = {}
    for n, (i, t) in enumerate(docs):
        words = (t or "").encode().lower().split()
        sets[n] = frozenset(b" ".join(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset()
    root = {n: n for n in sets}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    different = {}
    for n, s in sets.items():
        if s and docs[n][0] is not None:
            different.setdefault(s, []).append(n)
    heads = [members[0] for members in different.values()]
    for members in different.values():
        for n in members[1:]:
            root[top(n)] = top(members[0])
    for x, a in enumerate(heads):
        for b in heads[:x]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[top(a)] = top(b)
    least = {}
    for n in sets:
        if docs[n][0] is not None:
            least[top(n)] = min(least.get(top(n), docs[n][0]), docs[n][0])
    out = []
    for n, (i, _) in enumerate(docs):
        c = least[top(n)] if i is not None else least[top(different[sets[n]][0])] if sets[n] in different else None
        out.append((i, len(sets[n]), c, i == c))
    return sorted(out, key=str)


def found_groups(df):
    return sorted((tuple(r) for r in op13_collisions.near_duplicates(df).collect()), key=str)


def test_near_duplicates_of_awkward_rows(spark):
    base = " ".join(f"t{i}" for i in range(60))
    texts = [None, "", " \n", "one", "ONE", "one two three", "one two three ", base, base + " more", base.replace("t30", "x"), base.replace("t30", "x") + " a b c", LONG, LONG + " end", "é " * 50, base, "\x1c a \x85 b"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, base), (7, "another text with this id"), (None, base), (None, "nobody has this text"), (None, None)]
    df = spark.createDataFrame([(i, t, "k", 5) for i, t in docs], "doc_id long, text string, kept string, component_id int")
    assert found_groups(df) == plain_groups(docs)
    assert found_groups(df.limit(0)) == [] and found_groups(df.where("text is null")) == plain_groups([(i, t) for i, t in docs if t is None])


@pytest.mark.parametrize("edits", [4, 9])
def test_dense_groups_lose_no_link(spark, edits):
    """Copies of one text with edits of their own: most pairs of copies stay just above or below the limit."""
    rng = np.random.default_rng(edits)
    base = [f"b{i}" for i in range(300)]
    docs = [(0, " ".join(base))]
    for i in range(1, 250):
        words = list(base)
        for at in rng.integers(0, 300, edits):
            words[at] = f"e{i}x{at}"
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, " ".join(f"u{i}w{j}" for j in range(40)) + " " + " ".join(base[:120])) for i in range(100)]  # a passage in common
    assert found_groups(spark.createDataFrame(docs, "doc_id long, text string")) == plain_groups(docs)


def test_long_postings_are_cut(spark, monkeypatch):
    monkeypatch.setattr(op13_collisions, "BLOCK", 16)
    monkeypatch.setattr(op13_collisions, "EDGES_AT_ONCE", 7)
    docs = [(i, " ".join([f"b{j}" for j in range(200)] + [f"own{i}"])) for i in range(120)]
    assert found_groups(spark.createDataFrame(docs, "doc_id long, text string")) == plain_groups(docs)


def test_pairs_that_agree_in_fewer_coordinates_are_rare():
    """Of sets at the limit exactly, none in a thousand falls below the coordinates that are asked for."""
    rng, low = np.random.default_rng(1), op13_collisions.least_matches(85)
    for _ in range(300):
        hashes = rng.integers(0, 2**63, 200, dtype=np.uint64)
        a, b = op13_collisions.signature(hashes[:185]), op13_collisions.signature(hashes[15:])  # 170 of 200
        assert (a == b).sum() >= low


def test_runs_in_two_threads_keep_their_tables(spark):
    """Each run removes its own tables only, and a loop only the one that it names."""
    import threading

    from tracewright.llm.common import cut, scratch

    ready, over, found = threading.Barrier(2), threading.Barrier(2), {}

    def run(name):
        try:
            with scratch(spark):
                first = cut(spark.range(10))
                ready.wait(60)
                second = cut(first.where("id > 3"), instead_of=first)
                over.wait(60)
                found[name] = second.count()
        except Exception as e:  # noqa: BLE001
            found[name] = e

    threads = [threading.Thread(target=run, args=(i,)) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert found == {0: 6, 1: 6}
    outside = cut(spark.range(3))
    with scratch(spark):
        inside = cut(outside)
    assert outside.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        inside.count()


def test_licenses_in_typographic_dress(spark):
    """As Spark and as DuckDB read them: quotes, blanks and marks beyond ASCII, reserved rights, long copyright lines."""
    import duckdb

    mit, bsd = op6_licenses.KNOWN_LICENSES["MIT"], op6_licenses.KNOWN_LICENSES["BSD-2-Clause"]
    curly = mit.replace('"Software"', "\u201cSoftware\u201d").replace('"AS IS"', "\u201cAS IS\u201d")
    rows = [
        (1, curly), (2, mit.replace("free of charge", "free\u00a0of\u00a0charge")), (3, "\ufeff" + mit), (4, "Copyright (c) 2020, Someone\nAll rights reserved.\n\n" + bsd), (5, "Copyright The Authors of a Very Long Name " + "and Sons " * 30 + "2020\n" + mit),
        (6, "\ufeffMIT License\n\n\u00a9 2020 Someone\n" + mit), (7, "copyright notice and terms of 2020 hold here\n" + mit), (8, "All rights reserved. Really.\n" + mit), (9, "All rights reserved."), (10, "MIT License\n\n"), (11, "BSD 2-Clause License\n\n" + bsd.replace("\n", "\r\n")), (None, None),
    ]
    want = {1: "MIT", 2: "MIT", 3: "MIT", 4: "BSD-2-Clause", 5: "MIT", 6: "MIT", 7: None, 8: None, 9: None, 10: None, 11: "BSD-2-Clause", None: None}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = op6_licenses.scan(docs, op6_licenses.built_in(spark)).collect()
    assert {r.doc_id: r.license for r in got} == want
    documents = docs.toPandas()  # noqa: F841
    sql = duckdb.sql(op6_licenses.ORACLE_SQL).fetchall()
    assert sorted(((r[1], r[2]) for r in sql), key=str) == sorted(((r.digest, r.license) for r in got), key=str)
