"""What the findings of round 4 showed, in small."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_corpus import plain_components, plain_keep
from tracewright.llm import common, op7_simhash


def near_prints(seed, n=1200):
    """Fingerprints, some of them up to eight bits from another."""
    rng = np.random.default_rng(seed)
    fps = rng.integers(0, 2**64, n, dtype=np.uint64)
    for _ in range(8):
        fps[: n // 3] ^= np.where(rng.random(n // 3) < 0.9, np.uint64(1) << rng.integers(0, 64, n // 3).astype(np.uint64), np.uint64(0))
        fps[: n // 4] = np.where(rng.random(n // 4) < 0.1, fps[n // 3 : n // 3 + n // 4], fps[: n // 4])
    return np.unique(fps)


@pytest.mark.parametrize(("tau", "rows", "pairs"), [(13, 131_072, 10**9), (13, 40, 10**9), (13, 40, 3000), (3, 40, 500)])
def test_links_whatever_the_keys_hold(spark, monkeypatch, tau, rows, pairs):
    """Keys with some bits of a value, cut into blocks or not, lose no link."""
    monkeypatch.setattr(op7_simhash, "ROWS_OF_KEY", rows)
    monkeypatch.setattr(op7_simhash, "PAIRS_OF_KEY", pairs)
    fps = near_prints(tau + rows)
    classes = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64))], "fp long, node long")
    roots = {r.node: r.root for r in op7_simhash.components(op7_simhash.linked(classes, tau)).collect()}
    wanted = plain_components(list(range(len(fps))), fps, tau)
    assert [roots.get(i, i) for i in range(len(fps))] == wanted and len(set(wanted)) < len(fps)


def edited_texts():
    text = {}
    for n in range(150):  # sets of all sizes, and for each some that are a fifth longer or shorter, or little changed
        words = [f"w{n}x{i}" for i in range(int(20 * 1.04**n % 900) + 20)]
        text[3 * n], text[3 * n + 1] = " ".join(words), " ".join(words[: len(words) * (79 + n % 4) // 100])
        text[3 * n + 2] = " ".join(w if i != n % 20 else "new" for i, w in enumerate(words))
    return text


@pytest.mark.parametrize(("rows", "pairs"), [(131_072, 10**9), (2_000, 200)])
def test_bands_of_set_sizes_lose_no_link(spark, monkeypatch, rows, pairs):
    sizes = np.arange(1, 5000)
    assert (op7_simhash.bands_of(sizes * 5 // 4, 0.8) - op7_simhash.bands_of(sizes, 0.8)).max() <= 1
    monkeypatch.setattr(op7_simhash, "ROWS_OF_KEY", rows)
    monkeypatch.setattr(op7_simhash, "PAIRS_OF_KEY", pairs)
    text = edited_texts()
    kept = op7_simhash.keep_one(spark.createDataFrame(sorted(text.items()), "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == plain_keep(text)


def test_probes_are_not_shuffled(spark, monkeypatch):
    """A text was shuffled once for each of its probes: 27 times here, 90 times with 236,000 texts, 400 times with 2.8 million."""
    fps = near_prints(1, 4000).view(np.int64)
    sketch = op7_simhash.sketch_of(np.arange(100, dtype=np.uint64))
    classes = spark.createDataFrame([(int(f), i, bytearray(sketch)) for i, f in enumerate(fps)], "fp long, node long, sketch binary")
    shuffled, real = [], type(classes).repartition
    monkeypatch.setattr(type(classes), "repartition", lambda self, n, *by: (shuffled.append(self.count() if by == ("k",) else 0), real(self, n, *by))[1])
    op7_simhash.linked(classes, 13, 0.8)
    assert 0 < sum(shuffled) <= 20 * len(fps)


def test_cut_leaves_no_shuffle_files(spark):
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for t in top for d, _, names in os.walk(t) for f in names if f.startswith("shuffle_")}
    before = files()
    out = common.cut(spark.range(5000).groupBy((F.col("id") % 97).alias("k")).count())
    for _ in range(50):  # they go in the background
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(common.CLEANUP) == "false" and out.count() == 97
