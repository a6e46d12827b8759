"""Corpus operators: SQL, brute force, round trips, held-out accuracy, and awkward rows."""

import hashlib
import math
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import same
from tests.conftest import DATA
from tracewright.llm import op1_pii, op2_shards, op3_token_counts, op4_maxscore, op5_mix, op6_licenses, op7_simhash, op8_minhash, op9_langid, op10_bpe, queries

QUERIES, ORACLES = queries.queries(), queries.oracle_sql()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kind string, start long, fp string, size string, score string, shard string, v string"
LONG = " ".join(f"w{i % 977}é" for i in range(30_000)) + " x@y.zz"


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", " \t\n", "one", "One", "two words", "Mail a@b.cd, card 4111 1111 1111 1111 or +1 (555) 010-9999 at 10.0.0.1", LONG, LONG, "!!! ???", "日本語 text 𝔘nicode", "a@b.c" * 400, "1 " * 500, "\x00null \x85 char"]
    rows = [(i, t, None if i % 4 == 0 else "en" if i % 2 else "fr", None if i % 3 == 0 else f"s{i % 3}", None, "k", 7, "f", "z", "s", "h", "v") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[5], rows[6], (None, "no id", "en", "s1", 5, "k", 7, "f", "z", "s", "h", "v"), (99, *[None] * 11)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    same(spark, QUERIES[name], ORACLES[name])


OPERATORS = {
    "pii": op1_pii.find_pii,
    "redact": op1_pii.redact,
    "shard": op2_shards.shard,
    "tokens": lambda d: op3_token_counts.count_tokens(op3_token_counts.pack(d)),
    "mix": op5_mix.mix,
    "license": lambda d: op6_licenses.scan(d, op6_licenses.built_in(d.sparkSession)),
    "simhash": op7_simhash.simhash_components,
    "keep_one": op7_simhash.keep_one,
    "minhash": lambda d: d.select("doc_id", op8_minhash.fingerprint(F.col("text")).alias("f")),
    "language": lambda d: op9_langid.predict(d, op9_langid.fit(d)),
    "keep_sure": op9_langid.keep_sure,
    "bpe": lambda d: op10_bpe.decode(op10_bpe.encode(d, *op10_bpe.default_vocabulary()), op10_bpe.default_vocabulary()[0]),
}
SAME_ROWS = {"pii", "shard", "license", "simhash", "minhash", "language", "bpe", "redact"}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, odd, name):
    out = OPERATORS[name](odd).collect()
    if name in SAME_ROWS:
        assert len(out) == odd.count()
    assert OPERATORS[name](odd.limit(0)).count() == 0


def test_redaction_leaves_no_personal_data(odd):
    clean = op1_pii.redact(odd)
    assert clean.columns == odd.columns
    text = clean.where("doc_id = 6").first().text
    assert text == "Mail [email], card [card] or [phone] at [ip]"
    again = op1_pii.find_pii(clean)
    assert again.agg(*(F.sum(F.size(f"pii_{k.name}")).alias(k.name) for k in op1_pii.KINDS)).first()["email"] == 0


def test_added_kinds_need_checksum_or_context(spark):
    rows = [(1, "account DE89 3704 0044 0532 0130 00"), (2, "account DE88 3704 0044 0532 0130 00"), (3, "ssn 123-45-6789"), (4, "part 123-45-6789")]
    found = {r.doc_id: (len(r.pii_iban), len(r.pii_ssn)) for r in op1_pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (1, 0), 2: (0, 0), 3: (0, 1), 4: (0, 0)}


def test_account_numbers_before_capitals(spark):
    numbers = ["AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "DE89 3704 0044 0532 0130 00"]
    rows = [(i, f"Konto {n}{after}") for i, n in enumerate(numbers) for after in (" Bitte", " The", " 12 Mal", " ok", "", ".")]
    out = op1_pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [[x.value for x in r.pii_iban] for r in out] == [[numbers[r.doc_id]] for r in out]
    assert not any(op1_pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).where("text like '%1904%' or text like '%2100%'").collect())


def test_spans_of_a_long_text_take_linear_time(spark):
    """A hundred thousand addresses, cards and blanks in one text; positions and redaction stay exact."""
    piece = "write to ab@c.de, pay 4111 1111 1111 1111 é𝔘 "
    df = spark.createDataFrame([(1, piece * 50_000)], "doc_id long, text string")
    start = time.time()
    row = op1_pii.find_pii(df).select(F.size("pii_email").alias("n"), F.size("pii_card").alias("m"), F.element_at("pii_email", -1).alias("e"), F.element_at("pii_card", 1).alias("c")).first()
    assert (row.n, row.m) == (50_000, 50_000) and row.e.start == len(piece) * 49_999 + 9 and row.e.stop == row.e.start + 7 and (row.e.score, row.c.score) == (1.0, 0.7)
    clean = op1_pii.redact(df).first().text
    assert clean == piece.replace("ab@c.de", "[email]").replace("4111 1111 1111 1111", "[card]") * 50_000
    assert time.time() - start < 60


def test_scores_see_context_beyond_a_block(spark):
    rows = [(1, "x" * 1010 + " tax 123-45-6789"), (2, "x" * 2000 + " part 123-45-6789"), (3, "123-45-6789 " + "y" * 20 + " insured"), (4, "z" * 1018 + " 123-45-6789 tax")]
    found = {r.doc_id: [(x.start, round(x.score, 2)) for x in r.pii_ssn] for r in op1_pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: [(1015, 0.6)], 2: [], 3: [(0, 0.6)], 4: [(1019, 0.6)]}


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b, key = j, (key * op2_shards.MULTIPLIER + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_shards_follow_the_jump_hash(spark, docs):
    rows = QUERIES["op2_shards"](spark, DATA).toPandas()
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in rows.itertuples():
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 40), jump(r.doc_id, 41))
        assert (r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 16, zlib.crc32(text[r.doc_id].encode()))
    for _, slots in rows.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_token_counts_join_blocks(spark):
    texts = ["", "abc", "x" * 50, None, "yz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (1, 2, 7, 1000):
        got = op3_token_counts.count_tokens(op3_token_counts.pack(df, block=block)).orderBy("doc_no").collect()
        assert [r.n_tokens for r in got] == [0, 3, 50, 0, 2] and all(r.closed for r in got)
    open_end = spark.createDataFrame([(1, 0, 0, np.array([5, 256, 7], "<u2").tobytes()), (1, 0, 1, np.array([8], "<u2").tobytes()), (1, 0, 2, None)], "file long, piece long, block long, payload binary")
    assert [(r.n_tokens, r.closed) for r in op3_token_counts.count_tokens(open_end).orderBy("doc_no").collect()] == [(1, True), (2, False)]


def test_token_counts_without_ids(spark):
    """A third of the rows lacks an id and another repeats one: no file has too many rows, none is lost."""
    rows = [(None, f"text {i}") for i in range(2000)] + [(7, f"same {i % 700}") for i in range(1500)] + [(i, "x" * i) for i in range(1000, 1900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    placed = op3_token_counts.filed(df)
    assert placed.groupBy("file", "piece").count().agg(F.max("count")).first()[0] < 1000
    got = op3_token_counts.count_tokens(op3_token_counts.pack(df)).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(t) for _, t in rows)


def plain_top(rows, k):
    """All pairs: rows are (vec_id, v); None comes last among equal scores."""
    out = []
    for i, (q, v) in enumerate(rows):
        if q is not None and q % 50 == 0 and v is not None:
            width = max(len(x) for _, x in rows if x is not None)
            fill = lambda x: list(x) + [0] * (width - len(x))  # noqa: B023, E731
            scored = [(-sum(a * b for a, b in zip(fill(v), fill(x), strict=True)), c is None, c) for j, (c, x) in enumerate(rows) if j != i and x is not None]
            out += [(q, n + 1, c, -s) for n, (s, _, c) in enumerate(sorted(scored, key=lambda t: (t[0], t[1], t[2] or 0))[:k])]
    return sorted(out, key=str)


def test_top_k_of_awkward_rows(spark, monkeypatch):
    rows = [(0, [1, 2]), (1, [5, 5]), (1, [1, 1]), (1, [5, 5]), (2, []), (50, [3]), (50, [0, 9]), (None, [5, 5]), (3, None), (4, [-7, 1]), (100, [0, 0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    is_query = F.col("vec_id") % 50 == 0
    for sizes in ((4096, 65536), (2, 2)):
        monkeypatch.setattr(op4_maxscore, "SHARD_ROWS", sizes)
        for k in (2, 5, 20):
            assert sorted(map(tuple, op4_maxscore.top_k(df, is_query, k).collect()), key=str) == plain_top(rows, k)
    assert op4_maxscore.top_k(df.limit(0), is_query, 3).count() == 0
    assert op4_maxscore.top_k(df.where("vec_id = 3"), is_query, 3).count() == 0
    odd = spark.createDataFrame([([1.0, None],), ([float("nan")],), ([float("inf")],), (None,), ([],), ([0.5],)], "e array<float>")
    assert [r[0] for r in odd.select(op4_maxscore.quantised(F.col("e"))).collect()] == [None, None, None, None, [], [128]]


def test_maxscore_prunes_nothing_that_counts():
    rng = np.random.default_rng(1)
    v = rng.integers(-60, 60, (700, 24))
    v[300:340] = v[10]
    ids = np.arange(700)
    for qid, got, scores in op4_maxscore.maxscore(ids[:60], v[:60], ids, ids, v, 5):
        exact = v @ v[qid]
        best = sorted((i for i in ids if i != qid), key=lambda i: (-exact[i], i))[:5]
        assert got.tolist() == best and scores.tolist() == exact[best].tolist()


def test_mix_meets_targets(spark, docs):
    rows = QUERIES["op5_mix"](spark, DATA).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    by = rows.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by.source_size).all() and ((by.taken - by.target).abs() <= 1).all()
    assert (rows.taken <= 2 * rows["size"]).all() and abs(by.target.sum() - 1.5 * by.source_size.sum()) < 1e-6


def test_licenses_in_other_dress(spark):
    mit = op6_licenses.KNOWN_LICENSES["MIT"]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ;")), (2, mit + " extra"), (3, "released under the mit licence"), (4, None)]
    out = {r.doc_id: r.license for r in op6_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), op6_licenses.built_in(spark)).collect()}
    assert out == {1: "MIT", 2: None, 3: "MIT", 4: None}


def test_licenses_as_in_files(spark):
    isc, mit = op6_licenses.KNOWN_LICENSES["ISC"], op6_licenses.KNOWN_LICENSES["MIT"]
    wrapped = isc.replace("above copyright notice", "above\ncopyright notice")
    rows = [(1, "ISC License\n\nCopyright (c) 2004-2010 by Someone\n\n" + wrapped), (2, "# The MIT License (MIT)\n\nCopyright 2020 Someone\n" + mit), (3, "MIT License"), (4, "Copyright 1999 A. B.\n" + op6_licenses.KNOWN_LICENSES["BSD-3-Clause"])]
    rows += [(5, "Copyright law is a long story that the year 2020 did not end, " + "as the courts say again and again " * 9)]
    found = op6_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), op6_licenses.built_in(spark)).collect()
    assert {r.doc_id: r.license for r in found} == {1: "ISC", 2: "MIT", 3: None, 4: "BSD-3-Clause", 5: None}
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.digest != empty for r in found)


def test_licenses_of_lines(spark, docs):
    mit, apache = op6_licenses.KNOWN_STATEMENTS["MIT"], op6_licenses.KNOWN_STATEMENTS["Apache-2.0"]
    rows = [(1, f"Prose.\n{mit.upper()}\nMore.\n{apache}\n{mit}"), (2, f"Prose. {mit}"), (2, mit), (None, f"a\n{apache}"), (3, None), (4, "")]
    found = sorted(((r.doc_id or 0, r.license, r.line_licenses) for r in op6_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), op6_licenses.built_in(spark)).collect()), key=str)
    assert found == sorted([(1, None, "Apache-2.0,MIT"), (2, None, ""), (2, "MIT", "MIT"), (0, None, "Apache-2.0"), (3, None, ""), (4, None, "")], key=str)
    got = {r.doc_id: r.line_licenses for r in op6_licenses.scan(docs, op6_licenses.built_in(spark)).where("line_licenses <> ''").collect()}
    plain = {r.doc_id for r in docs.collect() if r.text and any(line.strip() in op6_licenses.KNOWN_STATEMENTS.values() for line in r.text.split("\n"))}
    assert set(got) == plain and plain


def plain_components(ids, fps, tau):
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= tau) + i + 1:
            a, b = label[i], label[j]
            if a != b:
                label = [min(a, b) if x in (a, b) else x for x in label]
    return [ids[x] for x in label]


@pytest.mark.parametrize(("words", "tau"), [(3, 3), (5, 13)])
def test_simhash_against_all_pairs(docs, words, tau):
    rows = sorted(op7_simhash.simhash_components(docs, words, tau).collect())
    text = {r.doc_id: r.text for r in docs.collect()}
    fps = np.array([r.fp for r in rows], dtype=np.int64).view(np.uint64)
    assert fps.tolist() == [op7_simhash.fingerprint_of(text[r.doc_id], words) for r in rows]
    assert [r.component_id for r in rows] == plain_components([r.doc_id for r in rows], fps, tau)


def test_pigeonhole_in_hot_groups(spark):
    """Thousands of close fingerprints share most group values; blocks must not lose a link."""
    rng = np.random.default_rng(3)
    fps = np.unique(np.concatenate([np.uint64(0xABCDEF0123456789) ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64)), rng.integers(0, 2**63, 300).astype(np.uint64)]))
    classes = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64))], "fp long, node long").repartition(4)
    roots = {r.node: r.root for r in op7_simhash.components(op7_simhash.linked(classes, 3)).collect()}
    assert [roots.get(i, i) for i in range(len(fps))] == plain_components(list(range(len(fps))), fps, 3)


def test_near_copies_go_and_others_stay(spark):
    words = [f"word{i}" for i in range(400)]
    near = words.copy()
    near[200] = "changed"
    texts = [" ".join(words), " ".join(near), " ".join(words).upper(), " ".join(f"other{i}" for i in range(400)), "", None]
    kept = op7_simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4]


def plain_keep(text):
    """Smallest ids of the components of all pairs that are close and similar."""
    ids = sorted(text)
    prints = np.array([op7_simhash.fingerprint_of(text[i], 5) for i in ids], dtype=np.uint64)
    words = [(text[i] or "").encode().lower().split() for i in ids]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in words]
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= op7_simhash.bits_for(0.8) + 4) + i + 1:
            a, b = label[i], label[j]
            if a != b and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                label = [min(a, b) if x in (a, b) else x for x in label]
    return sorted({ids[x] for x in label})


def test_keep_one_against_all_pairs(spark, docs):
    """A candidate that fails the check on texts must not hide another link of its group."""
    text = {r.doc_id: r.text for r in docs.collect()}
    base = [f"t{i}" for i in range(300)]
    for n in range(120):  # copies with growing edits: neighbours are similar, the ends aren't
        text[100_000 + n] = " ".join(w if (i * 7919) % 300 >= n else f"x{i}_{n % 3}" for i, w in enumerate(base))
    kept = op7_simhash.keep_one(spark.createDataFrame(sorted(text.items()), "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == plain_keep(text)


def test_equal_fingerprints_of_different_texts_stay(spark):
    """One shingle that makes up most of a text decides every bit; such texts share nothing else."""
    texts = ["- " * 80 + " ".join(f"u{n}x{i}" for i in range(60)) for n in range(40)]
    texts += [texts[7].upper(), texts[9].replace("u9x30", "new")]  # an exact and a near copy of texts that aren't the first
    assert len({op7_simhash.fingerprint_of(t, 5) for t in texts}) == 1
    kept = op7_simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == list(range(40))


def test_no_link_of_a_dense_group_is_hidden(spark):
    """Far more candidates a text than forests of links: the links that hold must still be found."""
    texts = ["- " * 80 + " ".join(f"u{n}x{i}" for i in range(60)) for n in range(120)]
    texts += [texts[n].replace(f"u{n}x30", "new") for n in range(0, 120, 5)]
    assert len({op7_simhash.fingerprint_of(t, 5) for t in texts}) == 1
    kept = op7_simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == list(range(120))


def test_rows_that_share_an_id_count_by_text(spark):
    one, other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    rows = [(5, one, "b"), (5, one, "a"), (5, other, "c"), (6, other.upper(), "d"), (4, third, "e"), (5, third, "f"), (None, one, "g")]
    kept = op7_simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, _id string")).collect()
    assert sorted(r._id for r in kept) == ["a", "c", "e", "g"]


def test_sketches_follow_the_similarity():
    rng = np.random.default_rng(5)
    close, errors = op7_simhash.Closeness(13, 0.8), []
    for same in rng.uniform(0.5, 1, 300):
        u = np.unique(rng.integers(2**63, size=600, dtype=np.uint64))
        n = int(len(u) * same)
        a, b = u[: (len(u) + n) // 2], u[(len(u) - n) // 2 :]
        x, y = (np.frombuffer(op7_simhash.sketch_of(z), dtype=np.uint8)[None] for z in (a, b))
        equal = op7_simhash.EQUAL_HALVES[x[:, 4:] ^ y[:, 4:]].sum() / op7_simhash.MINS
        errors.append((equal - 1 / 16) / (15 / 16) - op7_simhash.overlap(a, b))
        assert op7_simhash.overlap(a, b) < 0.8 or close.sketched(x, y)[0]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_minhash_estimates(spark, docs):
    rows = QUERIES["op8_minhash"](spark, DATA).orderBy("doc_id").collect()
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    ids, errors = sorted(text), []

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    for r in rows:
        t, after = text[r.doc_id], text[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(t)
        a, b = shingles(t), shingles(edited)
        errors.append(r.near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_next_rows_however_ids_are_spread(spark, monkeypatch):
    monkeypatch.setattr(op8_minhash, "RUN_ROWS", 8)
    rows = [(i, f"t{i}") for i in range(200)] + [(10**18, "far"), (-5, "low")] + [(77, f"again {i:03d}") for i in range(300)] + [(None, f"none {i:03d}") for i in range(100)] + [(3, "t3"), (3, "t3")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = op8_minhash.with_next(df, {"text": F.col("text")}).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = [(*a, b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert op8_minhash.with_next(df.limit(0), {"text": F.col("text")}).count() == 0
    assert [tuple(r) for r in op8_minhash.with_next(df.where("text = 'far'"), {"text": F.col("text")}).collect()] == [(10**18, "far", "far")]


def plain_bayes(train, texts):
    """Posterior of each language by the plain formula over all cells."""
    langs = sorted({x for x, _ in train})
    counts, docs_of = {x: np.zeros(op9_langid.CELLS) for x in langs}, {x: 0 for x in langs}
    for x, t in train:
        counts[x] += np.bincount(op9_langid._grams([t])[1], minlength=op9_langid.CELLS)
        docs_of[x] += 1
    out = []
    for t in texts:
        cells = op9_langid._grams([t])[1]
        logs = np.array([math.log(docs_of[x] / len(train)) + np.log((counts[x][cells] + op9_langid.SMOOTH) / (counts[x].sum() + op9_langid.SMOOTH * op9_langid.CELLS)).sum() for x in langs])
        share = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        out.append((langs[int(logs.argmax())], float(share.max())) if len(cells) else ("und", 0.0))
    return out


def test_language_against_plain_bayes(spark, docs):
    """Short texts, so that posteriors aren't all 1; one language a matrix gives the same as all in one."""
    rows = [(r.lang, r.text) for r in docs.where("lang is not null and text is not null").limit(60).collect()]
    texts = [t[i : i + 4] for i, (_, t) in enumerate(rows)] + ["", "12 !"]
    train = spark.createDataFrame(rows, "lang string, text string")
    want = plain_bayes(rows, texts)
    for at_once in (64, 1):
        models = op9_langid.fit(train, at_once)
        assert len(models) == (1 if at_once == 64 else len({x for x, _ in rows}))
        got = [(r.lang_pred, r.score) for r in op9_langid.predict(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), models).orderBy("i").collect()]
        assert [g[0] for g in got] == [w[0] for w in want] and max(abs(g[1] - w[1]) for g, w in zip(got, want, strict=True)) < 1e-4


def test_all_texts_with_letters_stay_without_labels(spark):
    rows = spark.createDataFrame([(1, "words", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in op9_langid.keep_sure(rows).collect()] == [1]


def test_language_on_held_out_documents(spark, docs):
    out = QUERIES["op9_langid"](spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95 and all(0 <= r.score <= 1 for r in out)
    empty = op9_langid.predict(spark.createDataFrame([(None,), ("123 !",)], "text string"), op9_langid.fit(docs)).collect()
    assert [(r.lang_pred, r.score) for r in empty] == [("und", 0.0)] * 2


def test_bpe_equals_tiktoken(spark, docs, odd):
    import tiktoken

    path, pattern = op10_bpe.default_vocabulary()
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=op10_bpe.ranks(path), special_tokens={})
    rows = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = op10_bpe.decode(op10_bpe.encode(rows, path, pattern, offsets=True), path).collect()
    for r, (_, text) in zip(got, rows.collect(), strict=True):
        assert r.ids == plain.encode_ordinary(text or "") and bytes(r.decoded) == (text or "").encode()
        assert len(r.ends) == len(r.ids) and (r.ends[-1:] or [0]) == [len(text or "")]


def plain_pipeline(rows):
    """(doc_id, ids) of all stages: plain Bayes, all pairs, the SQL of spans and of the mix, tiktoken."""
    import duckdb
    import pandas as pd
    import tiktoken

    learn = [(r.lang, r.text) for r in rows if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    sure = plain_bayes(learn, [r.text or "" for r in rows])
    rows = [r for r, (lang, score) in zip(rows, sure, strict=True) if lang != "und" and score >= 0.5]
    stay = set(plain_keep({r.doc_id: r.text for r in rows}))
    documents = pd.DataFrame([(r.doc_id, r.text, r.source) for r in rows if r.doc_id in stay], columns=["doc_id", "text", "source"])
    con = duckdb.connect()
    con.register("documents", documents)
    spans = dict(con.sql(f"SELECT doc_id, spans FROM ({op1_pii.ORACLE_SQL})").fetchall())

    def redacted(text, found):
        out, end = "", 0
        for start, stop, kind in sorted(((int(a), -int(b), k) for k, a, b in (x.split(":") for x in found.split(",") if x))):
            if start >= end:
                out += text[end:start] + f"[{kind}]"
            end = max(end, -stop)
        return out + text[end:]

    clean = documents.assign(text=[redacted(t, spans[i]) for i, t in zip(documents.doc_id, documents.text, strict=True)])
    con.register("documents", clean)
    taken = {i: (size, t) for i, size, t in con.sql(f"SELECT doc_id, size, taken FROM ({op5_mix.ORACLE_SQL})").fetchall()}
    path, pattern = op10_bpe.default_vocabulary()
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=op10_bpe.ranks(path), special_tokens={})
    out = []
    for i, text in zip(clean.doc_id, clean.text, strict=True):
        size, t = taken[i]
        out += [(int(i), plain.encode_ordinary(text))] * (math.floor(t / size + 0.5) if size else 1)
    return sorted(out)


def test_pipeline_against_plain_stages(spark, docs):
    out = corpus_pipeline.run(spark, DATA)
    assert out.where(F.size("ids") != F.col("n_tokens")).count() == 0
    assert sorted((r.doc_id, list(r.ids)) for r in out.collect()) == plain_pipeline(docs.orderBy("doc_id").collect())


def test_stages_keep_columns_and_stand_awkward_rows(spark, odd):
    rows = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, DATA)
        assert out.columns == odd.columns, name
        rows = out.cache()
    assert corpus_pipeline.STAGES[-1][1](spark, rows, DATA).count() == rows.count()
