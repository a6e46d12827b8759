"""What the findings of round 3 showed, in small."""

from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.test_details import CHUNKS, plain_scores
from tracewright.functions import text as T
from tracewright.llm import op6_licenses, op8_minhash, op9_langid
from tracewright.operators import curation, evaluation, flags, retrieval
from tracewright.plans import detail_queries
from tracewright.sources import logs

#: Words beside letters that aren't ASCII, line ends of all sorts, vertical tabs, letters that fold to s and k.
ODD = (
    "élè nc", "fènc", "ncé", "wgeté", "select a\u0085b from", "select a\rb from", "select a\nb from", "select\u000ba from", "/etc/paſswd", "a.exe\n", "a.exė", "/login\n", "/login", "口令token=abc", "toKen=abc d", "token\u000b= x",
    "ſh /bin/ſh", "niktoü", "cmd一", "onerror\u000b=", "a" * 79 + "K", "eyJabcdefgh1.abcdefgh2é", "İd ;ıd",
)


def test_patterns_mean_the_same_in_sql(spark):
    df, con = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string"), duckdb.connect()
    patterns = [*T.SIGNATURES.values(), *T.LISTS.values(), T.SECRET, T.JWT, T.SENSITIVE_PATH, T.MINER, flags.FILE_INCLUSION, flags.VERSION_PROBE, flags.WINDOWS_COMMAND]
    got = [list(r) for r in df.orderBy("i").select(*(T.has(F.col("t"), p) for p in patterns)).collect()]
    assert got == [[con.execute("select regexp_matches(?, ?)", [t, p]).fetchone()[0] for p in patterns] for t in ODD]


def test_word_edges_are_ascii_in_flags(spark):
    df = spark.createDataFrame([("fènc",), ("wgeté",), ("wgetx",)], "text string").withColumns({"agents": F.lit(""), "uris": F.lit("")})
    assert [(r.exploit.wget_curl_download, r.exploit.matched_keywords) for r in flags.exploit_flags(df).collect()] == [(True, ["download_command"]), (True, ["download_command"]), (False, [])]
    assert [r.names for r in df.select(T.match_signatures(F.col("text")).alias("names")).collect()] == [["download_command"], ["download_command"], []]


def test_phrases_with_line_ends_and_tabs(spark):
    docs = {1: "it was red.\nBlue moon\tlow tide end", 2: "was red. blue moon low  tide", 3: "xred.\nbluey moon low\ttide", 4: "a\n\nb c "}
    chunks = spark.createDataFrame([(i, t.lower()) for i, t in docs.items()], "chunk_id long, blob string")
    terms = ["red.\nblue", "red.\nblue moon", "moon\tlow tide", "red. blue", "low  tide", "a\n\nb", "\n\nb c", "b c ", "low\ttid", "\nblue", "red.\n"]
    got = {(r.term, r.chunk_id) for r in retrieval.phrase_matches(spark.createDataFrame([(t,) for t in terms], "term string"), chunks).collect()}
    assert got == {(t, i) for t in terms for i, d in docs.items() if t in d.lower()} and len(got) > 10
    queries = spark.createDataFrame([(1, "zz", ["red.\nblue"])], "query_id long, query string, terms array<string>")
    plain = chunks.select("chunk_id", F.col("chunk_id").alias("doc_id"), F.col("blob").alias("text"))
    assert {(r.chunk_id, r.score) for r in retrieval.retrieve_top_k(queries, plain, 5).collect()} == {(1, 4.0), (2, 1.0), (3, 3.0)}


def test_matching_spreads_used_rows_by_their_own_ids(spark):
    guesses = spark.range(4000).select(F.col("id").alias("prediction_id"), F.concat(F.lit("f"), F.col("id").cast("string")).alias("file"), F.lit(None).cast("string").alias("number"), F.lit(None).cast("string").alias("signature"))
    answers = guesses.select((F.col("prediction_id") + 10_000).alias("answer_id"), "file", "number", "signature")
    out = evaluation.match_answers(guesses, answers, (("number",), ("file",), ("signature",)))
    assert sorted((r.prediction_id, r.answer_id, r.method) for r in out.collect()) == [(i, i + 10_000, "file") for i in range(4000)]
    joined = []
    real = type(guesses).join

    def spy(self, other, on=None, how=None):
        joined.append((how, self.where(F.col(on if isinstance(on, str) else "prediction_id").isNull()).count()))
        return real(self, other, on, how)

    type(guesses).join = spy
    try:
        evaluation.match_answers(guesses, answers, (("number",), ("file",)))
    finally:
        type(guesses).join = real
    assert joined == [("left_anti", 0), ("left_anti", 0)]  # no rows without an id, which would all fall to one task


def test_rules_go_to_the_records(spark):
    records = spark.range(100).select(F.col("id").alias("record_id"), F.array(F.lit("A"), F.lit("B")).alias("candidates"))
    rules = spark.createDataFrame([(1, ["A"]), (2, ["A", "B"]), (3, ["C"])], "rule_id int, codes array<string>")
    out = curation.boundary_rule_join(records, rules)
    assert "hashpartitioning(code" not in out._jdf.queryExecution().toString()  # few codes would be few tasks
    assert {(r.place, r.rule_id, r.n) for r in out.collect()} == {(1, 2, 2), (2, 1, 1)} and out.count() == 200


def test_result_tables_are_read_in_pieces(spark, tmp_path, monkeypatch):
    lines = [f"f{i}.pcap,{i}, 技{i} " for i in range(25_000)]
    head = "文件名,编号,技术编号"
    for name, encoding in (("a", "utf-8-sig"), ("b", "gb18030")):
        (tmp_path / f"{name}.csv").write_bytes("\r\n".join([head, *lines, ",,", '"q,\n1",x,']).encode(encoding))
    (tmp_path / "c.csv").write_bytes((head + "\n").encode("gb18030") + b"\xff\xff,1,2\n")
    (tmp_path / "d.csv").write_bytes(b"")
    rows = logs.read_result_table(spark, str(tmp_path)).collect()
    for name in "ab":
        got = [(r.pcap, r.number, r.technique) for r in rows if r.file_path.endswith(f"{name}.csv")]
        assert got == [(f"f{i}.pcap", str(i), f"技{i}") for i in range(25_000)] + [("q,\n1", "x", "")]
    assert [(r.number, "�" in r.pcap) for r in rows if r.file_path.endswith("c.csv")] == [("1", True)] and len(rows) == 50_003


def test_licence_lines_without_marks_are_as_before(spark):
    from tracewright.llm import op6_licenses as L6

    texts = ["Copyright (c) 2020 A\nx y", "(C) me\nz", "© 2021 b\nz", "All rights reserved.\nq", "MIT License\n\nPermission here", "MIT Licence: z", "plain, text", "copyrightable work", None, "", "the isc license\ncopyright 2020 z\nend"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {r.doc_id: r.d for r in df.select("doc_id", L6.digest(F.col("text")).alias("d")).collect()}
    con = duckdb.connect()
    con.execute("create table documents(doc_id int, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    assert got == {r[0]: r[1] for r in con.execute(L6.ORACLE_SQL).fetchall()}


def test_scan_records_name_all_ports(spark, tmp_path):
    con = duckdb.connect()
    con.sql("create table events as select 3 * i as event_id, 1::BIGINT as user_id, timestamp '2024-01-01' + to_minutes(i::INT) as ts, 'error' as event_type, 1e0 as value, '{\"k\": ' || (60 + i) || '}' as props from range(40) r(i)")
    con.sql(f"copy events to '{tmp_path}/events.parquet'")
    want = con.sql(f"select record_id, ports from ({detail_queries.ORACLES['scan_group_record']})").fetchall()
    got = [tuple(r) for r in detail_queries.scan_group_record(spark, str(tmp_path)).select("record_id", "ports").collect()]
    assert got == want and len(want) == 1 and want[0][1] == ",".join(str(1060 + i) for i in range(40))


def test_next_rows_come_without_a_join(spark, capsys):
    rows = spark.range(3000).select(((F.col("id") * 7) % 3000).alias("doc_id"), F.col("id").cast("string").alias("text"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = op8_minhash.with_next(rows, {"text": F.col("text")})
        texts = {r.doc_id: r.text for r in rows.collect()}
        assert sorted((r.doc_id, r.text, r.next_text) for r in out.collect()) == [(i, texts[i], texts[(i + 1) % 3000]) for i in range(3000)]
        out.explain()
        assert "Join" not in capsys.readouterr().out  # each text moves once, to its run
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_lines_are_digested_once_each_as_rows(spark, capsys):
    rows = [(1, "x\nReleased under the MIT License."), (1, "x Released under the MIT License."), (None, "Released under the MIT License.\n"), (2, None)]
    out = op6_licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), op6_licenses.built_in(spark))
    assert sorted(((r.doc_id or 0, r.license, r.line_licenses) for r in out.collect()), key=str) == [(0, "MIT", "MIT"), (1, None, ""), (1, None, "MIT"), (2, None, "")]
    out.explain()
    assert "lambda" not in capsys.readouterr().out  # functions over arrays are interpreted, rows are compiled


def test_predictions_leave_a_batch_in_slices():
    counts = np.random.default_rng(0).integers(0, 50, (op9_langid.CELLS, 2))
    model = op9_langid.Model(["de", "en"], np.log([0.5, 0.5]), counts)
    texts = [f"text {i} of some words" if i % 7 else None for i in range(3000)]
    start = [pa.array(["und"] * 3000), pa.array(np.zeros(3000)), pa.array(np.full(3000, -np.inf))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *start], ["text", "lang_pred", "score", "_top"])
    out = list(op9_langid._scorer(SimpleNamespace(value=model), 0)(iter([batch])))
    assert max(map(len, out)) <= 512 and sum(map(len, out)) == 3000
    want = model.scores([t or "" for t in texts])[0]
    got = pa.Table.from_batches(out)
    assert got["text"].to_pylist() == texts and [x for x in got["_top"].to_pylist() if x != -np.inf] == [max(w) for w, t in zip(want, texts, strict=True) if t]


def test_pairs_of_queries_and_chunks_are_no_rows(spark, monkeypatch):
    """Every query shares words with every chunk; shards and blocks are small. Only queries are held, and the best are those of plain Python."""
    held, real = [], retrieval.held
    monkeypatch.setattr(retrieval, "held", lambda df: held.append(df.count()) or real(df))
    monkeypatch.setattr(retrieval, "SHARD_CHUNKS", (60, 60))
    monkeypatch.setattr(retrieval, "BLOCK_QUERIES", 8)
    words = [f"word{i}" for i in range(30)] + ["scan", "xss", "rescanning", "forward", "password12"]
    text = lambda i, n: " ".join(words[(i * j + j * j) % len(words)] for j in range(1, n))
    chunks = [(f"c{i}", f"d{i % 50}", text(i, 3), [words[i % 35]], f"{text(i + 1, 4 + i % 9)} all-of-them".title(), "x", ["port_scan"] if i % 3 == 0 else [], []) for i in range(400)]
    queries = [(i, f"all-of-them {text(i, 6)}", [words[i % 35], "all-of", "word1", "scan", "ord12"]) for i in range(20)]
    df = spark.createDataFrame(chunks, CHUNKS)
    for seeds in (1, 2000):
        got = {}
        for r in retrieval.retrieve_top_k(spark.createDataFrame(queries, "query_id long, query string, terms array<string>"), df, 5, seeds=seeds).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.chunk_id, r.score))
        assert got == plain_scores(queries, chunks)
    assert max(held) <= len(queries)


def test_terms_inside_runs(spark):
    runs, terms = ["unforgettable", "get", "", "abababab", "口令密码口令"], ["forget", "table", "unforgettable", "abab", "bababa", "tabled", "令密码口", "gett"]
    want = {(r, t) for r, run in enumerate(runs) for t, term in enumerate(terms) if term in run}
    assert set(zip(*map(list, retrieval.terms_inside(runs, terms)), strict=True)) == want and len(want) == 7
    assert [len(x) for x in retrieval.terms_inside([], [])] == [0, 0]


def test_phrases_at_odd_places():
    """Short, long and overlapping phrases, at the ends of texts, across texts, and more than one behind the same eight bytes."""
    texts = ["ab cd", "xab cdé", "b cd", "", "one of the words of the one", "of the wo", "rds of", "aé 一丁 b", "ab\tcd\n", "the end of the words"]
    phrases = ["b cd", "ab cd", "of the", "of the w", "of the words", "words of the one", "é 一", "one of the words of the one", "b\tcd\n", "wo rds", "the end of the words!"]
    text, phrase = retrieval.phrases_inside([t.encode() for t in texts], [p.encode() for p in phrases])
    assert set(zip(text.tolist(), phrase.tolist(), strict=True)) == {(i, j) for i, t in enumerate(texts) for j, p in enumerate(phrases) if p in t}
    assert [len(x) for x in retrieval.phrases_inside([], [b"a bc"]) + retrieval.phrases_inside([b"a bc"], [])] == [0] * 4


def test_words_of_texts_are_no_rows(spark, monkeypatch):
    """With phrases, each word of each text was a row of two shuffles."""
    texts = [" ".join(f"w{(i * j) % 50}" for j in range(400)) for i in range(60)]
    chunks = spark.createDataFrame([(f"c{i}", f"d{i:02d}", t) for i, t in enumerate(texts)], "chunk_id string, doc_id string, text string")
    queries = spark.createDataFrame([(1, "w7", ["w4 w6", "w3"])], "query_id long, query string, terms array<string>")
    out = retrieval.retrieve_top_k(queries, chunks, 5)
    assert {r.chunk_id for r in out.collect()} == {c for c, _ in plain_scores([(1, "w7", ["w4 w6", "w3"])], [(f"c{i}", f"d{i:02d}", "", [], t, None, None, None) for i, t in enumerate(texts)])[1]}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate posexplode" not in plan and "Join" not in plan
