"""Ranks, episodes, matching, retrieval, group records, capture evidence and model answers on small rows."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tracewright.functions import ranks, text
from tracewright.operators import capture, context, curation, evaluation, evidence, group_records, groups, predictions, query_rules, retrieval
from tracewright.operators.merges import merge_values
from tracewright.sources import logs


def test_ranks_of_one_key_and_many(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 == 0, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"), (F.col("id") * 7919 % 1009).alias("v"), "id")
    got = ranks.numbered(rows, ["key"], [F.asc("v"), F.asc("id")], "rank").collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.v, r.id)):
        by.setdefault(r.key, []).append(r.rank)
    assert len(by) == 252 and all(v == list(range(1, len(v) + 1)) for v in by.values())
    every = ranks.numbered(rows, [], [F.desc("id")], "rank").collect()
    assert {(r.id, r.rank) for r in every} == {(i, 5000 - i) for i in range(5000)}
    assert ranks.numbered(rows.limit(0), ["key"], [F.asc("id")], "rank").count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        spread = ranks.numbered(rows.where("key = 'hot'"), ["key"], [F.asc("id")], "rank")
        assert spread.select(F.spark_partition_id()).distinct().count() > 1  # no single task holds the key
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain_episodes(times, window):
    out, anchor = [], None
    for t in times:
        anchor = t if anchor is None or (t is not None and t - anchor > window) else anchor
        out.append(anchor)
    return out


def test_episodes_of_a_long_stretch(spark):
    """A million starts of one key without a silence, read in batches."""
    rows = spark.range(1_000_000).select(F.col("id").alias("session_id"), F.lit("c").alias("capture_id"), F.lit("a").alias("src_ip"), F.lit("b").alias("dst_ip"), F.lit("tcp").alias("proto"), (F.col("id") % 100).cast("int").alias("dst_port"), (F.col("id") * 0.5).alias("start_time"))
    out = groups.scan_episodes(rows, 300.0, 2, 2).groupBy("episode_start").count().orderBy("episode_start").collect()
    want = {}
    for a in plain_episodes([i * 0.5 for i in range(1_000_000)], 300.0):
        want[a] = want.get(a, 0) + 1
    assert [(r.episode_start, r["count"]) for r in out] == sorted(want.items())


def test_episodes_against_a_plain_walk(spark):
    data = [(i, "c", "a", f"d{i % 3}", "tcp", i % 7, None if i % 17 == 5 else float(i * i % 313) / 10) for i in range(400)]
    rows = spark.createDataFrame(data, "session_id long, capture_id string, src_ip string, dst_ip string, proto string, dst_port int, start_time double")
    got = {r.session_id: r.episode_start for r in groups.scan_episodes(rows, 0.3, 1, 1).collect()}
    for d in ("d0", "d1", "d2"):
        mine = sorted((r for r in data if r[3] == d), key=lambda r: (r[6] is None, r[6] or 0, r[0]))
        assert [got[r[0]] for r in mine] == plain_episodes([r[6] for r in mine], 0.3)
    assert groups.scan_episodes(rows.withColumn("start_time", F.lit(None).cast("double")), 1.0, 1, 1).where("episode_start is not null").count() == 0


def test_matching_reads_little(spark):
    sides = [spark.createDataFrame([(i, f"f{i // 2}", str(i % 2), None) for i in range(n)], f"{name} long, file string, number string, signature string") for n, name in ((6, "prediction_id"), (5, "answer_id"))]
    out = evaluation.match_answers(*sides)
    assert sorted(map(tuple, out.collect())) == [(i, i, "file+number") for i in range(5)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Scan") + out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 12
    left = evaluation.match_answers(sides[0].withColumn("number", F.lit(None).cast("string")), sides[1]).collect()
    assert [tuple(r) for r in left] == [] or all(r.method == "file" for r in left)


def test_run_cost_takes_the_95th_place(spark):
    rows = spark.range(1, 41).select(F.lit("m").alias("mode"), F.lit(1000).alias("tokens_in"), F.lit(100).alias("tokens_out"), F.col("id").cast("double").alias("latency"))
    row = evaluation.run_cost(rows, retries=(0.0,)).first()
    assert (row.p95_latency, row.mean_latency, row.throughput, row.serial_days) == (38.0, 20.5, round(40 / 820, 4), round(40 * 20.5 / 86400, 4))
    assert evaluation.run_cost(rows, retries=(0.0,), elapsed=80.0).first().throughput == 0.5


def test_aliases_reach_nested_ids(spark):
    rows = spark.createDataFrame([("b", 2, ["b", "2", "x"], ("2", {"k": "b"})), ("a", 1, ["a"], None), ("b", 3, None, ("b", {}))], "capture_id string, record_id long, seen array<string>, s struct<id:string,m:map<string,string>>")
    got = {r.record_id: r for r in curation.pseudonymize(rows).collect()}
    assert got[1].record_alias == "capture_1_record_1" and got[3].record_alias == "capture_2_record_2"
    assert got[2].seen == ["capture_2", "capture_2_record_1", "x"] and got[2].s.id == "capture_2_record_1" and got[2].s.m == {"k": "capture_2"} and got[1].s is None


def test_session_numbers_grow_past_six_digits(spark):
    rows = spark.createDataFrame([("c", 2, 1.0), ("c", 1, None), ("c", 3, 0.5)], "capture_id string, session_id long, start_time double")
    assert {r.session_id: r.session_no for r in context.number_sessions(rows).collect()} == {3: "000001", 2: "000002", 1: "000003"}


CHUNKS = "chunk_id string, doc_id string, title string, keywords array<string>, text string, category string, attack_type array<string>, attack_stage array<string>"


def plain_scores(queries, chunks):
    import re

    def tokens(t):
        out = [x.strip(".,;()[]{}<>\"'") for x in re.findall(r"[A-Za-z0-9_.:/+-]+|[一-鿿]+", (t or "").lower())]
        return {x for x in out if len(x) >= 2}

    out = []
    for q, query, terms in queries:
        asked = tokens(" ".join(terms) + " " + (query or ""))
        for c in chunks:
            title, words = tokens(c[2]), tokens(" ".join(c[3]))
            blob = f"{c[2] or ''} {' '.join(c[3])} {c[4] or ''}".lower()
            score = sum(3 for t in {t.lower() for t in terms} if len(t) >= 4 and t in blob) + 3 * len(asked & title) + 4 * len(asked & words) + 0.5 * min(len(asked & tokens(c[4])), 20)
            score += 8 * sum(n in " ".join(terms).lower() and n in blob for n in retrieval.SIGNATURE_NAMES)
            score += 2 * bool(asked & {"scan", "port_scan"} and ("port_scan" in c[6] or "reconnaissance" in c[7]))
            if score > 0:
                out.append((q, score, c[1], c[0]))
    best = {}
    for q, score, d, c in sorted(out, key=lambda r: (r[0], -r[1], r[2], r[3])):
        best.setdefault(q, []).append((c, score))
    return {q: rows[:5] for q, rows in best.items()}


@pytest.mark.parametrize("seeds", [1, 50])
def test_phrases_and_bounds_against_plain_python(spark, seeds):
    words = ["scan", "port", "sql", "injection", "alpha", "beta", "gamma", "xss", "the", "of", "login-page", "cve-2021-1"]
    word = lambda i: words[(i * i + 3 * i) % len(words)]
    chunks = [(f"c{i}", f"d{i % 40}", f"{word(i)} {word(i + 1)}", [word(i + 2), "kw%d" % (i % 9)], " ".join(word(i * j + j) for j in range(1 + i % 37)) + ("\nsql injection, port" if i % 50 == 0 else " re-scanning  the"), "x", ["port_scan"] if i % 3 == 0 else [], []) for i in range(300)]
    queries = [(1, "scan port", ["scan", "port"]), (2, "", ["sql injection", "gamma beta"]), (3, "alpha", ["injection, po", "the of", "e  th", "can"]), (4, None, ["l injec", "scanning  the", "missing words here"]), (5, "the of", ["of the scan", "kw3"]), (6, "", []), (7, "nothing at all zzz", ["zzz"])]
    got = retrieval.retrieve_top_k(spark.createDataFrame(queries, "query_id long, query string, terms array<string>"), spark.createDataFrame(chunks, CHUNKS), 5, seeds=seeds).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.chunk_id, r.score))
    assert by == plain_scores(queries, chunks)


def test_common_words_are_only_probed(spark):
    """A chunk that holds nothing but common words is never scored."""
    chunks = [(f"c{i}", f"d{i:04d}", "", [], "the of and " + (f"rare{i % 4} seldom{i % 3}x word{i % 2}" if i < 40 else "else"), "x", [], []) for i in range(2000)]
    df = spark.createDataFrame(chunks, CHUNKS)
    queries = spark.createDataFrame([(i, f"the of and rare{i} seldom0x seldom1x word0 word1") for i in range(4)], "query_id long, query string")
    words = retrieval._asked(queries)
    asks = words.select("query_id", F.explode("tokens").alias("key"), "terms").select("query_id", "key", F.array_contains("terms", F.col("key")).cast("int").alias("factor"))
    asked = words.select("query_id", F.lit(0).alias("q_bits"))
    pairs = retrieval.candidates(asks, retrieval.token_postings(retrieval._plain(df)), asked, 5, 20, 40).count()
    assert 20 <= pairs <= 4 * 40  # of 8,000 pairs that share a word
    assert len(retrieval.retrieve_top_k(queries, df, 5).collect()) == 20


def test_typed_merge_at_every_depth(spark):
    schema = "g string, ord long, flag boolean, http_request_body_len long, total_files int, size double, name string, payload_visibility string, seen array<string>, s struct<hit:boolean,n:int,deep:struct<tags:array<string>>>, codes map<string,int>, items array<struct<a:int>>"
    rows = [
        ("x", 2, False, 5, 1, 1.5, "b", "metadata_only", ["q", "p"], (None, 3, (["t2"],)), {"200": 1}, [(1,)]), ("x", 1, True, 7, 2, 0.5, "", "plaintext_http", ["p", "P", ""], (True, 1, (["t1", "t2"],)), {"200": 4, "404": 2}, [(2,), (1,)]),
        ("x", 3, None, None, None, None, "c", "odd", None, None, None, None), ("y", 1, None, None, None, None, "-", "odd", [], None, {}, []),
    ]
    out = {r.g: r for r in merge_values(spark.createDataFrame(rows, schema), ["g"], "ord").collect()}
    x, y = out["x"], out["y"]
    assert (x.flag, x.http_request_body_len, x.total_files, x["size"], x.name, x.payload_visibility, x.seen) == (True, 12, 3, 1.5, "b", "plaintext_http", ["p", "P", "q"])
    assert (x.s.hit, x.s.n, x.s.deep.tags) == (True, 3, ["t1", "t2"]) and x.codes == {"200": 4, "404": 2} and [i.a for i in x["items"]] == [2, 1]
    assert (y.flag, y.name, y.payload_visibility, y.seen) == (None, None, "odd", [])
    folded = {r.g: r for r in merge_values(spark.createDataFrame(rows, schema), ["g"], "ord", variant="capture").collect()}["x"]
    assert folded.seen == ["p", "q"] and folded.http_request_body_len == 7


LOGIN = "session_id string, capture_id string, start_time double, end_time double, src_ip string, dst_ip string, dst_port int, proto string, service string, conn_state string, payload_visibility string, auth_indicators struct<auth_protocol:string,session_auth_attempt_count:int,failed_login_count:int,username_field_seen:boolean,unique_usernames_seen:int,auth_status_codes:array<string>,ftp_response_codes:array<string>,http_login_paths:array<string>>"


def test_login_record_has_its_parts(spark):
    make = lambda failed: spark.createDataFrame([(f"s{i}", "c", 10.0 * i, 10.0 * i + 1, "10.0.0.1", "10.0.0.2", 21, "tcp", "ftp", "SF", "metadata_only", ("ftp", 1, failed, True, 2, ["401", "401"], ["530"], ["/login"])) for i in range(5)], LOGIN)
    row = group_records.login_records(make(1)).first()
    assert (row.attempt_count, row.failed_login_count, row.tier, row.inter_attempt_intervals.median, row.failure_burst.failure_rate, row.time_span) == (5, 5, "high", 10.0, 1.0, 41.0)
    assert row.status_code_summary == {"401": 10} and row.ftp_response_codes == ["530"] and row.http_login_paths == ["/login"] and row.payload_visibility == "metadata_only" and row.auth_indicators.repeated_login_attempts and not row.auth_indicators.weak_evidence
    weak = group_records.login_records(make(0)).first()
    assert weak.tier == "weak" and weak.weak_evidence_reason and weak.evidence_tier == "weak_auth_evidence"
    assert {r.session_id for r in group_records.login_members(make(1), group_records.login_records(make(1))).collect()} == {f"s{i}" for i in range(5)}


def test_scan_record_hints_at_probes(spark):
    schema = "session_id long, capture_id string, src_ip string, dst_ip string, dst_port int, proto string, conn_state string, start_time double, end_time double, vuln_scan_indicators struct<cve_probe_hint:boolean,matched_keywords:array<string>>, http_hosts array<string>"
    make = lambda words: spark.createDataFrame([(i, "c", "a", "b", 1000 + i, "tcp", "S0", 0.1 * i, 0.1 * i + 0.05, (False, words), [f"h{i % 3}"]) for i in range(10)], schema)
    row = group_records.scan_records(groups.scan_episodes(make([]))).first()
    assert (row.probe_count, row.inter_arrival_summary["count"], row.candidate_hint, row.dst_ports_sample[0], row.end_time, row.http_hosts) == (10, 9, "TA43_01", 1000, pytest.approx(0.95), ["h0", "h1", "h2"])
    assert row.scan_duration > 0 and row.probe_rate > 0
    assert group_records.scan_records(groups.scan_episodes(make(["nikto"]))).first().candidate_hint == "TA43_02"
    assert group_records.scan_members(groups.scan_episodes(make([]))).count() == 10


def test_scores_from_rows(spark):
    cases = {
        "exploit": [{"suspicious_payload_snippets": ["cmd=whoami"], "exploit_indicators": {"command_injection": True}}],
        "beacon": [{"record_type": "c2_callback_group", "payload_visibility": "encrypted_tls", "dst_port": 4430, "c2_indicators": {"periodic_connections": True, "fixed_remote_endpoint": True}}],
        "miner": [{"http_uris_sample": ["/miner/ping?id=abcd1234&hashrate=600000"], "http_user_agents": ["ethminer/0.19.0"], "http_content_types": ["application/json"]}],
        "auth": [{"src_ip": "10.0.0.5", "dst_ip": "10.0.0.9", "dst_port": 3306, "resp_pkts": 0, "resp_bytes": 0, "same_src_same_dst_port_count": 24, "c2_indicators": {"periodic_connections": True}} for _ in range(24)],
        "sensitive": [{"http_methods": ["HEAD"], "http_uris_sample": ["/App_Data/db.mdb"], "http_status_codes": [502]}],
        "post": [{"http_methods": ["POST"], "suspicious_payload_snippets": ["POST /search?q=;id"], "exploit_indicators": {"command_injection": True}, "implant_indicators": {"payload_delivery_hint": True}}],
        "encoded": [{"suspicious_payload_snippets": ["base64 AAAABBBBCCCCDDDDEEEEFFFFGGGGHHHH"]}],
        "update": [{"http_hosts": ["cdn.steamcontent.com"], "http_uris_sample": ["/depot/123/chunk/abcdef"], "http_user_agents": ["Valve/Steam HTTP Client"], "suspicious_payload_snippets": ["binary chunk data"]}],
        "shell": [{"http_uris_sample": ["/shell.php?cmd=whoami"], "suspicious_http_parameters": ["cmd=whoami"], "exploit_indicators": {"command_injection": True}}],
        "placed": [{"http_multipart_present": True, "http_upload_hints": ["/admin/upload filename=shell.php"], "implant_indicators": {"webshell_filename": True}}],
        "weak": [{"http_methods": ["POST"], "http_uris_sample": ["/chuli.php"]}],
    }
    lines = [json.dumps({"capture_id": name, "record_type": "session"} | r) for name, rows in cases.items() for r in rows]
    got = {r.capture_id: r for r in evidence.scored_captures(spark.read.json(spark.sparkContext.parallelize(lines))).collect()}
    exploit, beacon, miner, auth, sensitive, post, encoded, update, shell, placed, weak = (got[n] for n in cases)
    assert exploit.score_TA01_02 > exploit.score_TN01_01
    assert beacon.score_TA11_02 > beacon.score_TN01_01
    assert miner.score_TA11_02 > miner.score_TN01_01
    assert auth.score_TA01_01 > auth.score_TA11_02
    assert sensitive.score_TA43_02 > sensitive.score_TN01_01
    assert post.score_TA01_02 > post.score_TA03_01
    assert encoded.score_TN01_01 >= encoded.score_TA01_02
    assert update.score_TN01_01 > update.score_TA01_02 and any("download/chunk" in x.reason for x in update.counter_evidence if x.code == "TA01_02")
    assert shell.score_TA11_01 > shell.score_TA01_02
    assert placed.score_TA03_01 > placed.score_TA01_02
    assert "generic_php_post_weak_implant_evidence" in weak.flag_names and weak.score_TA03_01 < 1.0


def test_suspicion_adds_all_rules(spark):
    schema = "capture_id string, session_id string, record_type string, same_src_unique_dst_ips int, failed_login_count int, regularity_score double, orig_pkts int"
    rows = [("c", "a", "session", 20, 3, None, 1), ("c", "b", "session", 1, 0, 0.7, 0), ("c", "d", "scan_group", None, None, None, 40), ("c", "e", "session", 0, 0, 0.1, 2)]
    got = {r.session_id: (r.suspicion, r.reasons) for r in evidence.suspicion_scores(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": (106, ["scan_high_fanout", "auth_failures"]), "b": (50, ["beacon_or_c2"]), "d": (70, ["scan_high_fanout"]), "e": (2, ["benign_context"])}


def test_no_secret_hides_behind_an_encoded_key(spark):
    df = spark.createDataFrame([("/login?pass%77ord=hunter2&x=1",), ("a%3Fpassword%3Dhunter2",), (None,)], "uri string")
    assert [r.uri for r in logs.redact_log_columns(df).collect()] == ["/login?password=[REDACTED]&x=1", "a?password=[REDACTED]", None]
    kept = df.select(text.redact_sensitive_text(F.col("uri"), 220, decoded=True).alias("t")).first().t
    assert kept == "/login?pass%77ord=hunter2&x=1"


def test_model_answers_in_their_own_form(spark):
    good = {"record_id": "r1", "stage_code": "TA11", "technique_guess": "TA11_02", "confidence": "high", "reason": "x"}
    answers = {
        "plain": good, "no stage": {k: v for k, v in good.items() if k != "stage_code"}, "no technique": good | {"technique_guess": None}, "legacy": {"record_id": "r1", "predicted_code": "ta01_01", "confidence": 0.4, "reason": " a  b "},
        "apart": good | {"technique_guess": "TA01_01"}, "no reason": good | {"reason": " "}, "unknown": good | {"technique_guess": "XX"}, "stage": good | {"stage_code": "??"}, "sure": good | {"confidence": 2}, "other": good | {"record_id": "r2"}, "nested": good | {"meta": {}},
    }
    named = {n: json.dumps(a | ({"record_id": n} if a["record_id"] == "r1" else {})) for n, a in answers.items()} | {"think": "<THINK>{\"a\": 1}</Think>" + json.dumps(good | {"record_id": "think"}), "none": None}
    got = {r.record_id: r for r in predictions.parse_predictions(spark.createDataFrame(list(named.items()), "record_id string, response string")).collect()}
    assert (got["plain"].stage, got["plain"].technique, got["plain"].confidence, got["plain"].consistent, got["plain"].error) == ("TA11", "TA11_02", 0.85, True, None)
    assert got["no stage"].stage == "TA11" and got["think"].technique == "TA11_02" and (got["no technique"].technique, got["no technique"].consistent, got["no technique"].error) == (None, True, None)
    assert (got["legacy"].technique, got["legacy"].stage, got["legacy"].confidence, got["legacy"].reason) == ("TA01_01", "TA01", 0.4, "a b") and got["apart"].consistent is False
    assert {n: got[n].error for n in ("no reason", "unknown", "stage", "sure", "other", "nested", "none")} == {"no reason": "no_reason", "unknown": "unknown_code", "stage": "bad_stage", "sure": "bad_confidence", "other": "wrong_id", "nested": "many_objects", "none": "no_object"}


def test_fields_of_a_prediction_win(spark):
    records = spark.createDataFrame([("r1", "c", 9.0, "ip1"), ("r2", "c", 8.0, "ip2")], "record_id string, capture_id string, start_time double, src_ip string")
    asked = spark.createDataFrame([("r1", "c", 5.0, ""), ("r2", None, None, None), ("new", "c", None, "own.pcap"), ("gone", "z", None, None)], "record_id string, capture_id string, start_time double, file_name string")
    got = {r.record_id: tuple(r) for r in predictions.attach_context(asked, records, spark.createDataFrame([("c", "c.pcap")], "capture_id string, file_name string")).select("record_id", "capture_id", "start_time", "src_ip", "context", "file_name").collect()}
    assert got == {"r1": ("r1", "c", 5.0, "ip1", "record", "c.pcap"), "r2": ("r2", "c", 8.0, "ip2", "record", "c.pcap"), "new": ("new", "c", 9.0, "ip1", "capture", "own.pcap"), "gone": ("gone", "z", None, None, "none", None)}


def test_query_rows_of_groups_and_chains(spark):
    cases = {
        "vuln": dict(http_uris_sample=[f"/p{i}" for i in range(4)] + ["/phpmyadmin"], http_status_codes=["404"] * 5, http_user_agents=["Nikto/2.1"], vuln_scan_indicators={"cve_probe_hint": False}),
        "chain": dict(exploit_indicators={"command_injection": True}, implant_indicators={"upload": True}, backdoor_access_indicators={"shell": True}),
        "auth": dict(record_type="auth_attempt_group", auth_protocol="ftp", failed_login_count=5, attempt_rate=0.5),
        "quiet": dict(record_type="session", proto="tcp", orig_pkts=1),
        "whole": dict(record_type="pcap", top_rule_candidates=[{"technique": "TA43_01"}, {"technique": "TA43_02"}]),
    }
    lines = [json.dumps({"record_id": n, **r}) for n, r in cases.items()]
    got = {r.record_id: r for r in query_rules.query_rows(spark.read.json(spark.sparkContext.parallelize(lines)), {"TA43_01": ("port_scan", "fanout")}).collect()}
    vuln, chain, auth, quiet, whole = (got[n] for n in cases)
    assert {"uri_fanout=positive", "http_404_rate=positive", "scanner_user_agent=positive", "cve_or_probe_path=positive"} <= set(vuln.triggers)
    assert vuln.targeted_docs[:2] == ["boundary_ta43_01_vs_ta43_02", "observable_vulnerability_scan_indicators"]
    assert "ta01_02_vs_ta03_01_vs_ta11_01" in chain.confusion_groups and {"observable_exploit_upload_access_sequence", "observable_exploit_indicator_mapping", "observable_file_upload_and_implant_hints", "observable_backdoor_access_vs_callback", "competition_backdoor_implant_access_callback_boundary"} <= set(chain.targeted_docs)
    assert auth.matched_rules[0] == "auth_attempt_group:TA01_01_boundary" and {"ftp", "5", "failed_login_count"} <= set(auth.terms) and "auth_timing=positive" in auth.triggers and not auth.low_signal
    assert quiet.low_signal and quiet.matched_rules == ["low_volume_no_behavior_pattern:TN01_01"] and quiet.query.startswith("official competition code session-level classification session tcp orig_pkts=1")
    assert whole.triggers[0] == "top_rule_candidates=positive" and whole.targeted_docs[0] == "boundary_ta43_01_vs_ta43_02" and {"whole PCAP", "port_scan", "fanout"} <= set(whole.terms)
    assert len(set(map(str.lower, whole.terms))) == len(whole.terms)


def test_rule_prediction_falls_back_to_the_best_score(spark):
    rows = spark.createDataFrame([("a", None, 3.0, 4.0, 4.0), ("b", "ta43_01", 9.0, 2.0, 4.0), ("c", "??", 5.0, 5.0, 1.0)], "record_id string, primary string, score_TA43_01 double, score_TN01_01 double, score_TA11_02 double").withColumns({"score": F.lit(9.0), "margin": F.lit(0.0)})
    got = {r.record_id: (r.technique, r.confidence) for r in predictions.rule_direct_prediction(rows).collect()}
    assert got == {"a": ("TA11_02", 0.78), "b": ("TA43_01", 0.81), "c": ("TA43_01", 0.78)}


def test_capture_names_are_ours():
    assert len(capture.CONFLICTS) == 6 and set(evidence.INDICATORS) == set(query_rules.ABOUT)


def test_phrases_in_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("text is not null").selectExpr("doc_id AS chunk_id", "lower(text) AS blob")
    phrases = [r.p.lower() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").selectExpr("concat_ws(' ', slice(split(text, ' '), 2, 3)) AS p").collect()]
    got = {(r.term, r.chunk_id) for r in retrieval.phrase_matches(spark.createDataFrame([(p,) for p in set(phrases)], "term string"), docs).collect()}
    assert got == {(p, r.chunk_id) for r in docs.collect() for p in set(phrases) if p in r.blob}


def test_addresses_of_both_kinds(spark):
    import ipaddress

    given = [
        "::1", "::", "::2", "fe80::1%eth0", "fe80::1", "fec0::1", "fc00::1", "fdff::1", "2001:db8::5", "2001:db9::5", "2001:1::1", "2001:1::3", "2001:3::9", "2001:20::1", "2001:2f:ffff::1", "2001:40::1", "2001:200::1", "2002:a00:1::", "64:ff9b::8.8.8.8", "64:ff9b:1::1",
        "100::1", "100:0:0:1::1", "2a00:1450:4001:81b::200e", "2A00:1450:4001:81B::200E", "::ffff:10.0.0.1", "::ffff:8.8.8.8", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1::2::3", ":::", ":", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "12345::", "g::1", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:1.2.3.256",
        "", "10.0.0.1", "8.8.8.8", "192.0.0.9", "192.0.0.8", "300.1.1.1", "x", None,
    ]

    def private(ip):
        try:
            a = ipaddress.ip_address(ip)
        except ValueError:
            return None
        nets = [ipaddress.ip_network(n) for n in ("::1", "::", "::ffff:0:0/96", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32", "2002::/16", "fc00::/7", "fe80::/10")]
        public = [ipaddress.ip_network(n) for n in ("2001:1::1", "2001:1::2", "2001:3::/32", "2001:4:112::/48", "2001:20::/28", "2001:30::/28")]
        return a.is_private if a.version == 4 else any(a in n for n in nets) and not any(a in n for n in public)

    from tracewright.functions import values

    got = [r.p for r in spark.createDataFrame([(i, ip) for i, ip in enumerate(given)], "i int, ip string").select("i", values.is_private(F.col("ip")).alias("p")).orderBy("i").collect()]
    assert dict(zip(map(str, given), got, strict=True)) == {str(ip): private(ip) for ip in given}
    pair = spark.createDataFrame([("fd00::1", "2a00::1"), ("fd00::1", "fe80::2"), ("2a00::1", "8.8.8.8"), ("10.0.0.1", "2a00::1")], "a string, b string")
    assert [r[0] for r in pair.select(values.client_initiated_external(F.col("a"), F.col("b"))).collect()] == [True, False, False, True]


def test_labels_inside_arrays_and_maps_go(spark):
    schema = "id long, expected_stage string, rows array<struct<label:string,x:int,deep:struct<original_path:string,y:int>>>, m map<string,struct<truth:int,z:int>>, only array<struct<label:int>>, plain array<int>, words map<string,string>"
    df = spark.createDataFrame([(1, "s", [("a", 1, ("p", 2)), None], {"k": (1, 2), "label": (3, 4)}, [(1,)], [1], {"expected_x": "1", "y": "2"}), (2, None, None, None, None, None, None)], schema)
    out = logs.drop_label_columns(df)
    assert out.columns == ["id", "rows", "m", "plain", "words"]
    one, two = out.orderBy("id").collect()
    assert [r and r.asDict(True) for r in one["rows"]] == [{"x": 1, "deep": {"y": 2}}, None] and {k: v.asDict() for k, v in one.m.items()} == {"k": {"z": 2}} and one.words == {"y": "2"}
    assert (two["rows"], two.m, two.words) == (None, None, None)


def test_result_tables_of_any_header_and_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿pcap,编号,攻击阶段编号或正常流量编号\na.pcap,1,TA11\n\n,,\n".encode())
    (tmp_path / "b.csv").write_bytes("PCAP 文件名,源IP,阶段\r\nb.pcap,\"1.1,2\",正常\r\n".encode("gb18030"))
    (tmp_path / "c.csv").write_bytes(b"")
    rows = logs.read_result_table(spark, str(tmp_path)).collect()
    got = {(r.pcap, r.number, r.stage, r.src_ip) for r in rows}
    assert got == {("a.pcap", "1", "TA11", None), ("b.pcap", None, "正常", "1.1,2")}


def test_writers_of_marks_and_arrays(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", "g"), (2, None, "g")], "id long, t string, g string").repartition(3, "id")
    logs.write_tables(df, str(tmp_path / "csv"), "csv-bom", by="g")
    files = list((tmp_path / "csv" / "g=g").glob("*.csv"))
    assert files and all(f.read_bytes().startswith(b"\xef\xbb\xbfid,t") for f in files)
    logs.write_tables(df, str(tmp_path / "json"), "json-array")
    found = [x for f in (tmp_path / "json").glob("*.txt") for x in json.loads(f.read_text())]
    assert sorted(found, key=lambda x: x["id"]) == [{"id": 1, "t": "é", "g": "g"}, {"id": 2, "t": None, "g": "g"}]


def test_wide_headers_keep_all_cells(spark, tmp_path):
    names = [f"c{i}" for i in range(700)]
    (tmp_path / "x.log").write_text("#fields\t" + "\t".join(names) + "\n" + "\t".join(map(str, range(700))) + "\n")
    assert logs.read_tsv_log(spark, str(tmp_path), ("c0", "c650", "c699")).drop("file_path", "capture_id").first().asDict() == {"c0": "0", "c650": "650", "c699": "699"}


def test_budget_is_dealt_to_the_longest_fields(spark):
    schema = "record_id long, context string, a string, b string, c string, flags struct<x:boolean,y:boolean>, many array<int>, none array<string>"
    rows = [(1, None, "s" * 5, "m" * 100, "l" * 400, (False, True), list(range(8)), [])]
    df = spark.createDataFrame(rows, schema)
    fields = ("a", "b", "c", "flags", "many", "none", "lacking")
    shown = lambda n: df.select(predictions.dealt_text(predictions.listed_fields(df, fields), F.lit(n)).alias("t")).first().t
    assert shown(5000) == "a: sssss\nb: " + "m" * 100 + "\nc: " + "l" * 400 + '\nflags: {"y":true}\nmany: [0,1,2,3,4]...[3 more]'
    for n in (40, 90, 150, 250, 400, 600):
        assert len(shown(n)) <= n and (n < 100 or "sssss" in shown(n))
    assert shown(250).count("...[truncated]") == 2 and shown(300).count("...[truncated]") == 1 and len(shown(300)) == 300
    prompt = predictions.prompt_text(df, spark.createDataFrame([], "record_id long, rank int, pinned boolean, text string"), "Head", 300, body_limit=1000, least_body=50, fields=fields).first()
    assert prompt.shortened and not prompt.over and len(prompt.prompt) == 300 and "m" * 100 in prompt.prompt


def test_logins_of_all_logs(spark):
    from tracewright.operators import flags

    http = spark.createDataFrame([("c", "u1", 1, "/login?x", 401, False, ["username=bob"]), ("c", "u1", 2, "/a", 200, False, None), ("c", "u3", 1, "/a", 403, False, [])], "capture_id string, uid string, ord long, uri string, status int, auth_header boolean, parameters array<string>")
    ftp = spark.createDataFrame([("c", "u2", i, c, a, r) for i, (c, a, r) in enumerate([("USER", "bob", "331"), ("PASS", "x", "530"), ("USER", "eve", "331"), ("PASS", "x", "230")])], "capture_id string, uid string, ord long, command string, arg string, reply_code string")
    ssh = spark.createDataFrame([("c", "u4", "6", "F"), ("c", "u4", "-", "false"), ("c", "u4", "9", "T")], "capture_id string, uid string, auth_attempts string, auth_success string")
    got = {r.uid: r.auth_indicators for r in flags.login_indicators(http, ftp, ssh).collect()}
    assert set(got) == {"u1", "u2", "u3", "u4"}
    a, b, c, d = (got[f"u{i}"] for i in (1, 2, 3, 4))
    assert (a.auth_protocol, a.session_auth_attempt_count, a.failed_login_count, a.success_after_failures_hint, a.unique_usernames_seen, a.http_login_paths, a.auth_status_codes) == ("http", 1, 1, True, 1, ["/login?x"], ["401", "200"])
    assert (b.auth_protocol, b.session_auth_attempt_count, b.failed_login_count, b.success_after_failures_hint, b.unique_usernames_seen, b.ftp_response_codes, b.password_field_seen) == ("ftp", 2, 1, True, 2, ["331", "530", "230"], True)
    assert (c.auth_protocol, c.failed_login_count, c.auth_status_codes) == ("unknown", 0, [])
    assert (d.auth_protocol, d.session_auth_attempt_count, d.failed_login_count, d.ssh_auth_failure_hint, d.repeated_login_attempts, d.weak_evidence) == ("ssh", 9, 7, True, True, False)
    assert flags.login_indicators(http.limit(0), ftp.limit(0), ssh.limit(0)).count() == 0


def test_observations_hide_secrets_and_keep_commands(spark):
    from tracewright.operators import flags

    schema = "ord long, method string, host string, uri string, status string, agent string, cookie string, authorization string, body string, form_keys string, form_values string, content_length string"
    rows = [(1, "POST", "h", "/x?pass%77ord=hunter2", None, "a", "c=1", "Basic z", "q=xp_cmdshell 'whoami'&password=do-not-retain&token=secret", "cmd|password|page|q", "ls|do-not-retain|2|union select a from b", "12"), (2, None, None, None, None, None, None, None, None, None, None, None)]
    out = flags.http_observation(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 1 and not any(secret in str(out[0]) for secret in ("do-not-retain", "secret ", "hunter2", "c=1", "Basic z"))
    row = out[0]
    assert row.suspicious_http_parameters == ["cmd=ls", "password=[REDACTED]", "q=union select a from b"] and row.cookie_present and row.auth_header_present and row.content_length == 12
    assert any("xp_cmdshell" in s and "[REDACTED]" in s for s in row.body_snippets_sanitized) and {"xp_cmdshell", "sql_injection"} <= set(row.matched_keywords)
    files = spark.createDataFrame([("c", "u", 1, "a.exe", "x", "T"), ("c", "u", 2, "b?token=z", "y", "F"), ("c", "u", 3, "a.exe", None, "T")], "capture_id string, uid string, ord long, filename string, mime_type string, is_orig string")
    summary = flags.file_summary(files).first()
    assert summary.filename_sample == ["a.exe", "b?token=[REDACTED]"] and summary.mime_type_sample == ["x", "y"] and summary.direction_hint == ["originator_to_responder", "responder_to_originator"] and summary.total_files == 3


def test_scopes_overlap_and_failures_have_classes(spark):
    schema = "mode string, record_type string, label_confidence string, confidence_level string, truth string, guess string, error string"
    rows = [("rag", "flow_only", "high", None, "A", "A", None), ("rag", "session", "high", "", "A", None, "no JSON object found"), ("rag", "session", "medium", None, "B", None, "invalid technique code `x`"), ("rag", "session", None, "synthetic_controlled", "B", None, None), ("no_rag", "session", "low", None, "B", "A", None)]
    got = {(r.mode, r.scope): (r.total, r.correct, r.accuracy, r.json_parse_failure_rate, r.illegal_code_rate, r.other_failure_rate) for r in evaluation.answer_metrics(spark.createDataFrame(rows, schema)).collect()}
    assert got["rag", "coverage all"] == (4, 1, 0.25, 0.25, 0.25, 0.25) and got["rag", "strict external"] == (2, 1, 0.5, 0.5, 0.0, 0.0)
    assert got["rag", "external_high_flow"][:2] == (1, 1) and got["rag", "pcap/session-derived"][0] == 3 and got["rag", "synthetic_controlled"][5] == 1.0 and got["no_rag", "external_low"][:3] == (1, 0, 0.0)
    split = {(r.mode, r.scope, r.technique): r.total for r in evaluation.answer_metrics(spark.createDataFrame(rows, schema), by_class=True).collect()}
    assert split["rag", "coverage all", "B"] == 2


def test_packets_give_durations_and_services(spark):
    from tracewright.operators import sessions

    schema = "capture_id string, stream int, ord long, ts double, src_ip string, src_port int, dst_ip string, dst_port int, proto string, bytes long, syn boolean, ack boolean, protocol string"
    rows = [("c", 1, 1, 1.0, "a", 1, "b", 80, "tcp", 10, True, False, "TCP"), ("c", 1, 2, 3.25, "a", 1, "b", 80, "tcp", 10, False, False, "HTTP"), ("c", 2, 3, 5.0, "a", 2, "b", 53, "udp", 10, True, False, "DNS"), ("c", 3, 4, 6.0, "a", 3, "b", 80, "tcp", 1, True, True, "TCP")]
    got = {r.src_port: (r.duration, r.service, r.conn_state) for r in sessions.sessions_from_packets(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: (2.25, "http", "S0"), 2: (0.0, "dns", None), 3: (0.0, None, None)}
    methods = spark.createDataFrame([(True, "five_tuple"), (True, "none"), (False, "stream"), (False, "five_tuple"), (False, "none")], "logged boolean, method string")
    assert [tuple(r[0]) for r in methods.select(sessions.evidence_mapping(F.col("logged"), F.col("method"))).collect()] == [("zeek_uid+bidirectional_five_tuple", "high"), ("zeek_uid", "high"), ("tcp_stream", "high"), ("bidirectional_five_tuple", "medium"), ("none", "not_applicable")]


def test_labels_refer_to_codes(spark):
    labels = ["flow=From-Botnet-V42-TCP-CC1", "flow=From-Normal-V42", "flow=Background-UDP", "other", None]
    got = [tuple(r[0]) for r in spark.createDataFrame([(x,) for x in labels], "label string").select(curation.label_reference(F.col("label"))).collect()]
    assert got == [("TA11_02", "ctu_botnet_like", "high"), ("TN01_01", "ctu_normal_like", "medium"), ("TN01_01", "ctu_background_like", "low"), (None, "unknown", "unknown"), (None, "unknown", "unmatched")]
    flows = spark.createDataFrame([("a", "b", 80, "tcp", labels[0])] * 4 + [("a", "b", 80, "tcp", "flow=From-Botnet-V42-TCP-CC2")] * 2 + [("a", "b", 80, "tcp", labels[1])] * 9 + [("a", "c", 80, "tcp", labels[1])] * 9, "src_ip string, dst_ip string, dst_port int, proto string, label string")
    ends = spark.createDataFrame([("a", "b", 80, "tcp", 5, 0.5, "high"), ("a", "c", 80, "tcp", 5, 0.5, "high"), ("a", "b", 81, "tcp", 5, 0.5, "weak")], "src_ip string, dst_ip string, dst_port int, proto string, connections int, score double, tier string")
    assert [(r.dst_ip, r.labels, r.primary_label) for r in curation.endpoint_label_join(ends, flows).collect()] == [("b", 6, labels[0])]


def test_verdicts_name_where_evidence_is_lost(spark):
    rows = [(layer, e, n, w) for e, counts in {"body": ((30, 25), (9, 3), (9, 0), (5, 0)), "http": ((30, 30), (9, 9), (9, 9), (5, 5)), "dns": ((30, 0), (9, 0), (9, 0), (5, 0)), "tls": ((30, 4), (9, 2), (0, 0), (5, 1)), "ftp": ((30, 20), (9, 1), (9, 1), (5, 1))}.items() for layer, (n, w) in zip(("raw", "cards", "records", "prompts"), counts, strict=True)]
    out = evaluation.retention_verdicts(spark.createDataFrame(rows, "layer string, evidence string, rows long, with_evidence long"), ("raw", "cards", "records", "prompts")).collect()
    assert {r.evidence: (r.verdict, r.lost_after) for r in out} == {"body": ("possible_loss", "cards"), "http": ("kept", None), "dns": ("absent", None), "tls": ("not_assessed", None), "ftp": ("sparse", None)}


def test_rules_bring_their_documents(spark):
    records = spark.createDataFrame([(1, ["A", "B"]), (2, ["C"]), (3, ["Z"])], "record_id long, candidates array<string>")
    rules = spark.createDataFrame([(0, ["B", "C"], ["d2", "d1"]), (1, ["A", "B"], ["d3", "d2"]), (2, ["C"], ["d4"])], "rule_id int, codes array<string>, docs array<string>")
    got = {r.record_id: r.docs for r in curation.boundary_documents(curation.boundary_rule_join(records, rules), rules).collect()}
    assert got == {1: ["d3", "d2", "d1"], 2: ["d2", "d1", "d4"]}
    sides = curation.missing_keys(records, spark.createDataFrame([(2,), (9,)], "record_id long")).collect()
    assert sorted((r.side, r.record_id) for r in sides) == [("records", 1), ("records", 3), ("updates", 9)]


def test_lists_say_how_many_more(spark):
    from tracewright.functions import values

    df = spark.createDataFrame([(["x" * 200, "y"] + [str(i) for i in range(12)],), (["short"],), (None,)], "v array<string>")
    long, short, none = [r[0] for r in df.select(values.trim_list(F.col("v"), 600)).collect()]
    assert len(long) == 13 and long[-1] == "...[2 more]" and len(long[0]) == 80 and long[0].endswith("...[truncated]") and long[1] == "y" and short == ["short"] and none is None
