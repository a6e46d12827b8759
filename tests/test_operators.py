"""Exact numbers on small rows."""

import re
from urllib.parse import unquote_plus

from pyspark.sql import functions as F

from tests.conftest import DATA
from tracewright.functions import text, values
from tracewright.operators import capture, context, evidence, groups, predictions, retrieval
from tracewright.sources import logs

FLOW = "session_id long, capture_id string, src_ip string, dst_ip string, dst_port int, proto string, conn_state string, start_time double, duration double, orig_bytes long, resp_bytes long"


def flows(spark, n, step, port=lambda i: 21, state="SF", dst="198.51.100.8", size=(100, 100)):
    return spark.createDataFrame([(i, "c", "10.0.0.1", dst, port(i), "tcp", state, float(step * i), 0.1, *size) for i in range(n)], FLOW)


def test_login_group_is_high_with_five_failures(spark):
    row = groups.auth_groups(flows(spark, 5, 10, state="REJ")).first()
    assert (row.attempts, row.failures, row.failure_rate, row.tier) == (5, 5, 1.0, "high")
    assert groups.auth_groups(flows(spark, 5, 10)).first().tier == "weak"
    assert groups.auth_groups(flows(spark, 5, 301)).count() == 0


def test_callback_group_is_periodic(spark):
    row = groups.callback_groups(flows(spark, 10, 30, lambda i: 5678, size=(180, 4000))).first()
    assert (row.connections, row.interval_mean, row.interval_std, row.regularity_score, row.tier) == (10, 30.0, 0.0, 1.0, "high")
    assert groups.callback_groups(flows(spark, 10, 0.001, lambda i: 5678, size=(180, 4000))).first().tier != "high"


def test_scan_group_counts_probes_and_anchors(spark):
    rows = flows(spark, 10, 0.1, lambda i: 1000 + i, "S0").withColumns({"same_src_unique_dst_ports": F.lit(10), "same_src_failed_conn_rate": F.lit(1.0)})
    assert groups.scan_groups(groups.scan_episodes(groups.scan_candidates(rows))).first().probe_count == 10
    far = flows(spark, 30, 100, lambda i: i, "S0").withColumns({"same_src_unique_dst_ports": F.lit(30), "same_src_failed_conn_rate": F.lit(1.0)})
    starts = [r.episode_start for r in groups.scan_episodes(far, 300, 2, 2).select("episode_start").distinct().orderBy("episode_start").collect()]
    assert starts == [0.0, 400.0, 800.0, 1200.0, 1600.0, 2000.0, 2400.0, 2800.0]


def test_secrets_do_not_survive(spark):
    raw = "body=xp_cmdshell%20'whoami'&password=do-not-retain&token=secret eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM"
    df = spark.createDataFrame([(raw,), (None,), ("%zz" + "x" * 999,)], "t string")
    out = [r[0] for r in df.select(text.redact_sensitive_text(text.decode_visible_text(F.col("t")), 220)).collect()]
    assert "xp_cmdshell" in out[0] and "do-not-retain" not in out[0] and "secret" not in out[0] and "[REDACTED_JWT]" in out[0]
    assert out[1] == "" and len(out[2]) == 220
    assert "do-not-retain" not in str(df.select(text.suspicious_contexts(F.col("t"))).collect())


def plain_visible(t):
    shown = "".join(c if " " <= c <= "~" or "\u4e00" <= c <= "\u9fff" else " " for c in unquote_plus(t or ""))
    return " ".join(shown.split())


def plain_windows(t, limit):
    t = plain_visible(t)
    hits = [(m.start(), m.end()) for p in text.SIGNATURES.values() for m in re.finditer(p, t)]
    hits += [(0, min(220, len(t)))] if any(re.search(text.LISTS[n], t) for n in ("scanner", "probe_path", "web_shell", "upload")) else []
    out = []
    for a, b in sorted(hits)[: 2 * limit]:
        w = re.sub(text.JWT, "[REDACTED_JWT]", re.sub(text.SECRET, r"\1\2[REDACTED]", plain_visible(t[max(a - 80, 0) : b + 100])))
        w = w[:206] + "...[truncated]" if len(w) > 220 else w
        out += [w] if w and w not in out else []
    return out[:limit]


def test_visible_text_against_plain_python(spark):
    odd = [None, "", " %zz %41%4 100% %e4%bd%a0%e5 a+b%2Bc", "%00\x07 é 你好 😀", "x" * 90 + "cmd.exe /c whoami; /bin/sh " + "y" * 200 + " union select 1 from t token=abc&x=%2527", "nikto " + "z" * 300, "powershell " * 30]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").unionByName(spark.read.parquet(f"{DATA}/pages.parquet").selectExpr("concat(url, ' ', html, CASE page_id % 3 WHEN 0 THEN ' ; cat /etc/passwd <script>' ELSE '' END) AS t"))
    for r in rows.select("t", text.decode_visible_text(F.col("t")).alias("seen"), text.suspicious_contexts(F.col("t"), 3).alias("near")).collect():
        assert r.seen == plain_visible(r.t) and r.near == plain_windows(r.t, 3), r.t


def test_times_and_addresses(spark):
    df = spark.createDataFrame([("1312967328.170871",), ("1312967329.0",), ("5",), ("5.25",), (" a  b ",), (None,)], "t string")
    shanghai = [r[0] for r in df.select(values.format_epoch(F.col("t"))).collect()]
    assert shanghai == ["2011-08-10 17:08:48.170871", "2011-08-10 17:08:49", "5", "5.25", "a b", ""]
    ips = spark.createDataFrame([("10.1.1.1", "8.8.8.8"), ("10.1.1.1", "203.0.113.9"), ("8.8.8.8", "1.1.1.1"), ("x", "8.8.8.8"), (None, None)], "a string, b string")
    assert [r[0] for r in ips.select(values.client_initiated_external(F.col("a"), F.col("b"))).collect()] == [True, False, False, False, False]


def scored(spark, **got):
    row = spark.range(1).select(*(F.lit(v).alias(n) for n, v in (got or {"exploit": 0}).items()))
    return capture.candidate_scores(row).first()


def test_scores_prefer_the_right_technique(spark):
    assert scored(spark).primary == "TN01_01"
    assert scored(spark, exploit=1, payload=1).primary == "TA01_02"
    assert scored(spark, callback=10, beacon=True).primary == "TA11_02"
    assert scored(spark, auth_rows=24, repeated_auth=True, callback=5).primary == "TA01_01"
    assert scored(spark, sensitive_path=True).primary == "TA43_02"
    assert scored(spark, miner=True).primary == "TA11_02"
    assert scored(spark, payload=1).primary == "TN01_01"
    row = scored(spark, exploit=1, payload=1, implant=1)
    assert row.score_TA01_02 > row.score_TA03_01
    row = scored(spark, exploit=1, implant=1, placement=True)
    assert row.score_TA03_01 > row.score_TA01_02


def test_scores_margins_and_conflicts(spark):
    """Numbers worked out by hand from the weights."""
    row = scored(spark, web_shell=True, command=True)
    assert (row.primary, row.best, row.margin, row.strength, row.score_TN01_01) == ("TA11_01", 5.0, 5.0, "medium", 0.0)
    row = scored(spark, callback=3)
    assert (row.primary, row.margin, row.strength) == ("TA11_02", 2.6, "medium")
    row = scored(spark, payload=2)
    assert (row.score_TN01_01, row.score_TA01_02, row.margin, row.flag_names) == (0.8, 0.7, 0.1, ["low_score_margin", "weak_evidence"])
    row = scored(spark, scan_rows=1, sensitive_path=True)
    assert (row.primary, row.margin, row.score_TA43_01) == ("TA43_02", 2.2, 2.3)
    row = scored(spark, php_post=True)
    assert row.score_TA03_01 == 0.2 and "generic_php_post_weak_implant_evidence" in row.flag_names and [x.code for x in row.weak_evidence] == ["TA03_01"]
    row = scored(spark, benign=True)
    assert (row.primary, row.score_TN01_01) == ("TN01_01", 5.7) and any("download/chunk" in x.reason for x in row.counter_evidence)
    row = scored(spark, login_attempts=5)
    assert (row.primary, row.best, row.rule_evidence) == ("TA01_01", 3.2, ["login attempts or failures"])
    assert [(x.technique, x.score) for x in row.top] == [("TA01_01", 3.2), ("TA43_01", 0.0), ("TA43_02", 0.0)]
    assert scored(spark, exploit=None, miner=None).primary == "TN01_01"


def test_confidence_of_rule_predictions(spark):
    rows = [(1, "TA01_02", 7.0, 2.5, "strong", [" a  b ", "c", "d"]), (2, "TN01_01", 2.2, 1.0, "weak", []), (3, "TA11_02", 10.0, 10.0, "strong", ["x"]), (4, None, None, None, None, None)]
    table = spark.createDataFrame(rows, "record_id long, primary string, score double, margin double, strength string, rule_evidence array<string>")
    out = {r.record_id: (r.technique, r.stage, r.confidence, r.reason) for r in predictions.rule_direct_prediction(table).collect()}
    assert out[1] == ("TA01_02", "TA01", 0.82, "a b; c") and out[3] == ("TA11_02", "TA11", 0.9, "x")
    assert out[2] == ("TN01_01", "TN01", 0.64, "Rule scores favour TN01_01.") and out[4][:3] == ("TN01_01", "TN01", 0.72)


def test_repeated_logins(spark):
    def rows(n, **kinds):
        made = flows(spark, n, 1, port=lambda i: 3306)
        return capture.repeated_auth_service(made.withColumns({c: F.lit(v) for c, v in kinds.items()})).first()

    assert rows(24).repeated and not rows(9).repeated
    assert rows(10).busiest == 10 and rows(10).repeated
    spread = flows(spark, 12, 1, port=lambda i: 21).withColumn("dst_ip", F.concat(F.lit("198.51.100."), (F.col("session_id") % 4).cast("string")))
    assert not capture.repeated_auth_service(spread).first().repeated
    assert capture.repeated_auth_service(spread.withColumn("resp_bytes", F.when(F.col("session_id") > 6, F.col("resp_bytes")))).first().repeated


def test_pairs_feed_their_sessions(spark):
    rows = [(i, "c", "a", "b", 80, f"/p{i}", 404, "http") for i in range(8)] + [(8, "c", "a", "b", 443, "/x/CMD.php", 200, "unknown"), (9, "c", "a", "b", 443, "/c99", 200, None), (10, "c", "z", "b", 80, None, None, None)]
    sessions = spark.createDataFrame(rows, "session_id long, capture_id string, src_ip string, dst_ip string, dst_port int, uri_path string, status int, auth_protocol string")
    out = {r.session_id: r for r in context.with_pair_flags(sessions, context.pair_context(sessions)).collect()}
    assert all(out[i].high_uri_fanout and out[i].high_404_rate and out[i].repeated_backdoor_endpoint_access for i in range(10))
    assert out[0].repeated_login_attempts and not out[8].repeated_login_attempts and not out[10].high_uri_fanout


def test_one_json_object(spark):
    rows = [(1, '<think>{"x":1}</think>{"record_id":"1","technique_guess":"TA01_01","confidence":"high","reason":"r"}'), (2, "none"), (3, '{"a":{}} {"b":1}'), (4, '{"record_id":"5","technique":"TA01_01"}'), (5, None)]
    out = {r.record_id: (r.technique, r.confidence, r.error) for r in predictions.parse_predictions(spark.createDataFrame(rows, "record_id long, response string")).collect()}
    assert out[1] == ("TA01_01", 0.85, None)
    assert [out[i][2] for i in (2, 3, 4, 5)] == ["no_object", "many_objects", "wrong_id", "no_object"]


def plain_chunks(text):
    """Greedy packing of headings and paragraphs, by the rule."""
    words = lambda t: len(re.findall(r"[A-Za-z0-9_.:/+-]+|[\u4e00-\u9fff]", t))
    units, block = [], []
    for line in [*(text or "").splitlines(), ""]:
        if line.startswith("#") or not line.strip():
            units += ["\n".join(block).strip()] if block else []
            units += [line.strip()] if line.strip() else []
            block = []
        else:
            block.append(line)
    out, now = [], []
    for unit in units:
        if now and words("\n\n".join([*now, unit])) > 180:
            out.append(now)
            now = []
        now = [*now, unit]
        if words("\n\n".join(now)) >= 80:
            out.append(now)
            now = []
    if now and out and words("\n\n".join([*out[-1], *now])) <= 220:
        out[-1] += now
    elif now:
        out.append(now)
    return ["\n\n".join(c) for c in out]


def test_chunks_follow_the_rule(spark):
    unit = lambda n: " ".join(f"w{i}" for i in range(n))
    texts = ["\n\n".join(["# Head", unit(30), unit(60), "## Next", unit(100), unit(400), unit(10)]), None, " \n ", "#only", unit(79) + "\n \n" + unit(110) + "\r\n#h\x1e" + unit(5), unit(90) + "\n\n" + unit(140)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text"))
    got = {}
    for r in retrieval.chunk_documents(rows).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    for r in rows.collect():
        assert got.get(r.doc_id, []) == plain_chunks(r.text), r.doc_id


def test_log_files(spark, tmp_path):
    folder = tmp_path / "captures" / "a" / "b" / "zeek"
    folder.mkdir(parents=True)
    (folder / "conn.log").write_text("#separator \\x09\n#fields\tts\tuid\tid.orig_h\tproto\n1.0\tC1\t10.0.0.1\ttcp\n2.0\tC2\n#close\n")
    rows = sorted(map(tuple, logs.read_tsv_log(spark, str(folder), ("uid", "id_orig_h", "proto", "history")).drop("file_path").collect()))
    assert rows == [("a__b", "C1", "10.0.0.1", "tcp", None), ("a__b", "C2", "", "", None)]
    (tmp_path / "x.json").write_text('{"a": 1}\n\nbad\n{"a": 2}\n')
    assert sorted(r.a for r in logs.read_json_log(spark, str(tmp_path / "x.json"), "a long").collect() if r.a) == [1, 2]
    (tmp_path / "l.csv").write_text("SrcAddr,Sport,DstAddr,Dport,Proto,Label\n1.1.1.1,5, 2.2.2.2 ,80,TCP,bot\n")
    assert tuple(logs.read_flow_labels(spark, str(tmp_path / "l.csv")).first()) == ("1.1.1.1", "5", "2.2.2.2", "80", "tcp", "bot")
    (tmp_path / "p.csv").write_text("frame,ip\n1,2\n")
    assert logs.read_packets(spark, str(tmp_path / "p.csv")).columns == ["frame", "ip"]
    logs.write_tables(spark.range(3).withColumn("g", F.lit("x")), str(tmp_path / "out"), by="g")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_label_columns_go_at_every_depth(spark):
    df = spark.range(1).select("id", F.lit(1).alias("truth"), F.struct(F.lit(1).alias("label"), F.lit(2).alias("x")).alias("s"))
    out = logs.drop_label_columns(df)
    assert out.columns == ["id", "s"] and out.schema["s"].dataType.names == ["x"]


def test_shards_are_disjoint_and_complete(spark):
    df = predictions.shard(spark.range(100).withColumnRenamed("id", "record_id"), 3)
    assert df.count() == 100 and {r.shard for r in df.select("shard").distinct().collect()} == {0, 1, 2}


def test_evidence_comes_from_all_rows_and_is_redacted(spark):
    rows = [("c", i, i, 50, "Same text") for i in range(60)] + [("c", 60, 60, 1, "GET /?password=hunter2"), ("c", 61, 61, 0, "GET /?password=other3"), ("c", 62, 62, 0, "Last")]
    scored = spark.createDataFrame(rows, "capture_id string, session_id long, start_time long, packets long, payload_text string").withColumns({c: F.lit(0) for c in ("orig_bytes", "resp_bytes")})
    got = evidence.payload_evidence(evidence.suspicion_scores(scored.withColumnRenamed("packets", "orig_pkts")), ("payload_text",)).orderBy("place").collect()
    assert [r.text for r in got] == ["Same text", "GET /?password=[REDACTED]", "Last"]


def test_weak_or_blocked_records_go_to_the_model(spark):
    flag = predictions.BLOCKING_FLAGS[0]
    rows = [(1, "strong", []), (2, "medium", []), (3, None, []), (4, "strong", [flag]), (5, "strong", ["other"]), (6, " Strong", None), (7, "strong", ["other", flag]), (8, "strong", ["other", "other"])]
    records = spark.createDataFrame(rows, "record_id long, strength string, flag_names array<string>").withColumns({"score": F.lit(9.0), "margin": F.lit(5.0), "primary": F.lit("TA43_01")})
    got = lambda df, **how: {r.record_id: r.reason for r in predictions.route_records(df, df.limit(0), **how).collect()}
    low, fine = "evidence_strength_below_threshold", "high_confidence_rule_candidate"
    assert got(records, max_flags=1) == {1: fine, 2: low, 3: low, 4: "blocking_conflict_flag", 5: fine, 6: fine, 7: "too_many_conflicts", 8: fine}
    assert set(got(records.withColumn("primary", F.lit("TN01_01")).withColumn("score", F.lit(1.0))).values()) == {"normal_rule_direct_disabled"}
    assert set(got(records.withColumn("primary", F.lit(" "))).values()) == {"missing_primary_rule_candidate"}
    assert set(got(records.withColumn("margin", F.lit(None).cast("double"))).values()) == {"margin_below_threshold"}


def test_index_holds_ids_and_labels(spark):
    chunks = spark.createDataFrame([("c1", "kb7", "Title", "cat", "word", ["port_scan"], ["reconnaissance"], "body")], "chunk_id string, doc_id string, title string, category string, keywords string, attack_type array<string>, attack_stage array<string>, text string")
    assert {r.token for r in retrieval.keyword_index(chunks).collect()} >= {"kb7", "port_scan", "reconnaissance", "title", "body"}
