"""Queries of session assembly, capture records, retrieval, predictions, evaluation and curation, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.text import LISTS
from ..operators import capture as P
from ..operators import context as C
from ..operators import curation as U
from ..operators import evaluation as M
from ..operators import evidence as E
from ..operators import predictions as R
from ..operators import retrieval as K
from ..operators import sessions as S
from ..operators.merges import merge_values
from ..sources import logs as L
from .session_queries import _SOURCE, BEACON, FAILED, SIGNAL, _signals
from .views import FLOW, chunks, duck, flow, pages, records

CODES = ", ".join(f"'{c}'" for c in V.TECHNIQUES)


def _conn(spark, d):
    return flow(spark, d).withColumn("uid", F.col("session_id").cast("string"))


def attach_app_logs(spark, d):
    rows = flow(spark, d)
    http = rows.where("k % 3 = 0").select("capture_id", F.col("session_id").cast("string").alias("uid")).unionByName(rows.where("k % 6 = 0").select("capture_id", F.col("session_id").cast("string").alias("uid")))
    dns = rows.where("k % 5 = 0").select("capture_id", F.col("session_id").cast("string").alias("uid"))
    return S.attach_app_logs(_conn(spark, d), {"http": http, "dns": dns}).select("session_id", "http_rows", "dns_rows")


def attach_files(spark, d):
    rows = flow(spark, d)
    files = rows.where("k % 4 = 0").select("capture_id", F.concat(F.lit("{"), F.col("session_id").cast("string"), F.lit(", "), F.col("session_id").cast("string"), F.lit(",x}")).alias("conn_uids"), F.when(F.col("k") % 8 == 0, "a.exe").otherwise("b.txt").alias("filename"))
    return S.attach_files(_conn(spark, d), files).select("session_id", "files", "suspicious_file")


def _packets(spark, d):
    back = F.col("session_id") % 2 == 1
    end = lambda a, b: F.when(back, F.col(a)).otherwise(F.col(b))
    return flow(spark, d).select(
        "capture_id", F.when(F.col("k") % 2 == 0, F.col("user_id")).alias("stream"), F.col("session_id").alias("ord"), F.col("session_id").cast("double").alias("ts"), end("dst_ip", "src_ip").alias("src_ip"),
        F.when(back, 80).otherwise(4000).alias("src_port"), end("src_ip", "dst_ip").alias("dst_ip"), F.when(back, 4000).otherwise(80).alias("dst_port"), "proto", F.col("orig_bytes").alias("bytes"),
        (F.col("k") % 3 == 0).alias("syn"), (F.col("k") % 10 == 0).alias("ack"), F.when(F.col("k") % 3 == 0, "TCP").when(F.col("k") % 3 == 1, "HTTP").otherwise("DNS").alias("protocol"),
    )


def sessions_from_packets(spark, d):
    return S.sessions_from_packets(_packets(spark, d))


def packet_fallback(spark, d):
    rows = flow(spark, d).where("capture_id <> 'cap3' AND capture_id <> 'cap5'").select("capture_id", F.col("session_id").cast("string").alias("key"), "src_ip", "dst_ip", "start_time")
    return S.packet_fallback(rows, _packets(spark, d)).groupBy("capture_id", "origin").agg(F.count("*").alias("sessions"))


def map_observations(spark, d):
    rows = flow(spark, d)
    key = F.concat_ws("|", "src_ip", "dst_ip")
    seen = rows.select(F.col("session_id").alias("observation"), "capture_id", F.when(F.col("k") % 2 == 0, F.col("user_id")).otherwise(-1).alias("stream"), F.when(F.col("k") % 5 != 1, key).otherwise("?").alias("key"))
    streams = rows.where("k % 3 = 0").select("capture_id", F.col("user_id").alias("stream"), "session_id", F.col("session_id").alias("ord"))
    return S.map_observations(seen, streams, rows.withColumn("key", key).withColumn("start_time", F.col("session_id"))).select("observation", "session_id", "method")


def payload_visibility(spark, d):
    rows = flow(spark, d).select("session_id", (F.col("dst_port") == 443).alias("tls"), (F.col("dst_port") == 22).alias("ssh"), (F.col("proto") == "udp").alias("quic"), (F.col("dst_port") == 80).alias("http"), (F.col("k") > 80).alias("meta"))
    return S.payload_visibility(rows).select("session_id", "payload_visibility", "encrypted_protocol", "observable_payload_available")


def protocol_summaries(spark, d):
    rows = flow(spark, d).select("capture_id", F.col("src_ip").alias("uid"), F.col("dst_port").cast("string").alias("name"), "conn_state", F.col("session_id").alias("ord"))
    out = S.protocol_summaries(rows, "name", "conn_state", 4)
    return out.select("capture_id", "uid", "count", "different", "codes", F.array_join("samples", ",").alias("samples"))


def _http(spark, d):
    return pages(spark, d).select("capture_id", F.col("src_ip").alias("uid"), "url", F.col("html").alias("body"), F.when(F.col("login"), 401).otherwise(F.col("status")).alias("status"), F.length("url").cast("long").alias("request_bytes"), F.length("html").cast("long").alias("response_bytes"), F.col("page_id").alias("ord"))


def http_rollup(spark, d):
    return S.http_flags(_http(spark, d))


def success_after_failure(spark, d):
    rows = flow(spark, d).select("capture_id", F.col("src_ip").alias("uid"), F.col("session_id").alias("ord"), F.col("session_id").alias("ts"), (~V.is_failed(F.col("conn_state"))).alias("ok"))
    return S.success_after_failure(rows)


def merge_observables(spark, d):
    rows = flow(spark, d).select("capture_id", "session_id", (F.col("k") > 95).alias("hit"), F.col("orig_bytes").alias("body_len"), F.col("duration").alias("longest"), F.array(F.col("dst_port").cast("string"), F.col("proto")).alias("seen"), F.col("src_ip").alias("first_source"))
    out = merge_values(rows, ["capture_id"], "session_id")
    return out.select("capture_id", "hit", "body_len", "longest", "first_source", F.array_join("seen", ",").alias("seen"))


def _suspects(spark, d):
    k = F.col("k")
    return C.source_context(flow(spark, d)).withColumns({
        "orig_pkts": k, "exploit_indicators": F.struct((k % 17 == 0).alias("command_injection"), F.array().cast("array<string>").alias("matched_keywords"), F.lit(True).alias("weak_evidence")),
        "c2_indicators": F.struct((k / 100).alias("beacon_score"), F.when(k % 29 == 0, 1).alias("count")), "failed_login_count": F.when(k % 19 == 0, k), "http_multipart_present": k % 23 == 0,
        "suspicious_payload_snippets": F.when(k % 11 == 0, F.array(F.concat(F.lit("Text "), (k % 9).cast("string")), F.lit("pass%77ord=x"), F.lit("-"))),
    })


def suspicion_rank(spark, d):
    return E.suspicion_rank(_suspects(spark, d)).select("capture_id", "session_id", "rank", "suspicion", F.array_join("reasons", ",").alias("reasons"), F.array_join("active_indicators", ",").alias("active"))


def payload_evidence(spark, d):
    return E.payload_evidence(E.suspicion_scores(_suspects(spark, d)), ("suspicious_payload_snippets", "event_type"), 5)


def repeated_auth_service(spark, d):
    return P.repeated_auth_service(flow(spark, d))


def _captures(spark, d):
    n = lambda test: F.count_if(F.expr(test))
    return flow(spark, d).groupBy("capture_id", F.col("src_ip").alias("source")).agg(
        F.countDistinct("dst_port").alias("port_fanout"), n("k > 97").alias("scan_rows"), F.round(F.avg(V.is_failed(F.col("conn_state")).cast("double")), 4).alias("failed_rate"), n("k = 77").alias("login_failures"), n("k BETWEEN 70 AND 76").alias("login_attempts"), n("k = 95").alias("vulnerability"),
        n("k = 94").alias("exploit"), n("k = 93").alias("payload"), n("k = 92").alias("implant"), n("k = 91").alias("backdoor"), n("dst_port = 22 AND k < 8").alias("auth_rows"), n("k = 89").alias("callback"),
        F.bool_or(F.col("k") == 88).alias("sensitive_path"), F.bool_or(F.col("k") == 87).alias("web_shell"), F.bool_or(F.col("k") == 86).alias("command"), F.bool_or(F.col("k") == 85).alias("placement"), F.bool_or(F.col("k") == 84).alias("php_post"),
        F.bool_or(F.col("k") == 83).alias("repeated_auth"), F.bool_or(F.col("k") == 82).alias("beacon"), F.bool_or(F.col("k") == 81).alias("encrypted"), F.bool_or(F.col("k") == 80).alias("miner"), F.bool_or(F.col("k") == 79).alias("benign"),
    )


def candidate_scores(spark, d):
    out = P.candidate_scores(_captures(spark, d))
    top = F.array_join(F.transform("top", lambda x: F.concat(x["technique"], F.lit("="), x["score"].cast("string"))), ",").alias("top")
    sizes = [F.size(c).cast("long").alias(c) for c in ("evidence", "weak_evidence", "counter_evidence")]
    return out.select("capture_id", "source", *(f"score_{c}" for c in V.TECHNIQUES), "primary", "best", "margin", "strength", top, *sizes, F.array_join("flag_names", ",").alias("flag_names"))


def capture_record(spark, d):
    rows = flow(spark, d)
    parses = rows.select("capture_id").distinct().withColumn("file_name", F.concat("capture_id", F.lit(".pcap")))
    return P.capture_records(rows, rows.where("k > 50 AND capture_id < 'cap6'"), parses)


def behaviour_summaries(spark, d):
    return P.behaviour_summaries(C.source_context(flow(spark, d)))


def chunk_documents(spark, d):
    return K.chunk_documents(spark.read.parquet(f"{d}/documents.parquet"))


def keyword_index(spark, d):
    return K.keyword_index(chunks(spark, d))


#: Words that open queries to the bonuses.
ASK = "CONCAT(text, CASE item_id % 6 WHEN 1 THEN ' scan' WHEN 2 THEN ' low confidence' WHEN 3 THEN ' c2 protocol anomaly' WHEN 4 THEN ' sql injection' WHEN 5 THEN ' exploit' ELSE '' END)"


def _retrieved(spark, d):
    items = spark.read.parquet(f"{d}/benchmark.parquet")
    queries = items.select(F.col("item_id").alias("query_id"), F.expr(ASK).alias("query"))
    pins = items.where("item_id % 4 = 0").select(F.col("item_id").alias("query_id"), F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))).alias("place"))
    return K.retrieve_top_k(queries, chunks(spark, d), 5, pinned=pins.withColumn("doc_id", F.expr("(query_id * 7 + place * 13) % 200")))


def retrieve_top_k(spark, d):
    return _retrieved(spark, d)


TERM_RULES = (("k > 90", "port scan probe"), ("event_type = 'error'", "failed rejected probe"), ("value > 10", "volume transfer"), ("k BETWEEN 20 AND 40", "callback c2 interval"))


def query_terms(spark, d):
    return K.query_terms(records(spark, d), TERM_RULES).select("record_id", F.array_join("terms", " ").alias("terms"), "low_signal")


#: Strength, conflicts and evidence of records.
STRENGTH = "CASE level WHEN 'high' THEN 'strong' WHEN 'medium' THEN 'medium' ELSE 'weak' END"
CONFLICT = "CASE k % 3 WHEN 0 THEN 'payload_observability_gap' ELSE 'low_score_margin' END"


def _routed(spark, d):
    flags = F.expr(f"slice(array({CONFLICT}, 'weak_evidence', 'other'), 1, flags)")
    return records(spark, d).withColumns({"primary": F.when(F.col("k") % 50 != 0, F.col("truth")), "strength": F.expr(STRENGTH), "flag_names": flags, "rule_evidence": F.expr("slice(array(event_type, ' seen  twice', 'more'), 1, k % 4)")})


def route_records(spark, d):
    rows = _routed(spark, d)
    return R.route_records(rows, rows.where("record_id % 10 = 0"), max_flags=1).select("record_id", "route", "reason")


def rule_direct_prediction(spark, d):
    return R.rule_direct_prediction(_routed(spark, d).withColumns({f"score_{c}": (F.col("record_id") * (i + 3) % 10).cast("double") for i, c in enumerate(V.TECHNIQUES)}))


def merge_shards(spark, d):
    rows = records(spark, d).select((F.col("record_id") % 1000).alias("record_id"), (F.col("record_id") % 7).alias("shard"), F.col("record_id").alias("attempt"), "plain_guess")
    return R.merge_shards(rows)


#: Answers of a model in the forms that it gives them: key of the code, stage given or not, reasons, numbers and words of confidence.
BODY = """
CONCAT('{"record_id": "', CAST(record_id AS STRING), CASE k % 3 WHEN 0 THEN '", "technique_guess": "' WHEN 1 THEN '", "technique_code": "' ELSE '", "predicted_code": "' END, CASE k % 9 WHEN 0 THEN 'none' WHEN 1 THEN 'null' WHEN 2 THEN lower(truth) ELSE truth END,
  CASE k % 4 WHEN 0 THEN '", "stage_code": "TA11' WHEN 1 THEN '", "stage_code": "' ELSE '' END, CASE k % 7 WHEN 0 THEN '' ELSE '", "reason": " seen  in flow ' END, '", "confidence": ', CASE k % 13 WHEN 0 THEN '"?"' WHEN 1 THEN '0.71236' WHEN 2 THEN '1.5' ELSE CONCAT('"', level, '"') END, '}')
"""


def parse_predictions(spark, d):
    rows = records(spark, d).withColumn("body", F.expr(BODY))
    body = F.col("body")
    text = F.when(F.col("k") % 5 == 0, F.concat(body, body)).when(F.col("k") % 5 == 1, "no answer").when(F.col("k") % 5 == 2, F.concat(F.lit("<THINK>{\"a\": 1}</think> ```json"), body, F.lit("```"))).otherwise(body)
    return R.parse_predictions(rows.select("record_id", text.alias("response")))


def attach_context(spark, d):
    rows = flow(spark, d).select(F.col("session_id").alias("record_id"), "capture_id", F.col("session_id").cast("double").alias("start_time"), "src_ip")
    i = F.col("record_id")
    wanted = rows.select(F.when(i % 3 == 0, i + 10_000_000).otherwise(i).alias("record_id"), F.when(i % 9 == 0, "gone").when(i % 6 != 1, F.col("capture_id")).alias("capture_id"), F.when(i % 4 == 0, 5.0).alias("start_time"), F.when(i % 5 == 0, "own.pcap").when(i % 5 == 1, " ").alias("file_name"))
    parses = rows.select("capture_id").distinct().withColumn("file_name", F.concat("capture_id", F.lit(".pcap")))
    return R.attach_context(wanted, rows, parses)


#: Candidate rows and captures with awkward addresses and ports.
ENDS = """
SELECT capture_id, CASE k % 4 WHEN 0 THEN 'scan' WHEN 1 THEN 'benign' ELSE 'session' END AS kind, session_id AS place, start_time, CASE WHEN k % 2 = 0 THEN start_time END AS end_time,
       CASE k % 7 WHEN 0 THEN '1.1.1.1' WHEN 1 THEN 'multiple' ELSE src_ip END AS src_ip, CASE k % 3 WHEN 0 THEN 'multiple' ELSE CAST(src_port AS STRING) END AS src_port,
       CASE k % 6 WHEN 0 THEN '2.2.2.2' WHEN 1 THEN NULL WHEN 2 THEN 'host' ELSE dst_ip END AS dst_ip, CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN '80,81' ELSE CAST(dst_port AS STRING) END AS dst_port
FROM flow
"""
CAPS = """
SELECT capture_id, CASE capture_id WHEN 'cap0' THEN 'TA43_01' WHEN 'cap1' THEN 'TN01_01' WHEN 'cap2' THEN 'TA43_01' ELSE 'TA11_02' END AS technique, MIN(src_ip) AS src_ip, MAX(dst_ip) AS dst_ip,
       MIN(CAST(dst_port AS STRING)) AS dst_port, CASE WHEN capture_id = 'cap0' THEN '1,2,3' ELSE '' END AS ports
FROM flow GROUP BY capture_id
"""


def representative_endpoint(spark, d):
    rows = flow(spark, d)
    made = lambda sql: spark.sql(sql.replace("FROM flow", "FROM {flow}"), flow=rows)
    return R.representative_endpoint(made(ENDS), made(CAPS))


#: Predictions and templates of a submission.
SENT = """
SELECT record_id, CONCAT('In/File', CAST(record_id % 50 AS STRING), '.PCAP') AS file_name, 1312967328 + record_id AS start_time, CASE WHEN record_id % 4 > 0 THEN 1312967333 + record_id END AS end_time,
       CONCAT('10.0.0.', CAST(record_id % 9 AS STRING)) AS src_ip, record_id % 60000 AS src_port, CASE WHEN record_id % 3 > 0 THEN ' 8.8.8.8 ' END AS dst_ip, 80 AS dst_port, truth AS technique, 'seen  in\nflow token=abc1, API-key: x9 here' AS reason
FROM record
"""
GIVEN = """
SELECT CONCAT('FILE', CAST(record_id AS STRING), CASE WHEN record_id % 2 = 0 THEN '.pcap' ELSE '' END) AS key, CONCAT('N', CAST(record_id AS STRING)) AS number, 'monday' AS start, CONCAT('1.1.1.', CAST(record_id AS STRING)) AS src_ip, record_id AS src_port
FROM record WHERE record_id < 20
"""


def submission_rows(spark, d):
    rows = records(spark, d)
    sent, given = (spark.sql(q.replace("FROM record", "FROM {record}"), record=rows) for q in (SENT, GIVEN))
    return R.submission_rows(sent, given)


def conflict_cases(spark, d):
    rows = records(spark, d).select("record_id", F.col("plain_guess").alias("technique"), F.col("truth").alias("rule"), F.col("score").alias("attack_score"), (F.col("flags") == 1).alias("benign_evidence"))
    return R.conflict_cases(rows).select("record_id", F.array_join("conflicts", ",").alias("conflicts"))


def prompt_text(spark, d):
    items = spark.read.parquet(f"{d}/benchmark.parquet")
    bodies = items.select(F.col("item_id").alias("record_id"), F.col("text").alias("body"), F.expr("CASE WHEN item_id % 3 = 0 THEN CONCAT('Candidates of ', CAST(item_id AS STRING)) END").alias("context"))
    bits = _retrieved(spark, d).join(chunks(spark, d).select("chunk_id", "text"), "chunk_id").select(F.col("query_id").alias("record_id"), "rank", "pinned", "text")
    return R.prompt_text(bodies, bits, "Classify the record.", 2200, body_limit=1800)


#: Sides of the answer matching: files of four, some numbers of their own, some rows with an observable start.
GUESSES = """
SELECT record_id AS prediction_id, CONCAT('f', CAST(record_id - record_id % 4 AS STRING)) AS file, CASE record_id % 7 WHEN 0 THEN CONCAT('n', CAST(record_id AS STRING)) WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE CAST(record_id % 3 AS STRING) END AS number,
       CASE WHEN record_id % 7 = 1 THEN CAST(record_id - record_id % 2 AS STRING) END AS start_time, '' AS end_time, CAST(NULL AS STRING) AS src_ip, CAST(NULL AS STRING) AS src_port, CAST(NULL AS STRING) AS dst_ip, CAST(NULL AS STRING) AS dst_port
FROM record
"""
ANSWERS = """
SELECT prediction_id AS answer_id, CASE WHEN prediction_id % 7 = 0 THEN CONCAT('g', CAST(prediction_id AS STRING)) ELSE file END AS file, CASE WHEN prediction_id % 5 > 0 THEN number END AS number, start_time, end_time, src_ip, src_port, dst_ip, dst_port
FROM guess WHERE prediction_id % 13 > 0
"""


def _sides(spark, d):
    guesses = spark.sql(GUESSES.replace("FROM record", "FROM {record}"), record=records(spark, d))
    return M.with_signature(guesses), M.with_signature(spark.sql(ANSWERS.replace("FROM guess", "FROM {guess}"), guess=guesses))


def match_answers(spark, d):
    return M.match_answers(*_sides(spark, d))


def unmatched_rows(spark, d):
    sides = _sides(spark, d)
    return M.unmatched_rows(*sides, M.match_answers(*sides))


def _guessed(spark, d):
    return records(spark, d).select("truth", F.col("plain_guess").alias("guess"))


def confusion_grid(spark, d):
    return M.confusion_grid(_guessed(spark, d))


def overall_metrics(spark, d):
    return M.overall_metrics(_guessed(spark, d))


def stage_metrics(spark, d):
    return M.stage_metrics(records(spark, d).select("truth", F.col("plain_guess").alias("guess")))


def paired_effect(spark, d):
    return M.paired_effect(records(spark, d).select("record_id", "truth", F.col("plain_guess").alias("a"), F.col("context_guess").alias("b")))


def scope_metrics(spark, d):
    scopes = {"attack": F.col("truth") != "TN01_01", "scored": F.col("score") >= 5, "clean": F.col("flags") == 0}
    return M.scope_metrics(records(spark, d).withColumn("guess", F.col("plain_guess")), scopes)


def run_cost(spark, d):
    return M.run_cost(records(spark, d).select(F.col("level").alias("mode"), (1000 + F.col("k")).alias("tokens_in"), (50 + F.col("flags")).alias("tokens_out"), (F.col("record_id") % 997 / 100).alias("latency")))


def layer_retention(spark, d):
    rows = flow(spark, d)
    return M.layer_retention({"sessions": rows, "records": rows.where("k > 30")}, {"http": F.col("dst_port") == 80, "tls": F.col("dst_port") == 443, "failed": V.is_failed(F.col("conn_state"))})


def majority_flow_label(spark, d):
    rows = flow(spark, d).select("session_id", "src_ip", (F.col("src_port") % 5).alias("src_port"), "dst_ip", "dst_port", "event_type", "k")
    ends = lambda r, a, b: r.select(F.col(f"{a}_ip").alias("src_ip"), F.col(f"{a}_port").alias("src_port"), F.col(f"{b}_ip").alias("dst_ip"), F.col(f"{b}_port").alias("dst_port"), F.col("event_type").alias("label"))
    labels = ends(rows.where("k % 3 = 0"), "src", "dst").unionByName(ends(rows.where("k % 3 = 1"), "dst", "src"))
    return U.majority_flow_label(rows, labels).select("session_id", "flow_label", "label_rows")


def endpoint_label_join(spark, d):
    rows = _signals(spark, d)
    beacons = C.endpoint_beacon(rows.withColumn("capture_id", F.lit("all"))).select("src_ip", "dst_ip", "dst_port", "proto", "connections", F.col("beacon_score").alias("score"))
    return U.endpoint_label_join(beacons, rows.where("event_type <> 'click'"), min_score=0.3)


def refresh_records(spark, d):
    rows = records(spark, d)
    old = rows.select("record_id", F.col("event_type").alias("evidence"), "flags")
    return U.refresh_records(old, rows.where("k > 40").select("record_id", F.col("truth").alias("evidence")), F.col("flags") == 0).select("record_id", "evidence", "refreshed")


def boundary_rule_join(spark, d):
    rows = records(spark, d).select("record_id", F.array_distinct(F.array("truth", "plain_guess", "context_guess")).alias("candidates"))
    rules = spark.createDataFrame([(i, [a, b]) for i, (a, b) in enumerate((a, b) for a in V.TECHNIQUES for b in V.TECHNIQUES if a < b)], "rule_id int, codes array<string>")
    return U.boundary_rule_join(rows, rules)


def label_counts(spark, d):
    return U.label_counts(records(spark, d).where("truth <> 'TA03_01'"), ["truth", "level"], V.TECHNIQUES, "truth")


def _tiers(spark, d):
    return U.confidence_tier(records(spark, d).withColumn("source", F.when(F.col("k") % 10 == 0, "synthetic").otherwise("real")))


def confidence_tier(spark, d):
    return _tiers(spark, d).select("record_id", "tier")


def row_checks(spark, d):
    rows = records(spark, d).select((F.col("record_id") - F.when(F.col("record_id") % 50 == 7, 1).otherwise(0)).alias("record_id"), F.when(F.col("k") % 20 != 0, F.col("event_type")).alias("event_type"), F.when(F.col("k") == 33, "XX").otherwise(F.col("truth")).alias("truth"))
    return U.row_checks(rows, ["event_type"], V.TECHNIQUES)


def coverage_split(spark, d):
    order = F.when(F.col("level") == "high", 0).when(F.col("level") == "medium", 1).otherwise(2)
    return U.first_per_class(records(spark, d), "truth", [order, F.col("record_id")], 20).select("record_id", "truth", "place")


def tiered_fill(spark, d):
    return U.tiered_fill(_tiers(spark, d), "truth", 30).select("record_id", "truth", "tier", "short")


def round_robin_sample(spark, d):
    return U.round_robin(records(spark, d), "truth", 60).select("record_id", "truth", "place")


def heuristic_top_sets(spark, d):
    return U.heuristic_top_sets(records(spark, d), "score", "value").select("record_id", "chosen_by")


def best_per_label(spark, d):
    return U.best_per_label(records(spark, d).withColumn("score", F.col("value")), "truth", 5).select("record_id", "truth", "score")


def pseudonymize_ids(spark, d):
    return U.pseudonymize(records(spark, d)).select("record_id", "capture_alias", "record_alias")


def group_safe_split(spark, d):
    rows = records(spark, d).withColumn("g", F.substring("capture_id", 4, 3).cast("int"))
    return U.group_safe_split(rows, "capture_id", rows.where("k = 1"), F.pmod(F.col("g") * 37 + 11, F.lit(100))).select("record_id", "split")


def capped_rows(spark, d):
    return flow(spark, d).orderBy("capture_id", F.asc_nulls_last("start_time"), "session_id").limit(500).select("session_id")


def parse_quality(spark, d):
    rows = records(spark, d).select("record_id", F.when(F.col("k") % 4 == 0, F.array(F.lit("w"))).otherwise(F.array().cast("array<string>")).alias("warnings"), (F.col("flags") > 1).alias("logs_ok"), (F.col("k") % 3 == 0).alias("packets_ok"))
    return L.parse_quality(rows).select("record_id")


def header_alias(spark, d):
    rows = records(spark, d).select(F.col("record_id").alias("编号"), F.col("capture_id").alias("PCAP 文件名"), F.col("truth").alias("Technique-Code"), F.col("k").alias("other"))
    return L.header_alias(rows)


def redact_log_columns(spark, d):
    rows = flow(spark, d).select("session_id", F.concat(F.lit("/a?tok%65n="), F.col("src_ip"), F.lit("&x=1")).alias("uri"), F.when(F.col("k") % 2 == 0, "-").otherwise("bob").alias("username"), F.when(F.col("k") % 3 == 0, "PASS").otherwise("LIST").alias("command"), F.lit("arg").alias("arg"))
    return L.redact_log_columns(rows)


def discover_captures(spark, d):
    rows = flow(spark, d)
    path = F.concat(F.lit("/in/captures/"), F.col("capture_id"), F.lit("/u"), F.col("user_id").cast("string"), F.element_at(F.array(F.lit("/zeek/"), F.lit("/"), F.lit("/logs/")), (F.col("k") % 3 + 1).cast("int")), F.element_at(F.array(F.lit("ssl"), F.lit("tls"), F.lit("conn")), (F.col("session_id") % 3 + 1).cast("int")), F.lit(".log"))
    return L.discover_logs(rows.select(path.alias("path")).distinct())


QUERIES = {f.__name__: f for f in (
    attach_app_logs, attach_files, sessions_from_packets, packet_fallback, map_observations, payload_visibility, protocol_summaries, http_rollup, success_after_failure, merge_observables, suspicion_rank, payload_evidence,
    repeated_auth_service, candidate_scores, capture_record, behaviour_summaries, chunk_documents, keyword_index, retrieve_top_k, query_terms, route_records, rule_direct_prediction, merge_shards, parse_predictions, attach_context,
    representative_endpoint, submission_rows, conflict_cases, prompt_text, match_answers, unmatched_rows, confusion_grid, overall_metrics, stage_metrics, paired_effect, scope_metrics, run_cost, layer_retention, majority_flow_label, endpoint_label_join, refresh_records,
    boundary_rule_join, label_counts, confidence_tier, row_checks, coverage_split, tiered_fill, round_robin_sample, heuristic_top_sets, best_per_label, pseudonymize_ids, group_safe_split, capped_rows, parse_quality, header_alias,
    redact_log_columns, discover_captures,
)}

_OK = f"NOT ({FAILED})"
_MATCH = lambda n, c: f"bool_or(regexp_matches({c}, '{LISTS[n]}'))"
_PK = """pk AS (SELECT capture_id, CASE WHEN k % 2 = 0 THEN user_id END AS stream, session_id AS ord, CASE WHEN session_id % 2 = 1 THEN dst_ip ELSE src_ip END AS src_ip, CASE WHEN session_id % 2 = 1 THEN 80 ELSE 4000 END AS src_port,
    CASE WHEN session_id % 2 = 1 THEN src_ip ELSE dst_ip END AS dst_ip, CASE WHEN session_id % 2 = 1 THEN 4000 ELSE 80 END AS dst_port, proto, orig_bytes AS bytes, k, k % 3 = 0 AS syn, k % 10 = 0 AS ack,
    coalesce('s' || CASE WHEN k % 2 = 0 THEN user_id END, CASE WHEN session_id % 2 = 1 THEN CASE WHEN dst_ip < src_ip THEN dst_ip || '|80|' || src_ip || '|4000' ELSE src_ip || '|4000|' || dst_ip || '|80' END ELSE CASE WHEN src_ip < dst_ip THEN src_ip || '|4000|' || dst_ip || '|80' ELSE dst_ip || '|80|' || src_ip || '|4000' END END || '|' || proto) AS key FROM flow)"""
_TOK = r"list_filter(list_transform(regexp_extract_all(lower(coalesce({0}, '')), '[A-Za-z0-9_.:/+-]+|[\x{{4e00}}-\x{{9fff}}]+'), lambda t: trim(t, '.,;()[]{{}}<>""''')), lambda t: length(t) >= 2)".replace('""', '"')
_BONUS = " + ".join(f"CASE WHEN ({q}) AND ({c}) THEN {w} ELSE 0 END" for q, c, w in K.METADATA_BONUS).replace("arrays_overlap(tokens, array(", "list_has_any(tokens, array_value(").replace("array_contains(", "list_contains(")
_BONUS += "".join(f" + CASE WHEN contains(asked, '{n}') AND contains(blob, '{n}') THEN {K.SIGNATURE_BONUS} ELSE 0 END" for n in K.SIGNATURE_NAMES)
_RETRIEVED = f"""WITH q AS (SELECT item_id AS query_id, lower({ASK}) AS asked, list_distinct({_TOK.format(ASK)}) AS tokens FROM benchmark),
        c AS (SELECT *, list_distinct({_TOK.format('title')}) AS a, list_distinct({_TOK.format('keywords')}) AS b, list_distinct({_TOK.format('text')}) AS t, lower(concat_ws(' ', title, keywords, text)) AS blob FROM chunk),
        s AS (SELECT query_id, chunk_id, (3 * len(list_filter(tokens, lambda x: length(x) >= 4 AND contains(blob, x))) + 3 * len(list_intersect(tokens, a)) + 4 * len(list_intersect(tokens, b)) + 5e-1 * least(len(list_intersect(tokens, t)), 20) + {_BONUS})::DOUBLE AS score FROM q, c),
        pin AS (SELECT item_id AS query_id, place AS rank, (item_id * 7 + place * 13) % 200 AS chunk_id FROM benchmark, (VALUES (1), (2), (3)) v(place) WHERE item_id % 4 = 0),
        ranked AS (SELECT query_id, rank, chunk_id, 1001e0 - rank AS score, true AS pinned FROM pin UNION ALL
            SELECT query_id, n + CASE WHEN query_id % 4 = 0 THEN 3 ELSE 0 END, chunk_id, score, false FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS n FROM s ANTI JOIN pin USING (query_id, chunk_id) WHERE score > 0) WHERE n <= 5)"""


def _matched() -> str:
    fields = "coalesce(start_time, '') || coalesce(src_ip, '')"
    out = "WITH guess AS (" + GUESSES + "), answer AS (" + ANSWERS + ")"
    for side, table, key in (("p", "guess", "prediction_id"), ("a", "answer", "answer_id")):
        out += f", {side}0 AS (SELECT {key} AS i, file, number, CASE WHEN {fields} <> '' THEN file || '|' || {fields} END AS signature FROM {table})"
    for n, keys in enumerate(("file, number", "number", "signature", "file")):
        one = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
        single = lambda t: f"(SELECT {keys}, min(i) AS i FROM {t}{n} WHERE {one} GROUP BY {keys} HAVING count(*) = 1)"  # noqa: B023, E731
        out += f", m{n} AS (SELECT x.i AS prediction_id, y.i AS answer_id, '{keys.replace(', ', '+')}' AS method FROM {single('p')} x JOIN {single('a')} y USING ({keys}))"
        out += f", p{n + 1} AS (SELECT * FROM p{n} WHERE i NOT IN (SELECT prediction_id FROM m{n})), a{n + 1} AS (SELECT * FROM a{n} WHERE i NOT IN (SELECT answer_id FROM m{n}))"
    return out + ", matched AS (" + " UNION ALL ".join(f"SELECT * FROM m{n}" for n in range(4)) + ")"


_MATCHED = _matched()
_CAPS = ", ".join([
    "count(DISTINCT dst_port) AS port_fanout", *(f"count(*) FILTER (k {t}) AS {n}" for n, t in {"scan_rows": "> 97", "vulnerability": "= 95", "exploit": "= 94", "payload": "= 93", "implant": "= 92", "backdoor": "= 91", "callback": "= 89", "login_failures": "= 77", "login_attempts": "BETWEEN 70 AND 76"}.items()),
    f"round(avg(CASE WHEN {FAILED} THEN 1e0 ELSE 0e0 END), 4) AS failed_rate", "count(*) FILTER (dst_port = 22 AND k < 8) AS auth_rows",
    *(f"bool_or(k = {n}) AS {c}" for c, n in zip("sensitive_path web_shell command placement php_post repeated_auth beacon encrypted miner benign".split(), range(88, 78, -1), strict=True)),
])
def scored(caps: str) -> str:
    """Scores and numbers of reasons of the captures in ``caps``, written out apart from the rules, as CTEs up to z; each name is 0 or 1."""
    return f"""f AS (SELECT capture_id, source, (port_fanout >= 8 OR scan_rows > 0)::INT AS scan, (failed_rate >= 4e-1)::INT AS fails, (vulnerability > 0)::INT AS vuln, sensitive_path::INT AS sens, (exploit > 0)::INT AS expl, (payload > 0)::INT AS pay,
        (web_shell AND command)::INT AS acc, (auth_rows > 0 OR login_failures > 0 OR login_attempts >= 5)::INT AS log, repeated_auth::INT AS rep, (implant > 0)::INT AS impl, placement::INT AS plac, php_post::INT AS php, (backdoor > 0)::INT AS back,
        (callback > 0)::INT AS call, beacon::INT AS beac, encrypted::INT AS enc, miner::INT AS mine, benign::INT AS ben FROM {caps}),
    g AS (SELECT *, greatest(scan, vuln, sens, expl, acc, log, rep, impl * plac, back, call * (1 - rep), mine) AS sure, greatest(pay * (1 - expl), impl * (1 - plac), php * (1 - impl)) AS weak, impl * (1 - plac) * greatest(expl, pay) AS odd FROM f),
    h AS (SELECT capture_id, source, 35e-1 * scan + 8e-1 * scan * fails - 12e-1 * scan * greatest(vuln, sens) - 12e-1 * rep AS TA43_01, 3e0 * vuln + 45e-1 * sens AS TA43_02, 32e-1 * log + 5e0 * rep AS TA01_01,
        32e-1 * expl - 8e-1 * vuln + 32e-1 * expl * pay + 7e-1 * pay * (1 - expl) - 18e-1 * acc - 1e0 * impl * plac + 2e0 * odd - 1e0 * ben * sure - 14e-1 * ben * (1 - sure) AS TA01_02,
        46e-1 * impl * plac + 1e0 * impl * (1 - plac) - 1e0 * odd + 2e-1 * php * (1 - impl) AS TA03_01, 5e0 * acc - 6e-1 * expl * (1 - acc) + 38e-1 * back AS TA11_01,
        26e-1 * call * (1 - rep) - 12e-1 * call * rep - 35e-1 * rep + 4e0 * call * beac * (1 - rep) + 12e-1 * enc * beac + 5e0 * mine - 1e0 * ben * sure - 12e-1 * ben * (1 - sure) AS TA11_02,
        35e-1 * ben * (1 - sure) + 8e-1 * weak * (1 - sure) + 22e-1 * (1 - weak) * (1 - sure) - 1e0 * sens - 2e0 * expl * pay - 2e0 * call * beac * (1 - rep) - 15e-1 * mine AS TN01_01,
        (scan + scan * fails + vuln + sens + expl + expl * pay + acc + log + rep + impl + odd + back + call * (1 - rep) + call * beac * (1 - rep) + enc * beac * (1 - rep) + mine + ben * (1 - sure) + 1 - sure)::BIGINT AS evidence,
        (pay * (1 - expl) + php * (1 - impl) + call * rep + enc * beac * rep)::BIGINT AS weak_evidence,
        (scan * greatest(vuln, sens) + vuln + sens + expl * pay + acc + expl * (1 - acc) + 2 * rep + impl * plac + odd + php * (1 - impl) + call * rep + call * beac * (1 - rep) + mine + 3 * ben * sure + 2 * ben * (1 - sure) + weak * (1 - sure))::BIGINT AS counter_evidence,
        sure, ben, rep, php, plac FROM g),
    sc AS (SELECT capture_id, source, evidence, weak_evidence, counter_evidence, sure, ben, rep, php, plac, {", ".join(f"round(least(greatest({c}, 0e0), 1e1), 3) AS score_{c}" for c in V.TECHNIQUES)} FROM h),
    o AS (SELECT *, list_sort([{", ".join(f"{{'m': -score_{c}, 'p': {i}, 'c': '{c}'}}" for i, c in enumerate(V.TECHNIQUES))}]) AS l FROM sc),
    p AS (SELECT * EXCLUDE (l), l[1].c AS "primary", -l[1].m AS best, round(-l[1].m + l[2].m, 3) AS margin, array_to_string(list_transform(l[:3], lambda x: x.c || '=' || abs(x.m)::VARCHAR), ',') AS top FROM o),
    q AS (SELECT *, CASE WHEN best >= 6 AND margin >= 2 THEN 'strong' WHEN best >= 3 OR margin >= 1 THEN 'medium' ELSE 'weak' END AS strength FROM p),
    z AS (SELECT * EXCLUDE (sure, ben, rep, php, plac), concat_ws(',', CASE WHEN margin < 15e-1 THEN 'low_score_margin' END, CASE WHEN strength = 'weak' THEN 'weak_evidence' END, CASE WHEN sure = 1 AND "primary" = 'TN01_01' THEN 'attack_indicators_vs_normal_candidate' END,
        CASE WHEN ben = 1 AND "primary" <> 'TN01_01' AND sure = 0 THEN 'benign_context_vs_attack_candidate' END, CASE WHEN rep = 1 AND score_TA11_02 > 0 THEN 'auth_service_repetition_counters_c2' END,
        CASE WHEN php = 1 AND plac = 0 THEN 'generic_php_post_weak_implant_evidence' END) AS flag_names FROM q)"""


_CANDIDATES = f"WITH caps AS (SELECT capture_id, src_ip AS source, {_CAPS} FROM flow GROUP BY ALL), {scored('caps')} SELECT * FROM z"
_TIER = "CASE WHEN k % 10 = 0 THEN 'synthetic' WHEN level = 'high' THEN 'strict' WHEN level = 'medium' THEN 'medium' ELSE 'weak' END"

#: Suspicion of sessions, each rule written out.
_SUSPECTS = """s AS (SELECT flow.*, greatest(same_src_unique_dst_ports, same_src_unique_dst_ips) >= 8 AS a, same_src_failed_conn_rate >= 5e-1 AS b, k % 17 = 0 AS c, k % 23 = 0 AS d, k % 11 = 0 AS e, k % 19 = 0 AND k > 0 AS f, k / 1e2 >= 5e-1 OR k % 29 = 0 AS g, k % 29 = 0 AS h FROM flow JOIN src USING (capture_id, src_ip)),
    z AS (SELECT *, (least(15, floor(k + (coalesce(orig_bytes, 0) + coalesce(resp_bytes, 0)) / 4096)) + 55 * a::INT + 15 * b::INT + 50 * f::INT + 50 * g::INT + 48 * c::INT + 42 * d::INT + 22 * e::INT)::BIGINT AS suspicion, coalesce(nullif(concat_ws(',', CASE WHEN a THEN 'scan_high_fanout' END, CASE WHEN b THEN 'failed_connection_rate' END,
        CASE WHEN f THEN 'auth_failures' END, CASE WHEN g THEN 'beacon_or_c2' END, CASE WHEN c THEN 'exploit_or_command_payload' END, CASE WHEN d THEN 'upload_or_multipart' END, CASE WHEN e THEN 'observable_payload' END), ''), 'benign_context') AS reasons FROM s),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY suspicion DESC, start_time NULLS LAST, session_id::VARCHAR) AS rank FROM z)"""

ORACLES = {
    "attach_app_logs": duck("SELECT session_id, (CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END)::BIGINT AS http_rows, CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END::BIGINT AS dns_rows FROM flow"),
    "attach_files": duck("SELECT session_id, CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END::BIGINT AS files, k % 8 = 0 AS suspicious_file FROM flow"),
    "sessions_from_packets": duck(f"""WITH {_PK}, h AS (SELECT DISTINCT ON (capture_id, key) capture_id, key, src_ip AS a, src_port AS ap, dst_ip AS b, dst_port AS bp, proto AS p FROM pk ORDER BY capture_id, key, ord)
        SELECT capture_id, key, a AS src_ip, ap AS src_port, b AS dst_ip, bp AS dst_port, p AS proto, min(ord)::DOUBLE AS start_time, max(ord)::DOUBLE AS end_time, count(*) FILTER (src_ip = a AND src_port = ap) AS orig_pkts, count(*) FILTER (NOT (src_ip = a AND src_port = ap)) AS resp_pkts,
        sum(CASE WHEN src_ip = a AND src_port = ap THEN bytes ELSE 0 END)::BIGINT AS orig_bytes, sum(CASE WHEN src_ip = a AND src_port = ap THEN 0 ELSE bytes END)::BIGINT AS resp_bytes, CASE WHEN any_value(p) = 'tcp' AND bool_or(syn) AND NOT bool_or(ack) THEN 'S0' END AS conn_state, (max(ord) - min(ord))::DOUBLE AS duration, arg_min(CASE k % 3 WHEN 1 THEN 'http' ELSE 'dns' END, ord) FILTER (k % 3 > 0) AS service FROM pk JOIN h USING (capture_id, key) GROUP BY ALL"""),
    "packet_fallback": duck(f"WITH {_PK} SELECT capture_id, 'log' AS origin, count(*) AS sessions FROM flow WHERE capture_id NOT IN ('cap3', 'cap5') GROUP BY ALL UNION ALL SELECT capture_id, 'packets', count(DISTINCT key) FROM pk WHERE capture_id IN ('cap3', 'cap5') GROUP BY ALL"),
    "map_observations": duck("""WITH st AS (SELECT capture_id, user_id AS stream, min(session_id) AS s FROM flow WHERE k % 3 = 0 GROUP BY ALL), ky AS (SELECT capture_id, src_ip || '|' || dst_ip AS key, min(session_id) AS s FROM flow GROUP BY ALL)
        SELECT f.session_id AS observation, coalesce(st.s, ky.s) AS session_id, CASE WHEN st.s IS NOT NULL THEN 'stream' WHEN ky.s IS NOT NULL THEN 'five_tuple' ELSE 'none' END AS method FROM flow f LEFT JOIN st ON st.capture_id = f.capture_id AND st.stream = CASE WHEN k % 2 = 0 THEN user_id ELSE -1 END LEFT JOIN ky ON ky.capture_id = f.capture_id AND k % 5 <> 1 AND ky.key = src_ip || '|' || dst_ip"""),
    "payload_visibility": duck("SELECT session_id, v AS payload_visibility, CASE WHEN v LIKE '%_encrypted' THEN split_part(v, '_', 1) ELSE 'none' END AS encrypted_protocol, v = 'http_visible' AS observable_payload_available FROM (SELECT session_id, CASE WHEN dst_port = 443 THEN 'tls_encrypted' WHEN dst_port = 22 THEN 'ssh_encrypted' WHEN proto = 'udp' THEN 'quic_encrypted' WHEN dst_port = 80 THEN 'http_visible' WHEN k > 80 THEN 'metadata_only' ELSE 'unknown' END AS v FROM flow)"),
    "protocol_summaries": duck("SELECT capture_id, uid, any_value(n) AS count, any_value(dn) AS different, any_value(dc) AS codes, string_agg(v, ',' ORDER BY f) AS samples FROM (SELECT capture_id, src_ip AS uid, dst_port::VARCHAR AS v, min(session_id) AS f, row_number() OVER (PARTITION BY capture_id, src_ip ORDER BY min(session_id)) AS r FROM flow GROUP BY capture_id, src_ip, dst_port) JOIN (SELECT capture_id, src_ip AS uid, count(*) AS n, count(DISTINCT dst_port) AS dn, count(DISTINCT conn_state) AS dc FROM flow GROUP BY ALL) USING (capture_id, uid) WHERE r <= 4 GROUP BY capture_id, uid"),
    "http_rollup": duck(f"""SELECT *, requests >= 4 AND not_found >= 0.6 * requests AS many_not_found FROM (SELECT capture_id, src_ip AS uid, count(*) AS requests, count(DISTINCT url) AS different_urls, {_MATCH('login_path', 'url')} AS login_path, {_MATCH('command_param', 'url')} AS command_param, {_MATCH('archive', 'url')} AS archive_path,
        {_MATCH('upload', 'html')} AS upload_hint, {_MATCH('web_shell', 'html')} AS web_shell, count(*) FILTER (status = 404 AND NOT login) AS not_found, count(*) FILTER (login) AS auth_failures, sum(length(url))::BIGINT AS request_bytes, sum(length(html))::BIGINT AS response_bytes FROM page GROUP BY ALL)"""),
    "success_after_failure": duck(f"SELECT capture_id, src_ip AS uid, coalesce(max(session_id) FILTER ({_OK}) > min(session_id) FILTER ({FAILED}), false) AS success_after_failure, count(*) FILTER ({FAILED}) AS failures FROM flow GROUP BY ALL"),
    "merge_observables": duck("""SELECT a.*, seen FROM (SELECT capture_id, bool_or(k > 95) AS hit, sum(orig_bytes)::BIGINT AS body_len, max(duration) AS longest, arg_min(src_ip, session_id) AS first_source FROM flow GROUP BY ALL) a JOIN
        (SELECT capture_id, string_agg(v, ',' ORDER BY o, p) AS seen FROM (SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY o, p) AS r FROM (SELECT capture_id, v, min(o) AS o, arg_min(p, o) AS p FROM (SELECT capture_id, dst_port::VARCHAR AS v, session_id AS o, 0 AS p FROM flow UNION ALL SELECT capture_id, proto, session_id, 1 FROM flow) GROUP BY ALL)) WHERE r <= 12 GROUP BY capture_id) b USING (capture_id)"""),
    "suspicion_rank": duck(f"""WITH {_SOURCE}, {_SUSPECTS} SELECT capture_id, session_id, rank, suspicion, reasons, concat_ws(',', CASE WHEN c THEN 'exploit_indicators' END, CASE WHEN h THEN 'c2_indicators' END) AS active FROM ranked WHERE rank <= 8"""),
    "payload_evidence": duck(f"""WITH {_SOURCE}, {_SUSPECTS}, t AS (SELECT capture_id, session_id, rank, 0 AS f, 'Text ' || (k % 9) AS text FROM ranked WHERE e UNION ALL SELECT capture_id, session_id, rank, 1, 'password=[REDACTED]' FROM ranked WHERE e UNION ALL SELECT capture_id, session_id, rank, 2, event_type FROM ranked),
        u AS (SELECT capture_id, lower(text) AS key, min(rank * 3 + f) AS o, arg_min(text, rank * 3 + f) AS text, arg_min(session_id, rank * 3 + f)::VARCHAR AS source_record_id, arg_min(f, rank * 3 + f) AS f FROM t GROUP BY ALL)
        SELECT capture_id, place, text, source_record_id, 'session' AS source_record_type, CASE WHEN f < 2 THEN 'suspicious_payload_snippets' ELSE 'event_type' END AS field FROM (SELECT *, row_number() OVER (PARTITION BY capture_id ORDER BY o) AS place FROM u) WHERE place <= 5"""),
    "repeated_auth_service": duck(f"""SELECT *, auth_rows >= 10 AND (auth_rows >= 20 OR busiest >= 10 OR short_or_failed >= 5) AS repeated FROM (SELECT capture_id, sum(n) FILTER (dst_port = 22)::BIGINT AS auth_rows, max(n) AS busiest, sum(s)::BIGINT AS short_or_failed
        FROM (SELECT capture_id, src_ip, dst_ip, dst_port, count(*) AS n, count(*) FILTER (dst_port = 22 AND ({FAILED} OR coalesce(resp_bytes, 0) = 0)) AS s FROM flow GROUP BY ALL) GROUP BY capture_id HAVING count(*) FILTER (dst_port = 22) > 0)"""),
    "candidate_scores": duck(_CANDIDATES),
    "capture_record": duck("""WITH r AS (SELECT capture_id, count(*) AS n, min(start_time) AS a, max(start_time) AS b, max(orig_bytes) AS m FROM flow WHERE k > 50 AND capture_id < 'cap6' GROUP BY ALL), s AS (SELECT capture_id, count(*) AS n, min(start_time) AS a, max(start_time) AS b, max(orig_bytes) AS m FROM flow GROUP BY ALL)
        SELECT s.capture_id, s.capture_id || '.pcap' AS file_name, s.n AS session_count, coalesce(r.n, 0) AS record_count, coalesce(r.a, s.a) AS first_time, coalesce(r.b, s.b) AS last_time, coalesce(r.m, s.m) AS max_bytes, CASE WHEN r.n IS NULL THEN 'sessions' ELSE 'records' END AS evidence FROM s LEFT JOIN r USING (capture_id)"""),
    "behaviour_summaries": duck(f"WITH {_SOURCE} SELECT capture_id, count(*) FILTER (same_src_unique_dst_ports >= 8) AS scan_rows, max(same_src_unique_dst_ports) AS max_ports, max(same_src_failed_conn_rate) AS max_failed_rate, count(*) FILTER (dst_port = 22) AS login_rows, count(*) FILTER (dst_port = 22 AND {FAILED}) AS login_failures, sum(CASE WHEN {FAILED} THEN orig_bytes ELSE 0 END)::BIGINT AS failed_bytes, count(*) FILTER (dst_port = 443) AS encrypted_rows FROM flow JOIN src USING (capture_id, src_ip) GROUP BY capture_id"),
    "keyword_index": duck(f"SELECT token, chunk_id, count(*) AS tf FROM (SELECT chunk_id, unnest({_TOK.format("concat_ws(chr(32), doc_id, title, category, keywords, array_to_string(attack_type, ' '), array_to_string(attack_stage, ' '), text)")}) AS token FROM chunk) GROUP BY ALL"),
    "retrieve_top_k": duck(f"{_RETRIEVED} SELECT * FROM ranked"),
    "query_terms": duck("""SELECT record_id, trim(concat_ws(' ', CASE WHEN k > 90 THEN 'port scan probe' END, CASE WHEN event_type = 'error' THEN CASE WHEN k > 90 THEN 'failed rejected' ELSE 'failed rejected probe' END END, CASE WHEN value > 10 THEN 'volume transfer' END, CASE WHEN k BETWEEN 20 AND 40 THEN 'callback c2 interval' END)) AS terms,
        NOT (k > 90 OR event_type = 'error' OR value > 10 OR k BETWEEN 20 AND 40) AS low_signal FROM record"""),
    "route_records": duck(f"""SELECT record_id, CASE WHEN reason = 'high_confidence_rule_candidate' THEN 'rule_direct' ELSE 'model' END AS route, reason FROM (SELECT record_id, CASE WHEN k % 50 = 0 THEN 'missing_primary_rule_candidate' WHEN truth = 'TN01_01' THEN 'normal_rule_direct_disabled'
        WHEN score < 7 THEN 'score_below_threshold' WHEN margin < 25e-1 THEN 'margin_below_threshold' WHEN {STRENGTH} <> 'strong' THEN 'evidence_strength_below_threshold' WHEN flags > 1 THEN 'too_many_conflicts' WHEN flags = 1 AND k % 3 = 0 THEN 'blocking_conflict_flag'
        ELSE 'high_confidence_rule_candidate' END AS reason FROM record WHERE record_id % 10 <> 0)"""),
    "rule_direct_prediction": duck(f"""WITH c AS (SELECT *, [{CODES}] AS codes FROM record), p AS (SELECT *, CASE WHEN k % 50 > 0 THEN truth ELSE codes[list_sort(list_transform(range(1, 9), lambda i: [-(record_id * (i + 2) % 10), (codes[i] = 'TN01_01')::BIGINT, i]))[1][3]] END AS technique FROM c),
        q AS (SELECT *, (record_id * (list_position(codes, technique) + 2) % 10)::DOUBLE AS own FROM p)
        SELECT record_id, technique, split_part(technique, '_', 1) AS stage, round(least(greatest(78e-2 + least(greatest(own - 7, 0) * 15e-3, 7e-2) + least(greatest(margin - 25e-1, 0) * 15e-3, 5e-2)
        + CASE {STRENGTH} WHEN 'strong' THEN 4e-2 WHEN 'weak' THEN -8e-2 ELSE 0e0 END - CASE technique WHEN 'TN01_01' THEN 6e-2 ELSE 0e0 END, 55e-2), 9e-1), 4) AS confidence,
        CASE k % 4 WHEN 0 THEN 'Rule scores favour ' || technique || '.' WHEN 1 THEN event_type ELSE event_type || '; seen twice' END AS reason FROM q"""),
    "merge_shards": duck("SELECT record_id % 1000 AS record_id, record_id % 7 AS shard, record_id AS attempt, plain_guess FROM record QUALIFY row_number() OVER (PARTITION BY record_id % 1000 ORDER BY record_id % 7 DESC, record_id DESC) = 1"),
    "parse_predictions": duck("""WITH a AS (SELECT record_id, k, level, CASE k % 9 WHEN 0 THEN 'NONE' WHEN 1 THEN NULL ELSE truth END AS code FROM record),
        b AS (SELECT *, CASE WHEN k % 4 = 0 THEN 'TA11' WHEN code = 'NONE' THEN 'NONE' ELSE split_part(code, '_', 1) END AS stage, CASE k % 13 WHEN 1 THEN 7124e-4 ELSE CASE level WHEN 'high' THEN 85e-2 WHEN 'medium' THEN 6e-1 ELSE 35e-2 END END AS sure FROM a),
        c AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'many_objects' WHEN k % 5 = 1 THEN 'no_object' WHEN coalesce(stage, 'NONE') = 'NONE' THEN 'bad_stage' WHEN code = 'NONE' THEN 'unknown_code' WHEN k % 7 = 0 THEN 'no_reason' WHEN k % 13 IN (0, 2) THEN 'bad_confidence' END AS error FROM b)
        SELECT record_id, CASE WHEN error IS NULL THEN stage END AS stage, CASE WHEN error IS NULL THEN code END AS technique, CASE WHEN error IS NULL THEN coalesce(split_part(code, '_', 1) = stage, true) END AS consistent, CASE WHEN error IS NULL THEN sure END AS confidence, CASE WHEN error IS NULL THEN 'seen in flow' END AS reason, error FROM c"""),
    "attach_context": duck("""WITH f AS (SELECT capture_id, min(session_id)::DOUBLE AS t, arg_min(src_ip, session_id) AS s FROM flow GROUP BY ALL),
        w AS (SELECT session_id AS i, flow.capture_id AS own, src_ip AS ip, CASE WHEN session_id % 9 = 0 THEN 'gone' WHEN session_id % 6 <> 1 THEN flow.capture_id END AS capture_id, CASE WHEN session_id % 4 = 0 THEN 5e0 END AS start, CASE WHEN session_id % 5 = 0 THEN 'own.pcap' END AS name FROM flow),
        j AS (SELECT w.*, f.t, f.s, i % 3 <> 0 AS found FROM w LEFT JOIN f USING (capture_id))
        SELECT CASE WHEN found THEN i ELSE i + 10000000 END AS record_id, CASE WHEN found THEN coalesce(capture_id, own) ELSE capture_id END AS capture_id, coalesce(start, CASE WHEN found THEN i ELSE t END)::DOUBLE AS start_time, CASE WHEN found THEN ip ELSE s END AS src_ip,
          CASE WHEN found THEN 'record' WHEN t IS NOT NULL THEN 'capture' ELSE 'none' END AS context, coalesce(name, nullif(CASE WHEN found THEN coalesce(capture_id, own) ELSE capture_id END, 'gone') || '.pcap') AS file_name FROM j"""),
    "representative_endpoint": duck("""WITH w AS (SELECT *, CASE WHEN technique = 'TA43_01' THEN 'scan' WHEN technique = 'TN01_01' THEN 'benign' ELSE 'session' END AS wanted FROM (CAPS)),
        e AS (SELECT ends.*, wanted, CASE WHEN src_ip = '1.1.1.1' THEN -120 WHEN src_ip = 'multiple' THEN -20 ELSE 45 END + CASE WHEN dst_ip = '2.2.2.2' THEN -120 WHEN dst_ip IS NULL THEN -20 WHEN dst_ip = 'host' THEN 5 ELSE 45 END
            + CASE WHEN src_port = 'multiple' THEN -4 ELSE 12 END + CASE WHEN dst_port IS NULL THEN -8 WHEN contains(dst_port, ',') THEN CASE WHEN wanted = 'scan' THEN 8 ELSE 2 END ELSE 12 END + CASE WHEN start_time IS NULL THEN 0 ELSE 4 END + CASE WHEN end_time IS NULL THEN 0 ELSE 4 END
            - CASE WHEN src_ip = '1.1.1.1' AND dst_ip = '2.2.2.2' THEN 80 ELSE 0 END AS endpoint_score
            FROM (ENDS) ends JOIN (SELECT capture_id, wanted FROM w) USING (capture_id) WHERE kind = wanted OR (wanted = 'scan' AND kind = 'session')),
        b AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY capture_id ORDER BY kind <> wanted, endpoint_score DESC, place) = 1)
        SELECT w.capture_id, technique, kind, place, endpoint_score, coalesce(b.src_ip, w.src_ip) AS src_ip, coalesce(b.dst_ip, w.dst_ip) AS dst_ip, CASE WHEN wanted_scan AND ports <> '' THEN ports ELSE coalesce(b.dst_port, w.dst_port) END AS dst_port
        FROM (SELECT *, wanted = 'scan' AS wanted_scan FROM w) w LEFT JOIN b USING (capture_id)""".replace("(CAPS)", f"({CAPS})").replace("(ENDS)", f"({ENDS})")),
    "submission_rows": duck(f"""WITH sent AS ({SENT}), given AS ({GIVEN}), j AS (SELECT sent.*, t.number AS n, t.start AS s, t.src_ip AS a, t.src_port AS p FROM sent LEFT JOIN given t ON lower(t.key) IN ('file' || (record_id % 50) || '.pcap', 'file' || (record_id % 50)))
        SELECT record_id, coalesce(n, record_id::VARCHAR) AS number, coalesce(s, strftime(make_timestamp((start_time + 28800) * 1000000), '%Y-%m-%d %H:%M:%S')) AS start, CASE WHEN n IS NULL THEN coalesce(strftime(make_timestamp((end_time + 28800) * 1000000), '%Y-%m-%d %H:%M:%S'), '') ELSE '' END AS end,
        coalesce(a, src_ip) AS src_ip, coalesce(p, src_port)::VARCHAR AS src_port, CASE WHEN n IS NULL AND dst_ip IS NOT NULL THEN '8.8.8.8' ELSE '' END AS dst_ip, CASE WHEN n IS NULL THEN '80' ELSE '' END AS dst_port, split_part(technique, '_', 1) AS label, 'seen in flow token=[REDACTED], API-key=[REDACTED] here' AS reason FROM j"""),
    "conflict_cases": duck("SELECT * FROM (SELECT record_id, concat_ws(',', CASE WHEN plain_guess <> 'TN01_01' AND flags = 1 THEN 'attack_with_benign' END, CASE WHEN plain_guess <> truth THEN 'differs_from_rule' END, CASE WHEN plain_guess = 'TN01_01' AND score >= 3 THEN 'normal_with_attack' END) AS conflicts FROM record) WHERE conflicts <> ''"),
    "prompt_text": duck(f"""{_RETRIEVED}, cut AS (SELECT query_id AS record_id, rank, pinned, CASE WHEN length(text) > 550 THEN left(text, 536) || '...[truncated]' ELSE text END AS t FROM ranked JOIN documents ON doc_id = chunk_id WHERE text IS NOT NULL),
        r AS (SELECT item_id AS record_id, CASE WHEN length(text) > 1800 THEN left(text, 1786) || '...[truncated]' ELSE coalesce(text, '') END AS body, CASE WHEN item_id % 3 = 0 THEN 'Candidates of ' || item_id END AS ctx FROM benchmark),
        x AS (SELECT *, 21 + coalesce(length(ctx) + 1, 0) AS fixed FROM r), sn AS (SELECT cut.*, pinned OR fixed + sum(length(t) + 1) OVER (PARTITION BY record_id ORDER BY pinned DESC, rank ROWS UNBOUNDED PRECEDING) + length(body) <= 2200 AS kept FROM cut JOIN x USING (record_id)),
        p AS (SELECT record_id, string_agg(t, chr(10) ORDER BY pinned DESC, rank) FILTER (kept) AS t, count(*) FILTER (kept) AS n, count(*) AS m FROM sn GROUP BY record_id),
        y AS (SELECT x.*, t, n, coalesce(m, 0) AS m, greatest(2200 - fixed - coalesce(length(t) + 1, 0), 450) AS room FROM x LEFT JOIN p USING (record_id)),
        z AS (SELECT * REPLACE (CASE WHEN length(body) > room THEN left(body, room - 14) || '...[truncated]' ELSE body END AS body), length(body) > room AS shortened FROM y),
        u AS (SELECT * REPLACE (CASE WHEN fixed + coalesce(length(t) + 1, 0) + length(body) <= 2200 THEN t END AS t) FROM z),
        v AS (SELECT *, ctx IS NOT NULL AND fixed + coalesce(length(t) + 1, 0) + length(body) > 2200 AS context_dropped, CASE WHEN t IS NOT NULL THEN n ELSE 0 END AS used FROM u)
        SELECT *, length(prompt) > 2200 AS over, (length(prompt) + 2) // 3 AS tokens FROM (SELECT record_id, concat_ws(chr(10), 'Classify the record.', CASE WHEN NOT context_dropped THEN ctx END, t, body) AS prompt, used, m - used AS dropped, shortened, context_dropped FROM v)"""),
    "match_answers": duck(f"{_MATCHED} SELECT * FROM matched"),
    "unmatched_rows": duck(f"{_MATCHED} SELECT 'answer' AS side, i AS id, 'no unique prediction match' AS reason FROM a4 UNION ALL SELECT 'prediction', i, 'unused prediction row' FROM p4"),
    "confusion_grid": duck("SELECT e.s AS expected, p.s AS predicted, (SELECT count(*) FROM record WHERE split_part(truth, '_', 1) = e.s AND split_part(plain_guess, '_', 1) = p.s) AS n FROM (VALUES ('TA43'), ('TA01'), ('TA03'), ('TA11'), ('TN01')) e(s), (VALUES ('TA43'), ('TA01'), ('TA03'), ('TA11'), ('TN01')) p(s)"),
    "overall_metrics": duck("""WITH p AS (SELECT truth, plain_guess AS guess, split_part(truth, '_', 1) AS t, split_part(plain_guess, '_', 1) AS g FROM record),
        f AS (SELECT v.s, CASE WHEN count(*) FILTER (t = v.s) + count(*) FILTER (g = v.s) > 0 THEN round(2 * count(*) FILTER (t = v.s AND g = v.s) / (count(*) FILTER (t = v.s) + count(*) FILTER (g = v.s)), 4) ELSE 0 END AS f1 FROM p, (VALUES ('TA43'), ('TA01'), ('TA03'), ('TA11'), ('TN01')) v(s) GROUP BY v.s)
        SELECT count(*) AS n, round(avg((t = g)::INT), 4) AS stage_accuracy, round(avg((truth = guess)::INT), 4) AS technique_accuracy, round(avg(((t = 'TN01') = (g = 'TN01'))::INT), 4) AS normal_vs_attack, round(avg((t = g)::INT) FILTER (t = 'TN01'), 4) AS normal_accuracy,
        round(avg((t = g)::INT) FILTER (t <> 'TN01'), 4) AS attack_accuracy, (SELECT round(avg(f1), 4) FROM f) AS macro_f1 FROM p"""),
    "stage_metrics": duck("""WITH p AS (SELECT split_part(truth, '_', 1) AS t, split_part(plain_guess, '_', 1) AS g FROM record), s AS (SELECT stage, count(*) FILTER (t = stage) AS support, count(*) FILTER (g = stage) AS predicted, count(*) FILTER (t = stage AND g = stage) AS correct FROM p, (VALUES ('TA43'), ('TA01'), ('TA03'), ('TA11'), ('TN01')) v(stage) GROUP BY stage),
        r AS (SELECT *, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN correct / support ELSE 0 END AS r FROM s) SELECT stage, support, predicted, correct, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1 FROM r"""),
    "paired_effect": duck("SELECT record_id, CASE WHEN context_guess = truth AND plain_guess <> truth THEN 'helpful' WHEN plain_guess = truth AND context_guess <> truth THEN 'harmful' WHEN plain_guess = truth THEN 'both_right' ELSE 'both_wrong' END AS effect, plain_guess = context_guess AS agree FROM record"),
    "scope_metrics": duck("SELECT scope, count(*) AS n, count(*) FILTER (ok) AS correct, round(avg(ok::INT), 4) AS accuracy FROM (SELECT unnest(list_filter(['all', CASE WHEN truth <> 'TN01_01' THEN 'attack' END, CASE WHEN score >= 5 THEN 'scored' END, CASE WHEN flags = 0 THEN 'clean' END], lambda x: x IS NOT NULL)) AS scope, truth = plain_guess AS ok FROM record) GROUP BY scope"),
    "run_cost": duck("""SELECT s.* EXCLUDE (total), retry, round((tokens_in * 3e-1 + tokens_out * 24e-1) / 1e6 * (1 + retry), 6) AS cost, round(calls / total, 4) AS throughput, round(calls * mean_latency / 86400, 4) AS serial_days FROM (SELECT level AS mode, count(*) AS calls, sum(record_id % 997 / 100) AS total, sum(1000 + k)::BIGINT AS tokens_in, sum(50 + flags)::BIGINT AS tokens_out, round(avg(record_id % 997 / 100), 3) AS mean_latency,
        round(list_sort(list(record_id % 997 / 100))[greatest(floor(95e-2 * count(*))::INT - 1, 0) + 1], 3) AS p95_latency FROM record GROUP BY level) s, (VALUES (0e0), (1e-1), (2e-1)) v(retry)"""),
    "layer_retention": duck(" UNION ALL ".join(f"SELECT '{n}' AS layer, '{e}' AS evidence, count(*) AS rows, count(*) FILTER ({t}) AS with_evidence FROM flow WHERE {w}" for n, w in (("sessions", "true"), ("records", "k > 30")) for e, t in (("http", "dst_port = 80"), ("tls", "dst_port = 443"), ("failed", FAILED)))),
    "majority_flow_label": duck("""WITH f AS (SELECT session_id, src_ip AS a, src_port % 5 AS ap, dst_ip AS b, dst_port AS bp, event_type AS l, k FROM flow), lab AS (SELECT a, ap, b, bp, l FROM f WHERE k % 3 = 0 UNION ALL SELECT b, bp, a, ap, l FROM f WHERE k % 3 = 1), both_ways AS (SELECT * FROM lab UNION ALL SELECT b, bp, a, ap, l FROM lab),
        c0 AS (SELECT a, ap, b, bp, l, count(*) AS n FROM both_ways GROUP BY ALL), c AS (SELECT * FROM c0 QUALIFY row_number() OVER (PARTITION BY a, ap, b, bp ORDER BY n DESC, l) = 1) SELECT session_id, c.l AS flow_label, coalesce(n, 0) AS label_rows FROM f LEFT JOIN c USING (a, ap, b, bp)"""),
    "endpoint_label_join": f"""SELECT src_ip, dst_ip, dst_port, proto, connections, beacon_score AS score, labels FROM ({duck(BEACON, flow=f"SELECT * REPLACE ('all' AS capture_id) FROM ({FLOW})", signal=SIGNAL)}) b
        JOIN ({duck("SELECT src_ip, dst_ip, dst_port, proto, count(*) AS labels FROM flow WHERE event_type <> 'click' GROUP BY ALL")}) l USING (src_ip, dst_ip, dst_port, proto) WHERE connections >= 5 AND beacon_score >= 0.3 AND labels >= 5""",
    "refresh_records": duck("SELECT record_id, CASE WHEN flags <> 0 AND k > 40 THEN truth ELSE event_type END AS evidence, flags <> 0 AND k > 40 AS refreshed FROM record"),
    "boundary_rule_join": duck(f"""WITH codes AS (SELECT unnest([{CODES}]) AS c, generate_subscripts([{CODES}], 1) AS o), rl AS (SELECT row_number() OVER (ORDER BY x.o, y.o)::INT - 1 AS rule_id, x.c AS a, y.c AS b FROM codes x JOIN codes y ON x.c < y.c),
        m AS (SELECT record_id, rule_id, list_contains([truth, plain_guess, context_guess], a)::INT + list_contains([truth, plain_guess, context_guess], b)::INT AS n FROM record, rl) SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY n >= 2 DESC, rule_id) AS place, rule_id, n::BIGINT AS n FROM m WHERE n >= 1 QUALIFY place <= 6"""),
    "label_counts": duck("SELECT truth, level, count(*) AS rows FROM record WHERE truth <> 'TA03_01' GROUP BY ALL UNION ALL SELECT 'TA03_01', NULL, 0"),
    "confidence_tier": duck(f"SELECT record_id, {_TIER} AS tier FROM record"),
    "row_checks": duck("""WITH r AS (SELECT record_id - CASE WHEN record_id % 50 = 7 THEN 1 ELSE 0 END AS record_id, k FROM record) SELECT record_id, 'missing_event_type' AS problem FROM r WHERE k % 20 = 0 UNION ALL SELECT record_id, 'illegal_code' FROM r WHERE k = 33 UNION ALL SELECT record_id, 'duplicate_id' FROM r GROUP BY record_id HAVING count(*) > 1"""),
    "coverage_split": duck("SELECT record_id, truth, row_number() OVER (PARTITION BY truth ORDER BY CASE level WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, record_id) AS place FROM record QUALIFY place <= 20"),
    "tiered_fill": duck(f"WITH t AS (SELECT record_id, truth, {_TIER} AS tier FROM record), r AS (SELECT * FROM t WHERE tier <> 'weak' QUALIFY row_number() OVER (PARTITION BY truth ORDER BY CASE tier WHEN 'strict' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, record_id) <= 30) SELECT *, count(*) OVER (PARTITION BY truth) < 30 AS short FROM r"),
    "round_robin_sample": duck("SELECT record_id, truth, place FROM (SELECT *, row_number() OVER (PARTITION BY truth ORDER BY record_id) AS place FROM record) ORDER BY place, truth LIMIT 60"),
    "heuristic_top_sets": duck("WITH a AS (SELECT record_id FROM record ORDER BY score DESC, record_id LIMIT 45), b AS (SELECT record_id FROM record WHERE record_id NOT IN (SELECT record_id FROM a) ORDER BY value DESC, record_id LIMIT 45) SELECT record_id, 'score' AS chosen_by FROM a UNION ALL SELECT record_id, 'value' FROM b"),
    "best_per_label": duck("SELECT record_id, truth, value AS score FROM (SELECT * FROM record QUALIFY row_number() OVER (PARTITION BY truth ORDER BY value DESC, record_id) = 1) ORDER BY value DESC, record_id LIMIT 5"),
    "pseudonymize_ids": duck("WITH c AS (SELECT capture_id, 'capture_' || row_number() OVER (ORDER BY min(record_id)) AS capture_alias FROM record GROUP BY capture_id) SELECT record_id, capture_alias, capture_alias || '_record_' || row_number() OVER (PARTITION BY capture_id ORDER BY record_id) AS record_alias FROM record JOIN c USING (capture_id)"),
    "group_safe_split": duck("SELECT record_id, CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'valid' ELSE 'test' END AS split FROM (SELECT record_id, (substr(capture_id, 4)::INT * 37 + 11) % 100 AS b FROM record WHERE k <> 1)"),
    "capped_rows": duck("SELECT session_id FROM flow ORDER BY capture_id, start_time NULLS LAST, session_id LIMIT 500"),
    "parse_quality": duck("SELECT record_id FROM record WHERE k % 4 = 0 OR NOT (flags > 1 OR k % 3 = 0)"),
    "header_alias": duck("SELECT capture_id AS pcap, record_id AS number, truth AS technique FROM record"),
    "redact_log_columns": duck("SELECT session_id, '/a?token=[REDACTED]&x=1' AS uri, CASE WHEN k % 2 = 0 THEN '-' ELSE '[REDACTED]' END AS username, CASE WHEN k % 3 = 0 THEN 'PASS' ELSE 'LIST' END AS command, CASE WHEN k % 3 = 0 THEN '[REDACTED]' ELSE 'arg' END AS arg FROM flow"),
    "discover_captures": duck("""WITH p AS (SELECT DISTINCT capture_id || '__u' || user_id AS capture_id, ['/zeek/', '/', '/logs/'][k % 3 + 1] AS f, ['ssl', 'tls', 'conn'][session_id % 3 + 1] AS n, k % 3 AS o, capture_id || '/u' || user_id AS c FROM flow)
        SELECT capture_id, CASE n WHEN 'ssl' THEN 'tls' ELSE n END AS log, '/in/captures/' || c || f || n || '.log' AS path FROM p QUALIFY row_number() OVER (PARTITION BY capture_id, CASE n WHEN 'ssl' THEN 'tls' ELSE n END ORDER BY o, n = 'tls') = 1"""),
}
