"""Queries of scalar functions, session context and behaviour groups, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aggregates as A
from ..functions import text as X
from ..functions import values as V
from ..operators import context as C
from ..operators import groups as G
from .views import chunks, duck, flow, pages, visible, wide

DAY = 86400.0
FAILED = "conn_state IN ('S0', 'REJ', 'RSTOS0', 'RSTRH', 'SH', 'SHR')"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def safe_number(spark, d):
    raw = F.when(F.col("k") % 7 == 0, "-").when(F.col("k") % 7 == 1, "").when(F.col("k") % 7 == 2, "n/a").otherwise(F.concat(F.col("k").cast("string"), F.lit(".75")))
    return flow(spark, d).select("session_id", V.safe_number(raw).alias("number"), V.safe_long(raw).alias("whole"))


def canonical_key(spark, d):
    return flow(spark, d).select("session_id", V.canonical_key(F.col("src_ip"), F.col("src_port"), F.col("dst_ip"), F.col("dst_port"), F.col("proto")).alias("key"))


def traffic_rates(spark, d):
    size = F.col("orig_bytes") + F.col("resp_bytes")
    return flow(spark, d).select("session_id", V.safe_rate(size, F.col("duration")).alias("rate"))


def uri_path(spark, d):
    return pages(spark, d).select("page_id", V.uri_path(F.col("url")).alias("path"))


def packet_protocol(spark, d):
    tcp, udp = F.when(F.col("k") % 3 == 0, F.col("dst_port")), F.when(F.col("k") % 3 == 1, F.col("dst_port"))
    name = F.when(F.col("k") % 5 == 0, "TLS").when(F.col("k") % 5 == 1, "dns").otherwise("icmp")
    return flow(spark, d).select("session_id", V.packet_protocol(name, tcp, udp).alias("protocol"))


def redact_text(spark, d):
    return _docs(spark, d).select("doc_id", X.redact_sensitive_text(F.col("text"), 4000).alias("clean"))


def decode_text(spark, d):
    return pages(spark, d).select("page_id", X.decode_visible_text(F.col("url")).alias("decoded"))


def context_snippets(spark, d):
    return pages(spark, d).select("page_id", X.suspicious_contexts(F.col("html")).alias("snippets"))


def match_signatures(spark, d):
    return pages(spark, d).select("page_id", F.array_join(X.match_signatures(F.concat_ws(" ", "url", "html")), ",").alias("names"))


def match_probe_lists(spark, d):
    return pages(spark, d).select("page_id", *X.match_lists(F.col("url")))


def external_direction(spark, d):
    return flow(spark, d).select("session_id", V.client_initiated_external(F.col("src_ip"), F.col("dst_ip")).alias("external"), V.is_private(F.col("dst_ip")).alias("dst_private"))


def tokenize(spark, d):
    return _docs(spark, d).select("doc_id", F.explode(V.tokenize(F.col("text"))).alias("token")).groupBy("doc_id").agg(F.count("*").alias("tokens"), F.countDistinct("token").alias("different"))


def word_count(spark, d):
    return _docs(spark, d).select("doc_id", V.word_count(F.col("text")).cast("long").alias("words"))


def estimate_tokens(spark, d):
    return _docs(spark, d).select("doc_id", V.estimate_tokens(F.col("text")).alias("tokens"))


def trim_value(spark, d):
    return _docs(spark, d).select("doc_id", V.trim_value(F.col("text"), 120).alias("trimmed"), V.compact_text(F.col("text"), 80).alias("compact"))


def any_positive(spark, d):
    rows = flow(spark, d).select("session_id", F.struct((F.col("k") % 5 == 0).alias("hit"), (F.col("k") % 4).alias("n"), F.when(F.col("k") % 3 == 0, "none").otherwise("x").alias("word")).alias("flags"))
    fields = {"hit": "boolean", "n": "int", "word": "string"}
    return rows.select("session_id", *(V.any_positive(fields, F.col("flags"), v).alias(v) for v in ("session", "group", "capture")))


def normalize_label(spark, d):
    names = F.element_at(F.array(*(F.lit(x) for x in ("端口扫描", " Normal ", "ta01.02", "TA11-01", "unknown", "木马回连"))), (F.col("k") % 6 + 1).cast("int"))
    code = V.normalize_label(names)
    return flow(spark, d).select("session_id", code.alias("technique"), V.stage_of(code).alias("stage"))


def format_epoch(spark, d):
    raw = F.when(F.col("k") % 4 == 0, F.lit("not known")).when(F.col("k") % 4 == 1, F.col("k").cast("string")).otherwise(F.concat((F.lit(1312967328) + F.col("session_id")).cast("string"), F.lit(".17")))
    return flow(spark, d).select("session_id", V.format_epoch(raw, "Asia/Shanghai").alias("shown"))


def file_key(spark, d):
    path = F.concat(F.lit("C:\\In\\"), F.col("url"))
    return pages(spark, d).select("page_id", V.file_key(path).alias("name"), V.file_stem(path).alias("stem"))


def leak_check(spark, d):
    return _docs(spark, d).where(V.leaks(F.col("text"), ("token =", "password", "license"))).select("doc_id")


def source_context(spark, d):
    return C.source_context(flow(spark, d)).select("session_id", "same_src_connections", "same_src_unique_dst_ports", "same_src_unique_dst_ips", "same_src_failed_conn_rate")


def source_context_wide(spark, d):
    out = C.source_context(wide(spark, d))
    return out.groupBy("capture_id", "src_ip", "same_src_connections", "same_src_unique_dst_ports", "same_src_unique_dst_ips", "same_src_failed_conn_rate").agg(F.count("*").alias("rows"))


def destination_context(spark, d):
    return C.destination_context(flow(spark, d)).select("session_id", "same_dst_unique_sources", "same_endpoint_sessions")


#: Names, visible text and competing flags of some sessions, for both engines.
SIGNAL = """
SELECT *, split(CASE WHEN k % 3 = 0 THEN CONCAT('q', CAST(k % 2 AS STRING)) WHEN k % 3 = 1 THEN 'a,a,b' END, ',') AS dns_queries, split(CASE WHEN dst_port = 443 THEN CONCAT('sni', CAST(session_id % 7 AS STRING)) END, ',') AS server_names,
       CASE WHEN k = 61 OR k = 3 THEN '/Heartbeat' WHEN k % 10 = 2 THEN 'host update' WHEN k % 2 = 0 THEN '/index' END AS app_text, k = 1 OR k = 71 AS exploit, k % 50 = 2 AS auth
FROM flow
"""


def _signals(spark, d):
    return spark.sql(SIGNAL.replace("FROM flow", "FROM {flow}"), flow=flow(spark, d))


def endpoint_beacon(spark, d):
    return C.endpoint_beacon(_signals(spark, d))


def pair_context(spark, d):
    return C.pair_context(pages(spark, d).withColumn("uri_path", V.uri_path(F.col("url"))))


def capture_summary(spark, d):
    return C.capture_summary(flow(spark, d))


def session_number(spark, d):
    return C.number_sessions(flow(spark, d)).select("session_id", "capture_id", "session_no")


def numeric_pattern(spark, d):
    return A.numeric_pattern(flow(spark, d), ["capture_id", "src_ip"], "orig_bytes")


def burstiness(spark, d):
    gaps = A.numeric_pattern(G.start_intervals(flow(spark, d), G.AUTH_KEYS), G.AUTH_KEYS, "interval")
    return gaps.select(*G.AUTH_KEYS, A.burstiness(F.col("mean"), F.col("std"), F.col("count")).alias("burstiness"))


def top_values(spark, d):
    return A.top_values(flow(spark, d), ["capture_id"], "dst_port", "session_id", 5)


def bounded_distinct(spark, d):
    out = A.bounded_distinct(flow(spark, d).withColumn("port", F.col("dst_port").cast("string")), ["capture_id", "src_ip"], "port", "session_id", 5)
    return out.select("capture_id", "src_ip", F.array_join("values", ",").alias("ports"))


def start_intervals(spark, d):
    return G.start_intervals(flow(spark, d), ["capture_id", "src_ip", "dst_ip"]).select("session_id", F.round("interval", 3).alias("interval"))


def _candidates(spark, d):
    return G.scan_candidates(C.source_context(flow(spark, d)), min_failed_rate=0.2)


def scan_candidate(spark, d):
    return _candidates(spark, d).select("session_id", "same_src_unique_dst_ports", "same_src_failed_conn_rate")


def _episodes(spark, d):
    return G.scan_episodes(_candidates(spark, d), 2 * DAY, 3, 3)


def scan_episodes(spark, d):
    return _episodes(spark, d).select("session_id", F.round("episode_start", 3).alias("episode_start"))


def scan_group(spark, d):
    return G.scan_groups(_episodes(spark, d)).select(*G.SCAN_KEYS, F.round("episode_start", 3).alias("episode_start"), "probe_count", "unique_dst_ports", "failed_rate", "scan_duration", "probe_rate")


def uncovered_sessions(spark, d):
    return G.uncovered_sessions(flow(spark, d), _episodes(spark, d)).select("session_id")


def classification_records(spark, d):
    rows = _signals(spark, d)
    out = G.classification_records(rows, _episodes(spark, d), G.auth_groups(rows, 5 * DAY, 2), G.callback_groups(rows), 5 * DAY)
    return out.select("record_id", "record_type", "capture_id", "src_ip", "dst_ip", F.round("start_time", 3).alias("start_time"), "sessions")


def auth_episodes(spark, d):
    return G.gap_episodes(flow(spark, d), G.AUTH_KEYS, 5 * DAY).select("session_id", F.col("episode").cast("long").alias("episode"))


def auth_group(spark, d):
    out = G.auth_groups(flow(spark, d), 5 * DAY, 2)
    return out.select(*G.LOGIN_KEYS, F.col("episode").cast("long").alias("episode"), "sessions", "attempts", "failures", "failure_rate", "attempt_rate", "tier")


def callback_group(spark, d):
    return G.callback_groups(_signals(spark, d)).withColumns({c: F.round(c, 3) for c in ("start_time", "end_time")})


QUERIES = {f.__name__: f for f in (
    safe_number, canonical_key, packet_protocol, traffic_rates, uri_path, redact_text, decode_text, context_snippets, match_signatures, match_probe_lists, external_direction,
    tokenize, word_count, estimate_tokens, trim_value, any_positive, normalize_label, format_epoch, file_key, leak_check, source_context, source_context_wide, destination_context,
    endpoint_beacon, pair_context, capture_summary, session_number, numeric_pattern, burstiness, top_values, bounded_distinct, start_intervals, scan_candidate, scan_episodes,
    scan_group, uncovered_sessions, classification_records, auth_episodes, auth_group, callback_group,
)}

_SOURCE = f"""src AS (SELECT capture_id, src_ip, count(*) AS same_src_connections, count(DISTINCT dst_port) AS same_src_unique_dst_ports, count(DISTINCT dst_ip) AS same_src_unique_dst_ips,
    round(avg(CASE WHEN {FAILED} THEN 1e0 ELSE 0e0 END), 4) AS same_src_failed_conn_rate FROM flow GROUP BY ALL)"""
_CAND = f"""{_SOURCE}, cand AS (SELECT flow.*, same_src_unique_dst_ports, same_src_failed_conn_rate FROM flow JOIN src USING (capture_id, src_ip)
    WHERE proto IN ('tcp', 'udp') AND same_src_unique_dst_ports >= 8 AND same_src_failed_conn_rate >= 0.2 AND (duration IS NULL OR duration <= 5) AND coalesce(orig_bytes, 0) + coalesce(resp_bytes, 0) <= 2000)"""
_EPISODES = f"""WITH RECURSIVE {_CAND}, anchor AS (
    SELECT capture_id, src_ip, dst_ip, proto, min(start_time) AS a FROM cand GROUP BY ALL
    UNION ALL
    SELECT capture_id, src_ip, dst_ip, proto, n FROM (SELECT p.capture_id, p.src_ip, p.dst_ip, p.proto, (SELECT min(start_time) FROM cand c WHERE c.capture_id = p.capture_id AND c.src_ip = p.src_ip AND c.dst_ip = p.dst_ip AND c.proto = p.proto AND c.start_time > p.a + 172800) AS n FROM anchor p) WHERE n IS NOT NULL),
    placed AS (SELECT c.*, coalesce((SELECT max(a) FROM anchor p WHERE c.capture_id = p.capture_id AND c.src_ip = p.src_ip AND c.dst_ip = p.dst_ip AND c.proto = p.proto AND p.a <= c.start_time),
        (SELECT max(a) FROM anchor p WHERE c.capture_id = p.capture_id AND c.src_ip = p.src_ip AND c.dst_ip = p.dst_ip AND c.proto = p.proto)) AS episode_start FROM cand c),
    kept AS (SELECT * FROM placed QUALIFY count(*) OVER (PARTITION BY capture_id, src_ip, dst_ip, proto, episode_start) >= 3 AND count(DISTINCT coalesce(dst_port, -1)) OVER (PARTITION BY capture_id, src_ip, dst_ip, proto, episode_start) >= 3)"""
_GROUPS = f"""{_EPISODES}, grp AS (SELECT capture_id, src_ip, dst_ip, proto, episode_start, count(*) AS probe_count, count(DISTINCT dst_port) AS unique_dst_ports,
    round(avg(CASE WHEN {FAILED} THEN 1e0 ELSE 0e0 END), 4) AS failed_rate, min(start_time) AS start_time, max(start_time) AS end_time FROM kept GROUP BY ALL)"""
_AUTH = "capture_id, src_ip, dst_ip, dst_port, proto"
_GAPS = f"gap AS (SELECT *, start_time - lag(start_time) OVER (PARTITION BY {_AUTH} ORDER BY start_time NULLS LAST, session_id) AS g FROM flow)"
_PATTERN = "count(*) AS count, round(min(v), 3) AS min, round(quantile_cont(v, 0.5), 3) AS median, round(avg(v), 3) AS mean, CASE WHEN count(*) > 1 THEN round(stddev_pop(v), 3) END AS std, round(list_sort(list(v))[floor(0.9 * (count(*) - 1))::INT + 1], 3) AS p90, round(max(v), 3) AS max, CASE WHEN count(*) > 1 AND avg(v) > 0 THEN round(stddev_pop(v) / avg(v), 3) END AS cv"
_RE = lambda p: p.replace("'", "''")
_USUAL = str(C.USUAL_PORTS)
_REPEATS = """rep AS (SELECT capture_id, src_ip, dst_ip, dst_port, proto, coalesce(sum(n) FILTER (kind = 'dns') >= 3 AND max(n) FILTER (kind = 'dns') > 1, false) AS repeated_dns, coalesce(sum(n) FILTER (kind = 'sni') >= 3 AND max(n) FILTER (kind = 'sni') > 1, false) AS repeated_sni FROM
    (SELECT capture_id, src_ip, dst_ip, dst_port, proto, kind, v, count(*) AS n FROM (SELECT *, 'dns' AS kind, unnest(dns_queries) AS v FROM signal UNION ALL SELECT *, 'sni', unnest(server_names) FROM signal) GROUP BY ALL) GROUP BY ALL)"""
_HINTS = "dst_port IN (53, 80, 123, 443) AS common_service_port, upd AS update_or_telemetry_text, dst_port = 53 AND repeated_dns AS dns_refresh_like, proto = 'udp' AND dst_port = 123 AS ntp_like"
_SAID = "coalesce(bool_or(regexp_matches(lower(app_text), '{0}')), false)".format
_WORDS = f"{_SAID(C.CALLBACK_WORDS)} AS callback_text, {_SAID(C.UPDATE_WORDS)} AS upd"
_EPISODE_NO = f"""ep AS (SELECT *, sum(CASE WHEN g > 432000 THEN 1 ELSE 0 END) OVER (PARTITION BY {_AUTH} ORDER BY start_time NULLS LAST, session_id ROWS UNBOUNDED PRECEDING)::BIGINT AS episode FROM gap)"""

BEACON = f"""WITH {_REPEATS}, {_GAPS.replace('FROM flow', 'FROM signal')}, s AS (SELECT {_AUTH}, count(*) AS connections, count(CASE WHEN g >= 0 THEN g END) AS intervals, avg(CASE WHEN g >= 0 THEN g END) AS m, quantile_cont(CASE WHEN g >= 0 THEN g END, 0.5) AS med,
        stddev_pop(CASE WHEN g >= 0 THEN g END) AS sd, max(coalesce(orig_bytes, 0) + coalesce(resp_bytes, 0)) AS max_bytes, round(coalesce(max(start_time) - min(start_time), 0), 3) AS fixed_endpoint_duration, coalesce(bool_or(duration >= 300), false) AS long_lived, {_WORDS} FROM gap GROUP BY {_AUTH}),
        c AS (SELECT s.*, coalesce(repeated_dns, false) AS repeated_dns, coalesce(repeated_sni, false) AS repeated_sni, CASE WHEN m > 0 AND intervals >= 2 THEN round(sd / m, 6) END AS cv, dst_port NOT IN {_USUAL} AS odd_port, dst_ip NOT LIKE '10.%' AS external, connections >= 4 AND max_bytes <= 4096 AS small_repeated FROM s LEFT JOIN rep USING ({_AUTH})),
        p AS (SELECT *, coalesce(intervals >= 3 AND m >= 1 AND cv <= 0.35, false) AS periodic FROM c)
        SELECT {_AUTH}, connections, intervals, round(m, 3) AS interval_mean, round(med, 3) AS interval_median, CASE WHEN intervals >= 2 THEN round(sd, 3) END AS interval_std, round(cv, 3) AS interval_cv, periodic, odd_port, external, small_repeated, long_lived, repeated_dns, repeated_sni, callback_text, fixed_endpoint_duration, max_bytes,
        round(least(CASE WHEN periodic THEN 35e-2 ELSE 0 END + CASE WHEN connections >= 4 THEN 15e-2 ELSE 0 END + CASE WHEN small_repeated THEN 15e-2 ELSE 0 END + CASE WHEN repeated_dns OR repeated_sni THEN 1e-1 ELSE 0 END + CASE WHEN odd_port THEN 1e-1 ELSE 0 END + CASE WHEN external THEN 1e-1 ELSE 0 END
            + CASE WHEN long_lived THEN 5e-2 ELSE 0 END + CASE WHEN callback_text THEN 2e-1 ELSE 0 END, 1), 3) AS beacon_score, coalesce(round(1 / (1 + cv), 3), 0) AS regularity_score, {_HINTS}, coalesce(med < 1, false) AS short_burst_not_beacon, periodic AND NOT (odd_port OR repeated_dns OR repeated_sni OR callback_text) AS periodicity_alone FROM p"""
_LOGIN = f"""login AS (SELECT *, CASE dst_port WHEN 21 THEN 'ftp' WHEN 22 THEN 'ssh' WHEN 23 THEN 'telnet' WHEN 445 THEN 'smb' WHEN 3389 THEN 'rdp' ELSE 'http' END AS auth_protocol FROM flow WHERE dst_port IN {tuple(G.LOGIN_PROTOCOLS)}),
        {_GAPS.replace('FROM flow', 'FROM login')}, {_EPISODE_NO}, ag AS (SELECT {_AUTH}, auth_protocol, episode, count(*) AS sessions, count(*) AS attempts, count(*) FILTER ({FAILED}) AS failures, round(count(*) FILTER ({FAILED}) / count(*), 4) AS failure_rate,
        CASE WHEN max(start_time) > min(start_time) THEN round(count(*) / (max(start_time) - min(start_time)), 4) END AS attempt_rate, CASE WHEN count(*) >= 5 AND count(*) FILTER ({FAILED}) >= 2 THEN 'high' ELSE 'weak' END AS tier, min(start_time) AS t FROM ep GROUP BY {_AUTH}, auth_protocol, episode HAVING count(*) >= 2)"""
_CALLBACK = f"""{_REPEATS}, cr AS (SELECT *, (coalesce(orig_bytes, 0) + coalesce(resp_bytes, 0))::DOUBLE AS v FROM signal),
        cs AS (SELECT {_AUTH}, round(min(start_time), 3) AS start_time, round(max(start_time), 3) AS end_time, {_WORDS}, concat_ws(',', CASE WHEN bool_or(auth) THEN 'auth' END, CASE WHEN bool_or(exploit) THEN 'exploit' END) AS competing FROM signal GROUP BY {_AUTH}),
        cg AS (SELECT {_AUTH}, start_time - lag(start_time) OVER (PARTITION BY {_AUTH} ORDER BY start_time NULLS LAST, session_id) AS v FROM cr), gp AS (SELECT {_AUTH}, {_PATTERN} FROM cg WHERE v >= 0 GROUP BY {_AUTH}), sp AS (SELECT {_AUTH}, {_PATTERN} FROM cr GROUP BY {_AUTH}),
        b AS (SELECT sp.capture_id, sp.src_ip, sp.dst_ip, sp.dst_port, sp.proto, sp.count AS connections, sp.p90 AS bytes_p90, cs.start_time, end_time, callback_text, upd, competing, gp.count AS intervals, gp.median AS interval_median, gp.mean AS interval_mean, gp.std AS interval_std, gp.cv AS interval_cv,
            coalesce(repeated_dns, false) AS repeated_dns, coalesce(repeated_sni, false) AS repeated_sni, coalesce(round(1 / (1 + gp.cv), 3), 0) AS regularity_score, CASE WHEN gp.median > 0 THEN gp.median ELSE gp.mean END AS scale FROM sp JOIN cs USING ({_AUTH}) LEFT JOIN gp USING ({_AUTH}) LEFT JOIN rep USING ({_AUTH}) WHERE sp.count >= 4),
        p AS (SELECT *, coalesce(intervals >= 3 AND scale >= 1 AND regularity_score >= 0.6, false) AS periodic, CASE WHEN intervals >= 2 THEN CASE WHEN interval_std + interval_mean = 0 THEN 0 ELSE round((interval_std - interval_mean) / (interval_std + interval_mean), 3) END END AS burstiness FROM b),
        sc AS (SELECT *, round(least(25e-2 + CASE WHEN connections >= 10 THEN 15e-2 ELSE 5e-2 END + CASE WHEN periodic THEN 2e-1 ELSE 0 END + CASE WHEN bytes_p90 <= 8192 THEN 15e-2 ELSE 0 END + CASE WHEN dst_port NOT IN {G.COMMON_PORTS} THEN 15e-2 ELSE 0 END
            + CASE WHEN repeated_dns OR repeated_sni THEN 1e-1 ELSE 0 END + CASE WHEN callback_text THEN 15e-2 ELSE 0 END, 1), 3) AS score FROM p),
        cb AS (SELECT * EXCLUDE (upd, scale), CASE WHEN connections >= 5 AND score >= 0.65 AND periodic AND (competing = '' OR callback_text) THEN 'high' ELSE 'medium' END AS tier, {_HINTS}, coalesce(scale > 0 AND scale < 1, false) AS short_burst_not_beacon,
            periodic AND NOT (dst_port NOT IN {G.COMMON_PORTS} OR repeated_dns OR repeated_sni OR callback_text) AS periodicity_alone FROM sc WHERE score >= 0.45)"""

ORACLES = {
    "safe_number": duck("SELECT session_id, CASE WHEN k % 7 > 2 THEN k + 75e-2 END AS number, CASE WHEN k % 7 > 2 THEN k::BIGINT END AS whole FROM flow"),
    "canonical_key": duck("SELECT session_id, CASE WHEN (src_ip, src_port::VARCHAR) <= (dst_ip, dst_port::VARCHAR) THEN src_ip || '|' || src_port || '|' || dst_ip || '|' || dst_port ELSE dst_ip || '|' || dst_port || '|' || src_ip || '|' || src_port END || '|' || proto AS key FROM flow"),
    "packet_protocol": duck("SELECT session_id, CASE WHEN k % 3 = 0 OR k % 5 = 0 THEN 'tcp' WHEN k % 3 = 1 OR k % 5 = 1 THEN 'udp' ELSE 'icmp' END AS protocol FROM flow"),
    "traffic_rates": duck("SELECT session_id, CASE WHEN duration > 0 THEN round((orig_bytes + resp_bytes) / duration, 4) END AS rate FROM flow"),
    "uri_path": duck("SELECT page_id, split_part(split_part(url, '?', 1), '#', 1) AS path FROM page"),
    "redact_text": f"SELECT doc_id, CASE WHEN length(t) > 4000 THEN left(t, 3986) || '...[truncated]' ELSE t END AS clean FROM (SELECT doc_id, regexp_replace(regexp_replace({visible('text')}, '{_RE(X.SECRET)}', '\\1\\2[REDACTED]', 'g'), '{X.JWT}', '[REDACTED_JWT]', 'g') AS t FROM documents)",
    "match_signatures": duck("SELECT page_id, concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(t, '{_RE(p)}') THEN '{n}' END" for n, p in X.SIGNATURES.items()) + ") AS names FROM (SELECT page_id, concat_ws(' ', url, html) AS t FROM page)"),
    "match_probe_lists": duck("SELECT page_id, " + ", ".join(f"regexp_matches(url, '{_RE(p)}') AS {n}" for n, p in X.LISTS.items()) + " FROM page"),
    "external_direction": duck("SELECT session_id, dst_ip NOT LIKE '10.%' AS external, dst_ip LIKE '10.%' AS dst_private FROM flow"),
    "tokenize": r"""SELECT doc_id, count(*) AS tokens, count(DISTINCT token) AS different FROM (SELECT doc_id, trim(t, '.,;()[]{}<>""''') AS token FROM (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[A-Za-z0-9_.:/+-]+|[\x{4e00}-\x{9fff}]+')) AS t FROM documents)) WHERE length(token) >= 2 GROUP BY doc_id""",
    "word_count": r"SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9_.:/+-]+|[\x{4e00}-\x{9fff}]'))::BIGINT AS words FROM documents",
    "estimate_tokens": "SELECT doc_id, (length(text) + 2) // 3 AS tokens FROM documents",
    "trim_value": "SELECT doc_id, CASE WHEN length(text) > 120 THEN left(text, 106) || '...[truncated]' ELSE text END AS trimmed, CASE WHEN length(o) > 80 THEN rtrim(left(o, 79), ' ,.;') || '.' ELSE o END AS compact FROM (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS o FROM documents)",
    "any_positive": duck("SELECT session_id, k % 5 = 0 OR k % 3 <> 0 AS session, k % 5 = 0 AS \"group\", k % 5 = 0 OR k % 3 <> 0 OR k % 4 > 0 AS capture FROM flow"),
    "normalize_label": duck("SELECT session_id, t AS technique, split_part(t, '_', 1) AS stage FROM (SELECT session_id, ['TA43_01', 'TN01_01', 'TA01_02', 'TA11_01', NULL, 'TA11_02'][k % 6 + 1] AS t FROM flow)"),
    "format_epoch": duck("SELECT session_id, CASE k % 4 WHEN 0 THEN 'not known' WHEN 1 THEN k::VARCHAR ELSE strftime(make_timestamp((1312967328 + session_id + 28800) * 1000000), '%Y-%m-%d %H:%M:%S') || '.17' END AS shown FROM flow"),
    "file_key": duck("SELECT page_id, n AS name, CASE WHEN n LIKE '_%.%' THEN regexp_replace(n, '(.)\\.[^.]*$', '\\1') ELSE n END AS stem FROM (SELECT page_id, lower(list_last(string_split(url, '/'))) AS n FROM page)"),
    "leak_check": "SELECT doc_id FROM documents WHERE regexp_matches(lower(text), 'token =|password|license')",
    "source_context": duck(f"WITH {_SOURCE} SELECT session_id, src.* EXCLUDE (capture_id, src_ip) FROM flow JOIN src USING (capture_id, src_ip)"),
    "source_context_wide": duck(f"SELECT capture_id, src_ip, count(*) AS same_src_connections, count(DISTINCT dst_port) AS same_src_unique_dst_ports, count(DISTINCT dst_ip) AS same_src_unique_dst_ips, round(avg(CASE WHEN {FAILED} THEN 1e0 ELSE 0e0 END), 4) AS same_src_failed_conn_rate, count(*) AS rows FROM wide GROUP BY ALL"),
    "destination_context": duck("SELECT session_id, n AS same_dst_unique_sources, count(*) OVER (PARTITION BY capture_id, src_ip, dst_ip, dst_port) AS same_endpoint_sessions FROM flow JOIN (SELECT capture_id, dst_ip, count(DISTINCT src_ip) AS n FROM flow GROUP BY ALL) USING (capture_id, dst_ip)"),
    "endpoint_beacon": duck(BEACON, signal=SIGNAL),
    "pair_context": duck("""SELECT *, unique_paths >= 8 AS uri_fanout, statuses >= 5 AND share_404 >= 0.6 AS high_404, shell_requests >= 2 AS repeated_shell, auth_attempts >= 5 AS auth_repetition FROM (SELECT capture_id, src_ip, dst_ip, count(DISTINCT split_part(split_part(url, '?', 1), '#', 1)) AS unique_paths, count(status) AS statuses,
        round(avg(CASE WHEN status = 404 THEN 1e0 ELSE 0e0 END), 4) AS share_404, count(*) FILTER (regexp_matches(lower(split_part(split_part(url, '?', 1), '#', 1)), 'webshell|shell[.]php|cmd[.]php|cmd[.]jsp|c99|r57')) AS shell_requests FROM page GROUP BY ALL)
        JOIN (SELECT capture_id, src_ip, dst_ip, coalesce(max(n) FILTER (a), 0) AS auth_attempts FROM (SELECT capture_id, src_ip, dst_ip, dst_port, count(*) AS n, bool_or(auth_protocol <> 'unknown') AS a FROM page GROUP BY ALL) GROUP BY ALL) USING (capture_id, src_ip, dst_ip)"""),
    "capture_summary": duck(f"""SELECT capture_id, count(*) AS sessions, min(start_time) AS first_time, max(start_time) AS last_time, sum(orig_bytes)::BIGINT AS orig_bytes, sum(resp_bytes)::BIGINT AS resp_bytes, count(DISTINCT src_ip) AS sources, count(DISTINCT dst_ip) AS destinations,
        count(*) FILTER ({FAILED}) AS failed_sessions, count(*) FILTER (dst_ip NOT LIKE '10.%') AS external_sessions, any_value(scan_sources) AS scan_sources, any_value(m) AS max_unique_dst_ports
        FROM flow JOIN (SELECT capture_id, count(*) FILTER (p >= 8 AND f >= 4e-1) AS scan_sources, max(p) AS m FROM (SELECT capture_id, src_ip, count(DISTINCT dst_port) AS p, round(avg(CASE WHEN {FAILED} THEN 1e0 ELSE 0e0 END), 4) AS f FROM flow GROUP BY ALL) GROUP BY capture_id) USING (capture_id) GROUP BY capture_id"""),
    "session_number": duck("SELECT session_id, capture_id, lpad(row_number() OVER (PARTITION BY capture_id ORDER BY start_time NULLS LAST, session_id)::VARCHAR, 6, '0') AS session_no FROM flow"),
    "numeric_pattern": duck(f"SELECT capture_id, src_ip, {_PATTERN} FROM (SELECT capture_id, src_ip, orig_bytes::DOUBLE AS v FROM flow) GROUP BY ALL"),
    "burstiness": duck(f"WITH {_GAPS} SELECT {_AUTH}, CASE WHEN n >= 2 THEN CASE WHEN s + m = 0 THEN 0 ELSE round((s - m) / (s + m), 3) END END AS burstiness FROM (SELECT {_AUTH}, count(*) AS n, round(avg(g), 3) AS m, CASE WHEN count(*) > 1 THEN round(stddev_pop(g), 3) END AS s FROM gap WHERE g >= 0 GROUP BY {_AUTH})"),
    "top_values": duck("SELECT capture_id, rank, value, n FROM (SELECT capture_id, dst_port AS value, count(*) AS n, row_number() OVER (PARTITION BY capture_id ORDER BY count(*) DESC, min(session_id)) AS rank FROM flow GROUP BY capture_id, dst_port) WHERE rank <= 5"),
    "bounded_distinct": duck("SELECT capture_id, src_ip, string_agg(dst_port::VARCHAR, ',' ORDER BY f) AS ports FROM (SELECT capture_id, src_ip, dst_port, min(session_id) AS f, row_number() OVER (PARTITION BY capture_id, src_ip ORDER BY min(session_id)) AS r FROM flow GROUP BY capture_id, src_ip, dst_port) WHERE r <= 5 GROUP BY capture_id, src_ip"),
    "start_intervals": duck("SELECT session_id, round(g, 3) AS interval FROM (SELECT session_id, start_time - lag(start_time) OVER (PARTITION BY capture_id, src_ip, dst_ip ORDER BY start_time NULLS LAST, session_id) AS g FROM flow) WHERE g >= 0"),
    "scan_candidate": duck(f"WITH {_CAND} SELECT session_id, same_src_unique_dst_ports, same_src_failed_conn_rate FROM cand"),
    "scan_episodes": duck(f"{_EPISODES} SELECT session_id, round(episode_start, 3) AS episode_start FROM kept"),
    "scan_group": duck(f"{_GROUPS} SELECT capture_id, src_ip, dst_ip, proto, round(episode_start, 3) AS episode_start, probe_count, unique_dst_ports, failed_rate, round(end_time - start_time, 3) AS scan_duration, CASE WHEN end_time > start_time THEN round(probe_count / (end_time - start_time), 4) END AS probe_rate FROM grp"),
    "uncovered_sessions": duck(f"{_EPISODES} SELECT session_id FROM flow WHERE session_id NOT IN (SELECT session_id FROM kept)"),
    "classification_records": duck(f"""{_GROUPS}, {_LOGIN}, {_CALLBACK}, covered AS (SELECT session_id FROM kept UNION SELECT session_id FROM ep SEMI JOIN (SELECT * FROM ag WHERE tier = 'high') USING ({_AUTH}, auth_protocol, episode) UNION SELECT session_id FROM flow SEMI JOIN (SELECT * FROM cb WHERE tier = 'high') USING ({_AUTH}))
        SELECT 'scan:' || capture_id || ':' || src_ip || ':' || dst_ip || ':' || proto || ':' || row_number() OVER (PARTITION BY capture_id, src_ip, dst_ip, proto ORDER BY episode_start) AS record_id, 'scan_group' AS record_type, capture_id, src_ip, dst_ip, round(start_time, 3) AS start_time, probe_count AS sessions FROM grp
        UNION ALL SELECT concat_ws(':', 'auth', {_AUTH}, auth_protocol, episode), 'auth_attempt_group', capture_id, src_ip, dst_ip, round(t, 3), sessions FROM ag WHERE tier = 'high'
        UNION ALL SELECT concat_ws(':', 'callback', {_AUTH}), 'callback_group', capture_id, src_ip, dst_ip, start_time, connections FROM cb WHERE tier = 'high'
        UNION ALL SELECT 'session:' || session_id, 'session', capture_id, src_ip, dst_ip, round(start_time, 3), 1 FROM flow WHERE session_id NOT IN (SELECT session_id FROM covered)""", signal=SIGNAL),
    "auth_episodes": duck(f"WITH {_GAPS}, {_EPISODE_NO} SELECT session_id, episode FROM ep"),
    "auth_group": duck(f"WITH {_LOGIN} SELECT * EXCLUDE t FROM ag"),
    "callback_group": duck(f"WITH {_CALLBACK} SELECT * FROM cb", signal=SIGNAL),
}
