"""Session rows from connection logs, application logs and packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import first_values
from ..functions.text import LISTS, has, redact_sensitive_text
from ..functions.values import canonical_key


def attach_app_logs(connections: DataFrame, logs: dict[str, DataFrame]) -> DataFrame:
    """Connections with the rolled-up rows of each log by (capture_id, uid).

    ``<log>_rows`` is their number, 0 where there are none. Other columns that a log has, as made by
    ``http_session_fields`` or ``log_summary``, come with it in a struct named ``<log>`` if it has one
    row for each connection (then it has a column ``count`` or none of its own ``ord``).
    """
    keys = ["capture_id", "uid"]
    out = connections
    for name, log in logs.items():
        fields = [c for c in log.columns if c not in (*keys, "count")]
        rows = F.sum("count") if "count" in log.columns else F.count("*")
        rolled = log.groupBy(*keys).agg(rows.alias(f"{name}_rows"), *([F.first(F.struct(*fields)).alias(name)] if fields and "ord" not in fields else []))
        out = out.join(rolled, keys, "left").withColumn(f"{name}_rows", F.coalesce(f"{name}_rows", F.lit(0).cast("long")))
    return out


def attach_files(connections: DataFrame, files: DataFrame) -> DataFrame:
    """Connections with the count of files and whether one looks executable; ``conn_uids`` is a set text such as {a,b}."""
    uids = F.filter(F.split(F.translate("conn_uids", "[]{}() ", ""), "[,;]"), lambda u: u != "")
    rows = files.select("capture_id", F.explode(F.array_distinct(uids)).alias("uid"), F.coalesce(has(F.col("filename"), LISTS["suspicious_file"]), F.lit(False)).alias("_exe"))
    by = rows.groupBy("capture_id", "uid").agg(F.count("*").alias("files"), F.bool_or("_exe").alias("suspicious_file"))
    return connections.join(by, ["capture_id", "uid"], "left").withColumns({"files": F.coalesce("files", F.lit(0).cast("long")), "suspicious_file": F.coalesce("suspicious_file", F.lit(False))})


def sessions_from_packets(packets: DataFrame) -> DataFrame:
    """Sessions of ``packets(capture_id, stream, ord, ts, src_ip, src_port, dst_ip, dst_port, proto, bytes, syn, ack)``.

    A session is a stream or, without one, a direction-free 5-tuple. Its first packet sets the
    direction. S0: TCP with a SYN and no ACK; else the state is unknown (null). ``duration`` has 6
    digits. With a column ``protocol``, ``service`` is the first one in order that is neither TCP nor UDP, in
    lower case; else null.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col("stream").cast("string")), canonical_key(F.col("src_ip"), F.col("src_port"), F.col("dst_ip"), F.col("dst_port"), F.col("proto")))
    rows = packets.withColumn("key", key)
    first = F.min_by(F.struct("src_ip", "src_port", "dst_ip", "dst_port", "proto"), F.struct("ts", "ord"))
    heads = rows.groupBy("capture_id", "key").agg(first.alias("h"))
    both = rows.join(heads, ["capture_id", "key"])
    out = (F.col("src_ip") == F.col("h.src_ip")) & (F.col("src_port") == F.col("h.src_port"))
    name = F.lower(F.col("protocol")) if "protocol" in packets.columns else F.lit(None).cast("string")
    service = F.min(F.when(~name.isin("", "tcp", "udp"), F.struct("ts", "ord", name.alias("name"))))["name"]
    return both.groupBy("capture_id", "key", "h").agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count_if(out).alias("orig_pkts"), F.count_if(~out).alias("resp_pkts"),
        F.sum(F.when(out, F.col("bytes")).otherwise(0)).alias("orig_bytes"), F.sum(F.when(out, F.lit(0)).otherwise(F.col("bytes"))).alias("resp_bytes"),
        F.when((F.count_if(F.col("syn")) > 0) & (F.count_if(F.col("ack")) == 0), "S0").alias("conn_state"), service.alias("service"),
    ).select(
        "capture_id", "key", "h.*", "start_time", "end_time", F.round(F.col("end_time") - F.col("start_time"), 6).alias("duration"), "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes", F.when(F.col("h.proto") == "tcp", F.col("conn_state")).alias("conn_state"), "service",
    )


def packet_fallback(sessions: DataFrame, packets: DataFrame) -> DataFrame:
    """Sessions, and for captures without any those built from packets; ``origin`` says which."""
    missing = packets.join(sessions.select("capture_id").distinct(), "capture_id", "left_anti")
    return sessions.withColumn("origin", F.lit("log")).unionByName(sessions_from_packets(missing).withColumn("origin", F.lit("packets")), allowMissingColumns=True)


def evidence_mapping(logged: Column, method: Column) -> Column:
    """(method, confidence) of a session's HTTP evidence: by uid where the log has rows, plus how observations were mapped (``map_observations``).

    Streams and uids are high, 5-tuples medium. Names are fixed values.
    """
    how = F.when(method == "stream", "tcp_stream").when(method == "five_tuple", "bidirectional_five_tuple")
    name = F.when(logged, F.concat_ws("+", F.lit("zeek_uid"), how)).otherwise(F.coalesce(how, F.lit("none")))
    sure = F.when(name.startswith("zeek_uid") | (name == "tcp_stream"), "high").when(name == "bidirectional_five_tuple", "medium").otherwise("not_applicable")
    return F.struct(name.alias("method"), sure.alias("confidence"))


def map_observations(observations: DataFrame, streams: DataFrame, sessions: DataFrame) -> DataFrame:
    """Observations with the session they belong to: by stream first, else by 5-tuple; ``method`` says how.

    Of several sessions with one key the first is taken.
    """
    by_stream = streams.groupBy("capture_id", "stream").agg(F.min_by("session_id", "ord").alias("_s"))
    by_key = sessions.groupBy("capture_id", "key").agg(F.min_by("session_id", F.struct("start_time", "session_id")).alias("_k"))
    out = observations.join(by_stream, ["capture_id", "stream"], "left").join(by_key, ["capture_id", "key"], "left")
    return out.withColumns({"session_id": F.coalesce("_s", "_k"), "method": F.when(F.col("_s").isNotNull(), "stream").when(F.col("_k").isNotNull(), "five_tuple").otherwise("none")}).drop("_s", "_k")


def payload_visibility(row: DataFrame) -> DataFrame:
    """Add payload_visibility, encrypted_protocol and observable flags; TLS, SSH, QUIC, HTTP, metadata, unknown in this order."""
    seen = F.when(F.col("tls"), "tls_encrypted").when(F.col("ssh"), "ssh_encrypted").when(F.col("quic"), "quic_encrypted").when(F.col("http"), "http_visible").when(F.col("meta"), "metadata_only").otherwise("unknown")
    out = row.withColumn("payload_visibility", seen)
    encrypted = F.when(F.col("payload_visibility").endswith("_encrypted"), F.substring_index("payload_visibility", "_", 1)).otherwise("none")
    return out.withColumns({"encrypted_protocol": encrypted, "observable_payload_available": F.col("payload_visibility") == "http_visible"})


def protocol_summaries(rows: DataFrame, value: str, code: str, k: int = 10) -> DataFrame:
    """One row for each (capture_id, uid): rows, different values and the k first-seen ones, and different codes."""
    by = rows.groupBy("capture_id", "uid").agg(F.count("*").alias("count"), F.countDistinct(value).alias("different"), F.countDistinct(code).alias("codes"))
    firsts = rows.where(F.col(value).isNotNull()).groupBy("capture_id", "uid", value).agg(F.min("ord").alias("_o"))
    ranked = firsts.withColumn("_n", F.row_number().over(Window.partitionBy("capture_id", "uid").orderBy("_o"))).where(F.col("_n") <= k)
    kept = ranked.groupBy("capture_id", "uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", value))), lambda x: x[value]).alias("samples"))
    return by.join(kept, ["capture_id", "uid"], "left")


def http_flags(rows: DataFrame) -> DataFrame:
    """One row for each (capture_id, uid) of ``rows(url, body, status, request_bytes, response_bytes)``: counts, sums and any-hit flags."""
    hit = lambda c, n: F.bool_or(F.coalesce(has(F.col(c), LISTS[n]), F.lit(False)))
    failed = F.col("status").isin(401, 403, 407)
    return rows.groupBy("capture_id", "uid").agg(
        F.count("*").alias("requests"), F.countDistinct("url").alias("different_urls"), hit("url", "login_path").alias("login_path"), hit("url", "command_param").alias("command_param"),
        hit("url", "archive").alias("archive_path"), hit("body", "upload").alias("upload_hint"), hit("body", "web_shell").alias("web_shell"), F.count_if(F.col("status") == 404).alias("not_found"),
        F.count_if(failed).alias("auth_failures"), F.greatest(F.sum("request_bytes"), F.sum(F.length("url"))).alias("request_bytes"), F.sum("response_bytes").alias("response_bytes"),
    ).withColumn("many_not_found", (F.col("requests") >= 4) & (F.col("not_found") >= 0.6 * F.col("requests")))


#: Lists of a session's HTTP fields and how many values each keeps. Fixed values.
HTTP_LISTS = {
    "http_methods": 5, "http_hosts": 5, "http_uris_sample": 5, "http_full_uri_sample": 3, "http_status_codes": 5, "http_user_agents": 5, "http_referrers": 3, "http_content_types": 5, "http_upload_hints": 5,
    "request_body_snippets_sanitized": 3, "response_body_snippets_sanitized": 3, "suspicious_payload_snippets": 5, "suspicious_http_parameters": 5, "suspicious_uri_patterns": 5,
}
OBSERVED_LISTS = ("body_snippets_sanitized", "suspicious_payload_snippets", "suspicious_http_parameters", "suspicious_uri_patterns")


def http_session_fields(logs: DataFrame, observations: DataFrame) -> DataFrame:
    """One row for each (capture_id, uid): the HTTP fields of a session from log rows and observed messages.

    ``logs(capture_id, uid, ord, method, host, uri, status_code, user_agent, referrer, mime_type,
    request_body_len, response_body_len)`` come first, then ``observations(capture_id, uid, ord,
    body_role, method, host, uri, full_uri, status_code, user_agent, referrer, content_type,
    content_length, cookie_present, auth_header_present, body_observed, ...)`` with four arrays of
    text. Lists keep the first different values. Body lengths are summed on either side and the
    larger sum counts, for each direction. Log texts are redacted here, observed ones before. Null
    lengths count as 0, null flags as not set.
    """
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<string>")
    uri = redact_sensitive_text(F.col("uri"), 320)
    full = F.when(F.col("host").isNotNull() & F.col("uri").isNotNull(), redact_sensitive_text(F.concat(F.lit("http://"), "host", "uri"), 320))
    number = lambda c: F.coalesce(F.expr(f"try_cast({c} AS BIGINT)"), F.lit(0).cast("long"))
    one = logs.select(
        "capture_id", "uid", F.struct(F.lit(0).alias("side"), F.col("ord").cast("long").alias("ord")).alias("_at"), "method", "host", uri.alias("uri"), full.alias("full_uri"), F.col("status_code").cast("string").alias("status"),
        redact_sensitive_text(F.col("user_agent"), 180).alias("agent"), redact_sensitive_text(F.col("referrer"), 320).alias("referrer"), redact_sensitive_text(F.col("mime_type"), 120).alias("content_type"), none.alias("role"),
        number("request_body_len").alias("sent"), number("response_body_len").alias("got"), *(F.lit(False).alias(c) for c in ("cookie", "auth", "body")), *(empty.alias(c) for c in OBSERVED_LISTS),
    )
    length = number("content_length")
    two = observations.select(
        "capture_id", "uid", F.struct(F.lit(1).alias("side"), F.col("ord").cast("long").alias("ord")).alias("_at"), "method", "host", "uri", "full_uri", F.col("status_code").cast("string").alias("status"),
        F.col("user_agent").alias("agent"), "referrer", "content_type", F.col("body_role").alias("role"), F.when(F.col("body_role") == "request", length).otherwise(0).alias("sent"), F.when(F.col("body_role") == "response", length).otherwise(0).alias("got"),
        F.col("cookie_present").alias("cookie"), F.col("auth_header_present").alias("auth"), F.col("body_observed").alias("body"), *(F.coalesce(c, empty).alias(c) for c in OBSERVED_LISTS),
    )
    rows = one.unionByName(two)
    by_side = lambda c: F.greatest(*(F.coalesce(F.sum(F.when(F.col("_at.side") == side, F.col(c))), F.lit(0)) for side in (0, 1)))
    any_of = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    flags = rows.groupBy("capture_id", "uid").agg(
        by_side("sent").alias("http_request_body_len"), by_side("got").alias("http_response_body_len"), any_of("cookie").alias("http_cookie_present"), any_of("auth").alias("http_auth_header_present"),
        any_of(F.contains(F.lower("content_type"), F.lit("multipart/form-data"))).alias("http_multipart_present"), any_of("body").alias("http_body_observed"),
    )
    hints = F.filter(F.array("uri", "content_type"), lambda v: has(v, LISTS["upload"]))
    snippets = lambda role: F.when(F.col("role") == role, F.col("body_snippets_sanitized"))
    values = [F.col(c) for c in ("method", "host", "uri", "full_uri", "status", "agent", "referrer", "content_type")] + [hints, snippets("request"), snippets("response"), *(F.col(c) for c in OBSERVED_LISTS[1:])]
    lists = first_values(rows.select("capture_id", "uid", "_at", *(v.alias(c) for c, v in zip(HTTP_LISTS, values, strict=True))), ["capture_id", "uid"], "_at", HTTP_LISTS)
    return flags.join(lists, ["capture_id", "uid"], "left").withColumns({c: F.coalesce(c, empty) for c in HTTP_LISTS})


def log_summary(log: DataFrame, limits: dict[str, int], order: str = "ord") -> DataFrame:
    """One row for each (capture_id, uid): number of rows and the first different values of some columns.

    A DNS log with DNS_LISTS gives queries, codes and answers; a TLS log with TLS_LISTS server names, versions and ciphers.
    """
    keys = ["capture_id", "uid"]
    lists = first_values(log, keys, order, limits)
    counted = log.groupBy(*keys).agg(F.count("*").alias("count")).join(lists, keys, "left")
    return counted.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in limits})


#: Columns of the DNS and TLS logs that are summed up, and how many values each keeps. Fixed values.
DNS_LISTS = {"query": 10, "rcode_name": 10, "answers": 5}
TLS_LISTS = {"server_name": 10, "version": 10, "cipher": 5}


def success_after_failure(rows: DataFrame) -> DataFrame:
    """For each (capture_id, uid) of ``rows(ts, ok)``: whether a success follows an earlier failure."""
    before = Window.partitionBy("capture_id", "uid").orderBy("ts", "ord").rowsBetween(Window.unboundedPreceding, -1)
    flagged = rows.withColumn("_failed", F.coalesce(F.max((~F.col("ok")).cast("int")).over(before), F.lit(0)))
    return flagged.groupBy("capture_id", "uid").agg(F.bool_or(F.col("ok") & (F.col("_failed") == 1)).alias("success_after_failure"), F.count_if(~F.col("ok")).alias("failures"))
