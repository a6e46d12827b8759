"""Whole records of scan and login groups: members, intervals, merged evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import burstiness, numeric_pattern
from .context import same_keys
from .evidence import Row
from .groups import LOGIN_KEYS, SCAN_KEYS, gap_episodes, login_sessions, scan_groups, start_intervals
from .merges import merge_values

#: Fields whose evidence a group takes over from its members.
OBSERVED = (
    "payload_visibility", "observable_payload_available", "encrypted_protocol", "extraction_warnings", "evidence_limits", "evidence_mapping", "http_summary", "dns_summary", "tls_summary", "http_methods", "http_hosts",
    "http_uris_sample", "http_full_uri_sample", "http_status_codes", "http_user_agents", "http_referrers", "http_content_types", "http_request_body_len", "http_response_body_len", "http_cookie_present", "http_auth_header_present",
    "http_multipart_present", "http_upload_hints", "http_body_observed", "request_body_snippets_sanitized", "response_body_snippets_sanitized", "suspicious_payload_snippets", "suspicious_http_parameters", "suspicious_uri_patterns",
    "exploit_indicators", "vuln_scan_indicators", "auth_indicators", "implant_indicators", "backdoor_access_indicators", "c2_indicators", "transferred_files_summary", "benign_periodic_hints",
)
LOGIN_OBSERVED = OBSERVED[:6]
#: Ports of a scan that are listed; HTTP login paths of a login group; codes of scans.
MOST_PORTS, MOST_PATHS, PORT_SCAN, PROBE_SCAN = 30, 12, "TA43_01", "TA43_02"
WEAK_REASON = "Fewer than two explicit login failures in repeated connections."
EPISODE = [*SCAN_KEYS, "episode_start"]


def _named(kind: str, parts: list[Column]) -> Column:
    return F.concat_ws(":", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_order", F.struct(F.col("start_time").isNull(), "start_time", "session_id"))


def _intervals(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, ``name`` as a struct of the interval pattern, burstiness_score)."""
    found = numeric_pattern(start_intervals(rows, keys), keys, "interval")
    parts = [c for c in found.columns if c not in keys]
    return found.select(*keys, F.struct(*parts).alias(name), burstiness(F.col("mean"), F.col("std"), F.col("count")).alias("burstiness_score"))


def _merged(rows: DataFrame, keys: list[str], fields: tuple[str, ...]) -> DataFrame:
    have = [c for c in fields if c in rows.columns]
    return merge_values(_ordered(rows).select(*keys, "_order", *have), keys, "_order")


def _scan_ids(episodes: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*SCAN_KEYS).orderBy("episode_start"))
    return episodes.select(*EPISODE).distinct().withColumn("record_id", _named("scan", [*map(F.col, SCAN_KEYS), place]))


def scan_records(episodes: DataFrame) -> DataFrame:
    """One record for each scan episode of ``scan_episodes``.

    What ``scan_groups`` has, and: all ports in order (``dst_ports``; there are 65,536 at the most)
    and the first 30 of them, the pattern and burstiness of the
    intervals between probes, when the last probe ended (``end_time`` of the sessions, where they
    have it), the evidence of all members merged by type, and the code that the group hints at: a
    vulnerability scan as soon as any vulnerability flag or keyword is set, else a port scan. Members
    are rows of ``scan_members``, as a group may have any number of them.
    """
    ports = episodes.where("dst_port is not null").select(*EPISODE, "dst_port").distinct()
    ports = ports.groupBy(*EPISODE).agg(F.array_sort(F.collect_list("dst_port")).alias("dst_ports")).withColumn("dst_ports_sample", F.slice("dst_ports", 1, MOST_PORTS))
    out = scan_groups(episodes)
    if "end_time" in episodes.columns:
        ends = episodes.groupBy(*EPISODE).agg(F.max(F.coalesce("end_time", "start_time")).alias("_end"))
        out = same_keys(out, ends, EPISODE, "left")
        span = F.greatest(F.col("_end") - F.col("start_time"), F.lit(0.0))
        out = out.withColumns({"end_time": F.col("_end"), "scan_duration": F.round(span, 3), "probe_rate": F.when(span > 0, F.round(F.col("probe_count") / span, 4))}).drop("_end")
    for part in (ports, _intervals(episodes, EPISODE, "inter_arrival_summary"), _scan_ids(episodes), _merged(episodes, EPISODE, OBSERVED)):
        out = same_keys(out, part, EPISODE, "left")
    r = Row(out)
    flags = [r.flag(f"vuln_scan_indicators.{f.name}") for f in r.kinds["vuln_scan_indicators"] if f.dataType.simpleString() == "boolean"] if "vuln_scan_indicators" in r.kinds else []
    probes = F.lit(False)
    for f in flags:
        probes = probes | f
    if "vuln_scan_indicators" in r.kinds and "matched_keywords" in r.kinds["vuln_scan_indicators"].names:
        probes = probes | F.coalesce(F.size("vuln_scan_indicators.matched_keywords") > 0, F.lit(False))
    return out.withColumn("candidate_hint", F.when(probes, PROBE_SCAN).otherwise(PORT_SCAN))


def scan_members(episodes: DataFrame) -> DataFrame:
    """(record_id, session_id) of all members of the scan records."""
    return same_keys(episodes, _scan_ids(episodes), EPISODE, "inner").select("record_id", "session_id")


def _login_rows(sessions: DataFrame, window_seconds: float) -> DataFrame:
    r = Row(sessions)
    own = sessions if "auth_protocol" in r.kinds or "auth_indicators" not in r.kinds or "auth_protocol" not in r.kinds["auth_indicators"].names else sessions.withColumn("auth_protocol", F.col("auth_indicators.auth_protocol"))
    return gap_episodes(login_sessions(own), LOGIN_KEYS, window_seconds)


def login_records(sessions: DataFrame, window_seconds: float = 300.0, min_attempts: int = 3) -> DataFrame:
    """One record for each login episode of ``sessions`` with a struct ``auth_indicators``.

    Attempts: the sessions, or the attempts that they count themselves if those are more; failures
    add up. High: five attempts and two failures. Status codes are counted over all members, each as
    often as it is listed; FTP codes are a sorted set; login paths the first twelve different ones.
    ``auth_indicators`` sums it all up. Members are rows of ``login_members``.
    """
    keys = [*LOGIN_KEYS, "episode"]
    rows, r = _login_rows(sessions, window_seconds), Row(sessions)
    of = lambda n: r.number(f"auth_indicators.{n}").cast("long")
    flag = lambda n: F.bool_or(r.flag(f"auth_indicators.{n}"))
    end = F.coalesce("end_time", "start_time") if "end_time" in r.kinds else F.col("start_time")
    out = rows.groupBy(*keys).agg(
        F.count("*").alias("member_session_count"), F.greatest(F.count("*"), F.sum(of("session_auth_attempt_count"))).alias("attempt_count"), F.sum(of("failed_login_count")).alias("failed_login_count"),
        F.max(of("unique_usernames_seen")).alias("unique_usernames_seen"), flag("username_field_seen").alias("username_field_seen"), flag("password_field_seen").alias("password_field_seen"),
        flag("ssh_auth_failure_hint").alias("ssh_auth_failure_hint"), flag("success_after_failures_hint").alias("success_after_failures_hint"), F.min("start_time").alias("start_time"), F.max(end).alias("end_time"),
    ).where(F.col("attempt_count") >= min_attempts)
    span = F.greatest(F.col("end_time") - F.col("start_time"), F.lit(0.0))
    high = (F.col("attempt_count") >= 5) & (F.col("failed_login_count") >= 2)
    rate = F.when(span > 0, F.round(F.col("attempt_count") / span, 4))
    out = out.withColumns({
        "record_id": _named("auth", [*map(F.col, LOGIN_KEYS), F.col("episode")]), "time_span": F.round(span, 3), "attempt_rate": rate, "repeated_login_attempts": F.col("attempt_count") >= 5,
        "failure_burst": F.struct(F.col("failed_login_count").alias("failed_count"), F.round(F.col("failed_login_count") / F.greatest(F.col("attempt_count"), F.lit(1)), 4).alias("failure_rate"), F.round(span, 3).alias("span_seconds")),
        "tier": F.when(high, "high").otherwise("weak"), "evidence_tier": F.when(high, "high_auth_behavioral").otherwise("weak_auth_evidence"), "weak_evidence_reason": F.when(~high, WEAK_REASON),
    })
    names = r.kinds["auth_indicators"].names if "auth_indicators" in r.kinds else []
    lists = {n: F.col(f"auth_indicators.{n}") for n in ("auth_status_codes", "ftp_response_codes", "http_login_paths") if n in names}
    empty = F.array().cast("array<string>")
    codes = {n: rows.select(*keys, F.explode(F.transform(c, lambda x: x.cast("string"))).alias("code")).groupBy(*keys, "code").agg(F.count("*").alias("n")) for n, c in lists.items() if n != "http_login_paths"}
    if "auth_status_codes" in codes:
        out = same_keys(out, codes["auth_status_codes"].groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "n")))).alias("status_code_summary")), keys, "left")
    if "ftp_response_codes" in codes:
        out = same_keys(out, codes["ftp_response_codes"].groupBy(*keys).agg(F.array_sort(F.collect_list("code")).alias("ftp_response_codes")), keys, "left")
    if "http_login_paths" in lists:
        out = same_keys(out, merge_values(_ordered(rows).select(*keys, "_order", lists["http_login_paths"].alias("http_login_paths")), keys, "_order", MOST_PATHS), keys, "left")
    lacking = {"status_code_summary": F.create_map().cast("map<string,bigint>"), "ftp_response_codes": empty, "http_login_paths": empty}
    out = out.withColumns({n: F.coalesce(n, e) if n in out.columns else e for n, e in lacking.items()})
    for part in (_intervals(rows, keys, "inter_attempt_intervals"), _merged(rows, keys, LOGIN_OBSERVED)):
        out = same_keys(out, part, keys, "left")
    return out.withColumn("auth_indicators", F.struct(
        "auth_protocol", "repeated_login_attempts", (F.col("failed_login_count") > 0).alias("failed_login_hint"), "success_after_failures_hint", F.col("attempt_count").alias("same_src_same_dst_auth_attempts"), "username_field_seen", "password_field_seen",
        "unique_usernames_seen", "failed_login_count", F.map_keys("status_code_summary").alias("auth_status_codes"), "ftp_response_codes", "ssh_auth_failure_hint", "http_login_paths", (F.col("tier") == "weak").alias("weak_evidence"), "attempt_rate", "inter_attempt_intervals",
    ))


def login_members(sessions: DataFrame, records: DataFrame, window_seconds: float = 300.0) -> DataFrame:
    """(record_id, session_id) of all members of ``records`` of the same window."""
    keys = [*LOGIN_KEYS, "episode"]
    return same_keys(_login_rows(sessions, window_seconds), records.select(*keys, "record_id"), keys, "inner").select("record_id", "session_id")
