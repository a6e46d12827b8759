"""Search terms of a record: rules as tables over named tests, each test made once for a row.

All rule tables are fixed values. A record without a column counts as one whose value is null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, StructType

from .evidence import CALLBACK_SIGNS, INDICATORS, LOGIN_SIGNS, Row, positive, value_text

#: Documents that explain the boundary of two or three codes.
BOUNDARY = {
    "ta43_01_vs_ta43_02": "boundary_ta43_01_vs_ta43_02",
    "ta01_01_vs_tn01_01": "boundary_ta01_01_vs_tn01_01",
    "ta01_02_vs_tn01_01": "boundary_ta01_02_vs_tn01_01",
    "ta11_01_vs_ta11_02": "boundary_ta11_01_vs_ta11_02",
    "ta11_02_vs_tn01_01": "boundary_ta11_02_vs_tn01_01",
    "ta01_02_vs_ta11_01": "observable_exploit_indicator_mapping",
    "ta03_01_vs_ta01_02": "observable_file_upload_and_implant_hints",
    "ta03_01_vs_ta11_01": "observable_file_upload_and_implant_hints",
    "ta01_02_vs_ta03_01_vs_ta11_01": "observable_exploit_upload_access_sequence",
}
#: Documents on each indicator, and on timing.
ABOUT = {
    "vuln_scan_indicators": "observable_vulnerability_scan_indicators", "exploit_indicators": "observable_exploit_indicator_mapping", "auth_indicators": "observable_auth_bruteforce_indicators",
    "implant_indicators": "observable_file_upload_and_implant_hints", "backdoor_access_indicators": "observable_backdoor_access_vs_callback", "c2_indicators": "observable_backdoor_access_vs_callback",
}
LOGIN_TIMING, SCAN_TIMING, BEACON_TIMING, SEQUENCE, PERIODIC, ENCRYPTED = (
    "observable_auth_bruteforce_timing", "observable_scan_probe_timing", "observable_beacon_timing_boundary", "observable_exploit_upload_access_sequence", "normal_periodic_connection_vs_c2", "observable_encrypted_visibility_limits",
)
SCANS, LOGINS, CALLBACKS = (BOUNDARY["ta43_01_vs_ta43_02"],), (BOUNDARY["ta01_01_vs_tn01_01"],), (BOUNDARY["ta11_02_vs_tn01_01"], BEACON_TIMING)
PROBES = (*SCANS, ABOUT["vuln_scan_indicators"])
#: Fields whose values are terms as they stand, the numbers that are shown with their name, and the fields of time.
PLAIN, NUMBERED = ("proto", "service", "conn_state", "history"), ("duration", "packet_rate", "byte_rate", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes")
SUMMARIES, SEEN = ("http_summary", "dns_summary", "tls_summary"), ("payload_visibility", "suspicious_payload_snippets", "suspicious_uri_patterns")
TIMED = (
    "time_span", "inter_arrival_summary", "inter_attempt_intervals", "interval_summary", "attempt_rate", "probe_rate", "burstiness_score", "periodicity_score", "regularity_score", "beacon_score", "fixed_endpoint_duration",
    "failure_burst", "benign_periodic_hints", "ordered_event_summary", "relative_time_deltas", "scan_to_exploit_delta", "exploit_to_upload_delta", "upload_to_access_delta", "repeated_backdoor_access_intervals",
)
#: Fields whose texts speak for a rule, and fields that only name a record.
SPOKEN = ("proto", "service", "http_summary", "dns_summary", "tls_summary", "alert_summary", "notice_summary", "weird_summary", "candidate_hint", "suspicious_payload_snippets", "suspicious_uri_patterns")
UNSPOKEN = ("record_id", "session_id", "pcap_id", "capture_id", "pcap", "flow_source", "source_file", "parser_source", "pcap_summary", "evidence_limits", *INDICATORS)
CHAIN_FIELDS = ("ordered_event_summary", "relative_time_deltas", "scan_to_exploit_delta", "exploit_to_upload_delta", "upload_to_access_delta", "repeated_backdoor_access_intervals")
#: (rule, test, fields whose values are terms too, terms): tests of the record's kind and numbers, then of its words.
TERM_RULES = (
    ("auth_attempt_group:TA01_01_boundary", "auth_group", ("auth_protocol", "failed_login_count", "status_code_summary", "attempt_rate", "inter_attempt_intervals"), (
        "authentication attempt group", "repeated login attempts", "authentication failures", "failed_login_count", "attempt_rate", "inter-attempt interval", "failure burst", "success after failures",
        "single failed login is not brute force", "FTP SSH HTTP login", "TA01_01", "authentication failure timing burst",
    )),
    ("c2_callback_group:TA11_02_boundary", "callback_group", ("interval_summary", "bytes_pattern", "callback_direction_hint", "benign_periodic_hints"), (
        "callback group", "fixed remote endpoint", "periodic connection pattern", "C2", "TA11_02", "beacon timing boundary", "benign periodic update telemetry DNS NTP WPAD cloud sync health check",
        "packet size pattern", "TLS SNI DNS query fixed endpoint",
    )),
    ("scan_group:TA43_01", "scan_group", (), ("scan_group", "many destination ports", "dst_port fanout", "target fanout", "failed connections", "probe rate", "burstiness_score", "scan burst", "port scan", "TA43_01")),
    ("many_ports:TA43_01", "many_ports", (), ("many ports", "port fanout", "dst_port fanout", "port scan", "TA43_01")),
    ("failed_rate", "mostly_failed", (), ("failed connection rate", "reconnaissance", "TA43_01")),
    ("vulnerability_scan:TA43_02", "vulnerability_words", (), ("vulnerability scan signs", "URI fanout", "HTTP 404 rate", "scanner User-Agent", "CVE path", "probe path keywords", "directory scan", "TA43_02")),
    ("login_failures:TA01_01", "login_words", (), ("login failures", "password bruteforce", "failed_login_count", "attempt_rate", "failure burst", "success-after-failure hint", "TA01_01")),
    ("exploit_payload:TA01_02", "exploit_words", (), ("exploit request", "payload", "vulnerability exploitation", "command injection", "SQLi", "path traversal", "malicious parameter", "TA01_02")),
    ("implant:TA03_01", "implant_words", (), ("implant", "persistence", "multipart/form-data", "webshell filename", "payload delivery", "TA03_01")),
    ("backdoor_access:TA11_01", "backdoor_words", (), ("backdoor access", "backdoor endpoint", "cmd parameter", "command interaction", "TA11_01")),
    ("callback_c2:TA11_02", "callback_words", (), ("callback", "C2", "periodic beacon", "beacon_score", "regularity_score", "fixed endpoint", "benign periodic boundary", "TA11_02")),
)
#: The same for whole captures, before the others.
CAPTURE_RULES = (
    ("pcap_scan_summary:TA43", "capture_scan", ("PCAP scan summary", "port fanout across PCAP", "TA43")),
    ("pcap_auth_summary:TA01_01", "capture_logins", ("PCAP authentication attempts", "failed login count across PCAP", "TA01_01")),
    ("pcap_beacon_summary:TA11_02", "capture_beacon", ("PCAP beacon summary", "callback timing across PCAP", "TA11_02")),
    ("pcap_payload_evidence", "capture_payload", ("PCAP payload evidence", "exploit upload backdoor boundary", "TA01_02 TA03_01 TA11_01")),
)
NORMAL_TERMS, LOW_RULE, DEFAULT_RULE = ("normal business", "weak-only signal", "TN01_01"), "low_volume_no_behavior_pattern:TN01_01", "default_boundary:TN01_01"
#: (group, test) of what a record may be confused with.
GROUP_RULES = (
    ("ta43_01_vs_ta43_02", "group_scan"), ("ta01_01_vs_tn01_01", "group_login"), ("ta01_02_vs_tn01_01", "group_exploit"), ("ta01_02_vs_ta11_01", "group_shell"), ("ta03_01_vs_ta01_02", "implant"), ("ta03_01_vs_ta11_01", "implant"),
    ("ta01_02_vs_ta03_01_vs_ta11_01", "group_chain"), ("ta11_01_vs_ta11_02", "group_access"), ("ta11_02_vs_tn01_01", "group_callback"),
)
#: (trigger, test, documents) that aim at documents.
TRIGGERS = (
    *((f"{c}=positive", c.removesuffix("_indicators").replace("vuln_scan", "vulnerability").replace("_access", ""), (ABOUT[c],)) for c in INDICATORS),
    ("payload_visibility=encrypted_tls", "encrypted", (ENCRYPTED,)),
    ("auth_timing=positive", "login_rate", (LOGIN_TIMING,)),
    ("scan_timing=positive", "probe_rate", (SCAN_TIMING,)),
    ("port_or_target_fanout=positive", "fanout", (*SCANS, SCAN_TIMING)),
    ("pcap_scan_summary=positive", "capture_scan", (*SCANS, SCAN_TIMING)),
    ("uri_fanout=positive", "uri_fanout", PROBES),
    ("http_404_rate=positive", "many_404", PROBES),
    ("scanner_user_agent=positive", "scanner", PROBES),
    ("cve_or_probe_path=positive", "probe_path", PROBES),
    ("failed_login_count=positive", "failed_logins", (*LOGINS, ABOUT["auth_indicators"], LOGIN_TIMING)),
    ("attempt_rate=positive", "attempt_rate", (*LOGINS, LOGIN_TIMING)),
    ("failure_burst=positive", "failure_burst", (*LOGINS, LOGIN_TIMING)),
    ("success_after_failures=positive", "late_success", (*LOGINS, ABOUT["auth_indicators"])),
    ("pcap_auth_summary=positive", "capture_logins", (*LOGINS, ABOUT["auth_indicators"], LOGIN_TIMING)),
    ("callback_timing=positive", "callback_timing", (BEACON_TIMING,)),
    ("fixed_endpoint=positive", "fixed_endpoint", CALLBACKS),
    ("dns_sni_repetition=positive", "repeated_names", CALLBACKS),
    ("packet_size_pattern=positive", "size_pattern", CALLBACKS),
    ("encrypted_timing_metadata=positive", "encrypted_timing", (ENCRYPTED, BEACON_TIMING)),
    ("pcap_beacon_summary=positive", "capture_beacon", CALLBACKS),
    ("benign_periodic_hints=positive", "benign_periodic", (PERIODIC, BEACON_TIMING)),
    ("ordered_event_sequence=positive", "sequence", (SEQUENCE,)),
    ("exploit_upload_access_boundary=positive", "chain", (SEQUENCE, ABOUT["exploit_indicators"], ABOUT["implant_indicators"], ABOUT["backdoor_access_indicators"], "competition_backdoor_implant_access_callback_boundary")),
)
#: Documents of the boundary rules between candidates, in the order of the rules.
CANDIDATE_RULES = (
    (("TA43_01", "TA43_02"), ("boundary_ta43_01_vs_ta43_02", SCAN_TIMING, ABOUT["vuln_scan_indicators"])),
    (("TA43_02", "TA01_02"), ("boundary_ta43_01_vs_ta43_02", ABOUT["exploit_indicators"], ABOUT["vuln_scan_indicators"])),
    (("TA01_01", "TA43_01"), ("boundary_ta01_01_vs_tn01_01", ABOUT["auth_indicators"], SCAN_TIMING)),
    (("TA01_01", "TA11_02"), ("boundary_ta01_01_vs_tn01_01", ABOUT["auth_indicators"], "boundary_ta11_02_vs_tn01_01", BEACON_TIMING)),
    (("TA01_02", "TA03_01"), (ABOUT["exploit_indicators"], ABOUT["implant_indicators"], SEQUENCE)),
    (("TA03_01", "TA11_01"), (ABOUT["implant_indicators"], ABOUT["backdoor_access_indicators"], SEQUENCE)),
    (("TA11_01", "TA01_02"), (ABOUT["backdoor_access_indicators"], ABOUT["exploit_indicators"], "boundary_ta01_02_vs_ta11_01")),
    (("TA11_01", "TA11_02"), ("boundary_ta11_01_vs_ta11_02", ABOUT["backdoor_access_indicators"], BEACON_TIMING)),
    (("TA11_02", "TN01_01"), ("boundary_ta11_02_vs_tn01_01", PERIODIC, ENCRYPTED)),
    (("TA01_02", "TA03_01", "TN01_01"), ("boundary_ta01_02_vs_tn01_01", ABOUT["implant_indicators"], ABOUT["exploit_indicators"])),
)
MOST_RULES, MOST_CANDIDATES, QUERY_TERMS = 6, 3, 100
#: Words of the tests.
PROBE_WORDS = ("cve-", "phpmyadmin", "wp-admin", "wp-login", "/.git", "cgi-bin", "hnap1", "server-status", "../", "etc/passwd", "dirbuster", "gobuster")
SCANNERS = ("nikto", "openvas", "nessus", "nmap", "sqlmap", "wpscan", "acunetix", "burp", "zaproxy")
CHAIN_WORDS = ("multipart", "webshell", "cmd=", "command=", "exec=", "upload", "filename")
BENIGN_SIGNS = ("update_or_telemetry_text", "dns_refresh_like", "ntp_like", "periodicity_alone")


def active(r: Row, field: str) -> Column:
    """Whether an indicator of a record is set: logins and callbacks by their signs, others by any part."""
    if field == "auth_indicators":
        return _any([r.flag(f"{field}.{n}") for n in LOGIN_SIGNS])
    if field == "c2_indicators":
        return _any([r.number(f"{field}.beacon_score") >= 0.5, *(r.flag(f"{field}.{n}") for n in CALLBACK_SIGNS)])
    return positive(r.kinds[field], F.col(field), "group") if field in r.kinds else F.lit(False)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(t, F.lit(False)) for t in tests), F.lit(False))


def _holds(text: str, words: tuple[str, ...]) -> Column:
    return _any([F.contains(text, F.lit(w)) for w in words])


def _tokens(text: str, words: tuple[str, ...]) -> Column:
    return F.arrays_overlap(F.regexp_extract_all(text, F.lit("[a-z0-9_+-]+"), F.lit(0)), F.array(*map(F.lit, words)))


def _with_texts(records: DataFrame) -> DataFrame:
    """Add the lower-case texts that tests look at: all that speaks, what rules read, and fields of probes, agents and chains."""
    every = set(records.columns)
    only = lambda fields: F.lower(value_text(records, tuple(every - set(fields))))
    return records.withColumns({
        "_all": F.lower(value_text(records, UNSPOKEN)), "_spoken": only(SPOKEN), "_probes": only(("http_uris_sample", "http_full_uri_sample", "suspicious_uri_patterns", "vuln_scan_indicators")), "_agents": only(("http_user_agents", "vuln_scan_indicators")),
        "_chain": only(("exploit_indicators", "implant_indicators", "backdoor_access_indicators", "http_upload_hints", "transferred_files_summary", "suspicious_http_parameters", "suspicious_uri_patterns")),
    })


def tests(records: DataFrame) -> dict[str, Column]:
    """The named tests of a record, over its columns and those of ``_with_texts``."""
    r = Row(records)
    on = {c: active(r, c) for c in INDICATORS}
    vuln, exploit, auth, implant, backdoor, c2 = on.values()
    kind, service, port = r.kind(), F.lower(F.coalesce(r.text("service"), F.lit(""))), r.number("dst_port")
    codes = F.filter(r.list("http_status_codes"), lambda c: ~c.isin("", "-"))
    paths = F.array_distinct(F.transform(F.filter(r.list("http_uris_sample"), lambda u: ~u.isin("", "-")), lambda u: F.lower(F.substring_index(F.substring_index(u, "?", 1), "#", 1))))
    timing = r.filled("interval_summary") & ((kind == "c2_callback_group") | (r.number("beacon_score") >= 0.5) | (r.number("regularity_score", "periodicity_score") >= 0.6))
    benign = _any([r.flag(f"benign_periodic_hints.{n}") for n in BENIGN_SIGNS]) | (r.flag("benign_periodic_hints.short_burst_not_beacon") & c2)
    fixed = r.flag("c2_indicators.fixed_remote_endpoint")
    encrypted = F.coalesce(r.text("payload_visibility") == "encrypted_tls", F.lit(False))
    many = r.number("same_src_unique_dst_ports", "unique_dst_ports") >= 8
    callback = _holds("_all", ("callback", "beacon", "checkin", "botnet")) | _tokens("_all", ("c2", "cnc", "rat"))
    said = lambda *words: _holds("_spoken", words)
    return {
        "vulnerability": vuln, "exploit": exploit, "auth": auth, "implant": implant, "backdoor": backdoor, "c2": c2, "encrypted": encrypted,
        "auth_group": kind == "auth_attempt_group", "callback_group": kind == "c2_callback_group", "scan_group": kind == "scan_group", "many_ports": many, "mostly_failed": r.number("same_src_failed_conn_rate", "failed_conn_rate") >= 0.5,
        "vulnerability_words": vuln | said("vulnerability scan", "scanner", "nikto", "nessus", "openvas", "version probe"), "login_words": auth | said("login", "authentication", "bruteforce", "brute force", "ssh", "ftp", "rdp"),
        "exploit_words": exploit | said("exploit", "cve", "command injection", "sql injection", "xss", "ms17-010"), "implant_words": implant | said("implant", "persistence", "webshell", "backdoor placement"),
        "backdoor_words": backdoor | said("backdoor access", "reverse shell", "webshell command"), "callback_words": c2 | said("callback", "c2", "cnc", "beacon", "checkin") | _tokens("_spoken", ("rat",)),
        "capture_scan": (r.number("scan_group_summary.max_unique_dst_ports") >= 8) | (r.number("scan_group_summary.scan_like_record_count") > 0),
        "capture_logins": (r.number("auth_attempt_summary.failed_login_count") > 0) | (r.number("auth_attempt_summary.max_attempt_count") >= 5),
        "capture_beacon": (r.number("beacon_like_summary.max_beacon_score") >= 0.5) | (r.number("beacon_like_summary.fixed_endpoint_record_count") > 0), "capture_payload": r.filled("top_payload_evidence"),
        "login_rate": (kind == "auth_attempt_group") & r.filled("attempt_rate"), "probe_rate": (kind == "scan_group") & r.filled("probe_rate"), "fanout": r.number("same_src_unique_dst_ports", "unique_dst_ports", "same_src_unique_dst_ips") >= 8,
        "uri_fanout": r.flag("vuln_scan_indicators.high_uri_fanout") | (F.size(paths) >= 5), "many_404": r.flag("vuln_scan_indicators.high_404_rate") | ((F.size(codes) >= 5) & (F.size(F.filter(codes, lambda c: c == "404")) / F.size(codes) >= 0.5)),
        "scanner": _holds("_agents", SCANNERS), "probe_path": r.flag("vuln_scan_indicators.cve_probe_hint") | _holds("_probes", PROBE_WORDS), "failed_logins": r.number("failed_login_count", "auth_indicators.failed_login_count") > 0,
        "attempt_rate": r.filled("attempt_rate") | (r.number("auth_indicators.attempt_rate") > 0), "failure_burst": r.filled("failure_burst"), "late_success": r.flag("success_after_failures_hint") | r.flag("auth_indicators.success_after_failures_hint"),
        "callback_timing": timing, "fixed_endpoint": fixed | r.flag("c2_indicators.source_initiated_fixed_endpoint"),
        "repeated_names": r.flag("c2_indicators.dns_repeated_query") | r.flag("c2_indicators.tls_sni_repeated") | r.filled("dns_query_repetition") | r.filled("tls_sni_repetition"), "size_pattern": r.filled("bytes_pattern") | r.flag("c2_indicators.small_repeated_payload"),
        "encrypted_timing": encrypted & (timing | fixed | r.flag("c2_indicators.periodic_connections")), "benign_periodic": benign, "sequence": _any([r.filled(c) for c in CHAIN_FIELDS]),
        "chain": (exploit & (implant | backdoor)) | r.flag("http_multipart_present") | _holds("_chain", CHAIN_WORDS) | r.filled("top_payload_evidence"),
        "group_scan": (kind == "scan_group") | many | vuln | _tokens("_all", ("scan", "scanner", "nikto", "openvas", "nessus", "nmap")) | _holds("_all", ("service enumeration", "version probe")),
        "group_login": auth | service.isin("ssh", "ftp", "rdp", "smb", "smb2", "kerberos", "ldap") | port.isin(21, 22, 23, 445, 3389) | ((r.number("same_src_same_dst_port_count", "same_src_conn_count") >= 5) & _holds("_all", ("ssh", "ftp", "rdp", "login")))
        | _holds("_all", ("login", "authentication", "password", "bruteforce", "brute force", "patator")),
        "group_exploit": exploit | service.isin("http", "https", "ssl", "tls") | port.isin(80, 443, 8000, 8080, 8443) | r.filled("http_summary") | _holds("_all", ("exploit", "cve-", "command injection", "sql injection", "xss", "../", "webshell", "payload")),
        "group_shell": exploit & (backdoor | _holds("_all", ("cmd=", "exec=", "webshell", "shell.php", "cmd.jsp"))),
        "group_chain": _any([r.filled(c) for c in ("ordered_event_summary", "exploit_to_upload_delta", "upload_to_access_delta")]) | (exploit & (implant | backdoor)) | (implant & backdoor),
        "group_access": backdoor | c2 | callback | _holds("_all", ("backdoor access", "webshell", "reverse shell", "interactive shell", "operator", "shell command")),
        "group_callback": c2 | callback | benign | service.isin("dns", "http", "https", "ssl", "tls") | r.filled("dns_summary") | r.filled("tls_summary"),
        "low": (kind == "session") & (r.number("orig_pkts") + r.number("resp_pkts") <= 3) & (r.number("orig_bytes") + r.number("resp_bytes") <= 512) & ~_any([r.filled(c) for c in SUMMARIES]),
    }


def _values(kind: DataType, c: Column) -> Column:
    """All values of a column at every depth as texts; booleans as True and False."""
    none = F.array().cast("array<string>")
    if isinstance(kind, StructType):
        return F.concat(none, *(_values(f.dataType, c[f.name]) for f in kind.fields))
    if isinstance(kind, ArrayType):
        return F.coalesce(F.flatten(F.transform(c, lambda x: _values(kind.elementType, x))), none)
    if isinstance(kind, MapType):
        return _values(ArrayType(kind.valueType), F.map_values(c))
    text = F.initcap(c.cast("string")) if isinstance(kind, BooleanType) else F.trim(c.cast("string"))
    return F.when(c.isNotNull(), F.array(text)).otherwise(none)


def _once(values: Column) -> Column:
    """Values in order, each once whatever its case; blank ones go."""
    begin = F.struct(F.array().cast("array<string>").alias("kept"), F.array().cast("array<string>").alias("keys"))
    add = lambda s, v: F.when((v == "") | v.isNull() | F.array_contains(s["keys"], F.lower(v)), s).otherwise(F.struct(F.array_append(s["kept"], v).alias("kept"), F.array_append(s["keys"], F.lower(v)).alias("keys")))
    return F.aggregate(values, begin, add)["kept"]


def _listed(rules: list[tuple[Column, list[Column] | tuple[str, ...]]]) -> Column:
    """The texts of all rules that hold, in order."""
    none = F.array().cast("array<string>")
    return F.concat(none, *(F.when(test, F.array(*(t if isinstance(t, Column) else F.lit(t) for t in texts))).otherwise(none) for test, texts in rules))


def candidate_documents(codes: Column) -> Column:
    """Documents of the boundary rules that share two of the codes, then of those that share one; six rules at most."""
    kind = "array<struct<rank:int,place:int,docs:array<string>>>"
    shared = lambda names: F.size(F.array_intersect(codes, F.array(*map(F.lit, names))))
    rules = [F.when(shared(names) > 0, F.struct(F.when(shared(names) >= 2, 0).otherwise(1).alias("rank"), F.lit(i).alias("place"), F.array(*map(F.lit, docs)).alias("docs"))) for i, (names, docs) in enumerate(CANDIDATE_RULES)]
    first = F.slice(F.array_sort(F.array_compact(F.array(*rules))), 1, MOST_RULES)
    return F.coalesce(F.flatten(F.transform(first.cast(kind), lambda x: x["docs"])), F.array().cast("array<string>"))


def query_rows(records: DataFrame, profiles: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(record_id, query, terms, matched_rules, low_signal, confusion_groups, triggers, targeted_docs, indicator_fields_used).

    Tests that several rules share are columns of their own, so each is made once for a record;
    the rules are tables of (name, test, terms or documents). Terms, triggers and documents come in
    the order of the tables, each once whatever its case; ``query`` has the first 100 terms. Words are
    looked for in values, never in names of fields. ``profiles`` has terms of its own for each code,
    for the first three of ``top_rule_candidates`` of a whole capture (record type pcap).
    """
    rows = _with_texts(records)
    rows = rows.withColumns({f"_is_{n}": F.coalesce(t, F.lit(False)) for n, t in tests(rows).items()})
    r, is_ = Row(records), lambda n: F.col(f"_is_{n}")
    none, whole = F.array().cast("array<string>"), F.coalesce(r.text("record_type") == "pcap", F.lit(False))
    values = lambda c: _values(r.kinds[c], F.col(c)) if c in r.kinds else none
    given = lambda c: r.filled(c)
    if "top_rule_candidates" in r.kinds:
        top = F.slice(F.transform("top_rule_candidates", lambda x: x["technique"]), 1, MOST_CANDIDATES)
        candidates = F.coalesce(F.filter(top, lambda x: x.isNotNull()), none)
    else:
        candidates = none
    about = F.create_map(*(x for code, terms in (profiles or {}).items() for x in (F.lit(code), F.array(*map(F.lit, terms))))) if profiles else None
    profile = F.flatten(F.transform(candidates, lambda c: F.coalesce(F.try_element_at(about, c), none))) if profiles else none
    level = F.when(whole, "pcap-level classification").otherwise("session-level classification")
    parts = [F.array(F.lit("official competition code"), level, r.kind()), *(values(c) for c in PLAIN)]
    parts += [F.when(given(c), F.array(F.concat(F.lit(f"{c}="), r.text(c)))).otherwise(none) for c in NUMBERED] + [values(c) for c in SUMMARIES]
    parts += [F.when(is_(t), F.concat(F.array(F.lit(c)), values(c))).otherwise(none) for c, t in zip(INDICATORS, ("vulnerability", "exploit", "auth", "implant", "backdoor", "c2"), strict=True)] + [values(c) for c in SEEN]
    parts += [F.when(whole, F.concat(F.array(*map(F.lit, ("whole PCAP", "aggregate sessions", "one stage per pcap", "representative suspicious sessions"))), profile)).otherwise(none)]
    parts += [_listed([(whole & is_(t), terms) for _, t, terms in CAPTURE_RULES])]
    parts += [F.when(given(c) & (is_("benign_periodic") if c == "benign_periodic_hints" else F.lit(True)), F.concat(F.array(F.lit(c)), values(c))).otherwise(none) for c in TIMED]
    for _, t, fields, terms in TERM_RULES:
        parts.append(F.when(is_(t), F.concat(F.array(*map(F.lit, terms)), *(values(c) for c in fields))).otherwise(none))
    rules = _listed([*((whole & is_(t), (n,)) for n, t, _ in CAPTURE_RULES), *((is_(t), (n,)) for n, t, _, _ in TERM_RULES)])
    groups = _listed([(is_(t), (g,)) for g, t in GROUP_RULES])
    rows = rows.withColumns({"_rules": rules, "confusion_groups": groups, "_candidates": candidates})
    quiet = F.size("_rules") == 0
    low = quiet & is_("low")
    parts += [F.when(quiet, F.array(*map(F.lit, NORMAL_TERMS))).otherwise(none), _listed([(is_(t), (g, BOUNDARY[g])) for g, t in GROUP_RULES])]
    any_candidate = F.size("_candidates") > 0
    triggers = F.concat(_listed([(any_candidate, ("top_rule_candidates=positive",))]), _listed([(is_(t), (n,)) for n, t, _ in TRIGGERS]))
    docs = F.concat(candidate_documents(F.col("_candidates")), _listed([(is_(t), d) for _, t, d in TRIGGERS]), F.transform("confusion_groups", lambda g: F.element_at(F.create_map(*(F.lit(x) for pair in BOUNDARY.items() for x in pair)), g)))
    named = F.transform("confusion_groups", lambda g: F.concat(F.lit("confusion_boundary:"), g))
    default = F.when(low, F.array(F.lit(LOW_RULE))).when(quiet, F.array(F.lit(DEFAULT_RULE))).otherwise(none)
    used = _listed([*((is_(t), (c,)) for c, t in zip(INDICATORS, ("vulnerability", "exploit", "auth", "implant", "backdoor", "c2"), strict=True)), (is_("encrypted"), ("payload_visibility",))])
    rows = rows.withColumns({"terms": _once(F.concat(*parts)), "matched_rules": F.concat("_rules", default, named), "low_signal": low, "triggers": _once(triggers), "targeted_docs": _once(docs), "indicator_fields_used": used})
    query = F.array_join(F.slice("terms", 1, QUERY_TERMS), " ")
    return rows.select("record_id", query.alias("query"), "terms", "matched_rules", "low_signal", "confusion_groups", "triggers", "targeted_docs", "indicator_fields_used")
