"""Indicator flags of a session's visible text, requests and files.

Input rows have ``text`` (all visible text of a session), ``agents`` and ``uris`` (joined by
blanks), ``uri_list`` and ``statuses`` (arrays) and the file hints of ``file_rollup``. Each
function adds one struct of booleans with a fixed set of fields; nothing leaves the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import first_values
from ..functions.text import LISTS, SIGNATURES, decode_visible_text, has, match_signatures, redact_sensitive_text, suspicious_contexts
from ..functions.values import is_failed, safe_long

#: Hints that are not signatures of their own.
FILE_INCLUSION = r"(?i)(?:file|page|include|template)=.*(?:\.\./|/etc/passwd)"
DESERIALIZATION = r"(?i)(?:rO0AB|aced0005|ysoserial|objectinputstream)"
WINDOWS_COMMAND = r"(?i)\b(?:dir|net user|ipconfig)\b"
LINUX_COMMAND = r"(?i)\b(?:whoami|uname|ifconfig)\b"
VERSION_PROBE = r"(?i)(?:nmap.*(?:service|version)|http-enum|banner)"
MASS_SCAN = r"(?i)\b(?:masscan|zmap)\b"
#: Each exploit flag as any of these patterns. Fixed values.
EXPLOIT = {
    "command_injection": [SIGNATURES[n] for n in ("command_separator", "xp_cmdshell", "jndi", "eval")],
    "sql_injection": [SIGNATURES["sql_injection"], SIGNATURES["xp_cmdshell"]],
    "xss": [SIGNATURES["xss"]],
    "path_traversal": [SIGNATURES["path_traversal"]],
    "file_inclusion": [FILE_INCLUSION],
    "deserialization_hint": [DESERIALIZATION],
    "shell_command_keyword": [SIGNATURES["shell_command_keyword"], SIGNATURES["bin_shell"]],
    "windows_command_keyword": [SIGNATURES["cmd_exe"], SIGNATURES["powershell"], WINDOWS_COMMAND],
    "linux_command_keyword": [SIGNATURES["bin_shell"], SIGNATURES["shell_command_keyword"], LINUX_COMMAND],
    "xp_cmdshell": [SIGNATURES["xp_cmdshell"]],
    "powershell": [SIGNATURES["powershell"]],
    "cmd_exe": [SIGNATURES["cmd_exe"]],
    "wget_curl_download": [SIGNATURES["download_command"]],
    "encoded_payload_hint": [SIGNATURES["encoded_payload"]],
    "suspicious_params": [LISTS["command_param"]],
}


def _hit(text: Column, *patterns: str) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | has(text, p)
    return F.coalesce(out, F.lit(False))


def exploit_flags(rows: DataFrame) -> DataFrame:
    """Add ``exploit``: fifteen flags, and the signature names that hit. Null text sets none."""
    text = F.coalesce("text", F.lit(""))
    return rows.withColumn("exploit", F.struct(*(_hit(text, *p).alias(n) for n, p in EXPLOIT.items()), match_signatures(text).alias("matched_keywords")))


def vuln_scan_flags(rows: DataFrame, fanout: int = 8, codes: int = 4, share: float = 0.6) -> DataFrame:
    """Add ``vuln_scan``: scanner agents, probes, path fan-out and share of 404 (of at least ``codes`` answers)."""
    agents, uris = F.lower(F.coalesce("agents", F.lit(""))), F.coalesce("uris", F.lit(""))
    missing = F.size(F.filter("statuses", lambda s: s == 404))
    return rows.withColumn("vuln_scan", F.struct(
        F.contains(agents, F.lit("nikto")).alias("nikto_user_agent"), F.contains(agents, F.lit("openvas")).alias("openvas_user_agent"),
        _hit(agents, "nmap scripting engine|nmap-nse").alias("nmap_nse_user_agent"), _hit(agents, MASS_SCAN).alias("masscan_zmap_vs_vulnscan_hint"),
        _hit(F.concat_ws(" ", agents, uris), VERSION_PROBE).alias("service_version_probe"), _hit(F.coalesce("text", F.lit("")), SIGNATURES["cve"]).alias("cve_probe_hint"),
        _hit(uris, LISTS["probe_path"]).alias("suspicious_probe_path"), (F.size(F.array_distinct(F.coalesce("uri_list", F.array().cast("array<string>")))) >= fanout).alias("high_uri_fanout"),
        F.coalesce((F.size("statuses") >= codes) & (missing >= share * F.size("statuses")), F.lit(False)).alias("high_404_rate"), _hit(agents, LISTS["scanner"]).alias("scanner_user_agent"),
    ))


def vuln_scan_rollup(requests: DataFrame, keys: list[str], fanout: int = 8, codes: int = 4, share: float = 0.6) -> DataFrame:
    """The fields of ``vuln_scan_flags`` for each group of ``requests(agents, uris, text, status)``, one row a request.

    Every request's texts are read where they stand and only flags and counts are gathered, so
    a group may have any size. Null texts set no flag, null codes aren't answers.
    """
    one = vuln_scan_flags(requests.select(*keys, "agents", "uris", "text", "status", F.array("uris").alias("uri_list"), F.array("status").alias("statuses")))
    plain = [f for f in one.schema["vuln_scan"].dataType.names if f not in ("high_uri_fanout", "high_404_rate")]
    answers, missing = F.count("status"), F.count_if(F.col("status") == 404)
    return one.groupBy(*keys).agg(
        *(F.bool_or(f"vuln_scan.{f}").alias(f) for f in plain), (F.countDistinct("uris") >= fanout).alias("high_uri_fanout"), ((answers >= codes) & (missing >= share * answers)).alias("high_404_rate"),
    )


def implant_backdoor_flags(rows: DataFrame) -> DataFrame:
    """Add ``implant`` and ``backdoor``: uploads and file placement, and access to placed shells."""
    text, uris = F.coalesce("text", F.lit("")), F.coalesce("uri_list", F.array().cast("array<string>"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    upload = _hit(text, LISTS["upload"]) | (flag("sent_file") & (flag("executable_hint") | flag("archive_hint")))
    download, shell = _hit(text, SIGNATURES["download_command"]), _hit(text, LISTS["web_shell"])
    command = _hit(text, *EXPLOIT["shell_command_keyword"], *EXPLOIT["windows_command_keyword"], *EXPLOIT["linux_command_keyword"])
    implant = F.struct(
        upload.alias("upload_to_server_hint"), _hit(text, r"(?i)multipart/form-data").alias("multipart_upload"), (upload & _hit(text, LISTS["suspicious_file"])).alias("suspicious_uploaded_filename"),
        shell.alias("webshell_extension_hint"), download.alias("payload_download_hint"), (download & flag("executable_hint")).alias("dropper_download_hint"),
        (flag("archive_hint") | flag("executable_hint")).alias("archive_or_executable_transfer_hint"), (F.coalesce(F.col("method").isin("PUT", "POST"), F.lit(False)) & _hit(text, LISTS["upload"])).alias("file_write_like_request"),
    )
    backdoor = F.struct(
        shell.alias("webshell_path_hint"), _hit(text, LISTS["command_param"]).alias("command_param_hint"), command.alias("interactive_command_hint"), (shell & F.col("method").isNotNull()).alias("attacker_initiated_access_hint"),
        (F.size(F.filter(uris, lambda u: has(u, LISTS["web_shell"]))) >= 2).alias("repeated_backdoor_endpoint_access"),
    )
    return rows.withColumns({"implant": implant, "backdoor": backdoor})


def file_rollup(files: DataFrame) -> DataFrame:
    """One row for each (capture_id, uid) of ``files(filename, mime_type, is_orig)``: counts, directions and kind hints."""
    name, mime = F.coalesce("filename", F.lit("")), F.lower(F.coalesce("mime_type", F.lit("")))
    sent = F.lower(F.col("is_orig").cast("string")).isin("t", "true", "1")
    any_of = lambda test: F.bool_or(F.coalesce(test, F.lit(False)))
    return files.groupBy("capture_id", "uid").agg(
        F.count("*").alias("total_files"), F.countDistinct("filename").alias("different_names"), any_of(sent).alias("sent_file"), any_of(~sent).alias("received_file"),
        any_of(_hit(name, LISTS["suspicious_file"]) | _hit(mime, "executable|x-dosexec|x-sh|java-archive")).alias("executable_hint"),
        any_of(_hit(name, LISTS["archive"]) | _hit(mime, "archive|zip")).alias("archive_hint"), any_of(_hit(name, LISTS["static"]) | mime.startswith("image/")).alias("static_hint"),
    )


def file_summary(files: DataFrame, order: str = "ord") -> DataFrame:
    """``file_rollup`` and the first five different names (redacted), the first five MIME types, and up to two directions."""
    keys = ["capture_id", "uid"]
    sent = F.lower(F.col("is_orig").cast("string"))
    way = F.when(sent.isin("t", "true", "1"), "originator_to_responder").when(sent.isin("f", "false", "0"), "responder_to_originator")
    shown = files.select(*keys, order, redact_sensitive_text(F.col("filename"), 160).alias("filename_sample"), F.col("mime_type").alias("mime_type_sample"), way.alias("direction_hint"))
    limits = {"filename_sample": 5, "mime_type_sample": 5, "direction_hint": 2}
    out = file_rollup(files).join(first_values(shown, keys, order, limits), keys, "left")
    return out.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in limits})


def auth_flags(rows: DataFrame) -> DataFrame:
    """One row for each (capture_id, uid) of ``rows(ord, login_path, status, ftp_command, ftp_code, ssh_attempts)``.

    Attempts: the most of login paths, SSH attempts and PASS commands. Failures: HTTP 401, 403 and
    407 and FTP 430 and 530. A success after an earlier failure is an HTTP 2xx or FTP 230 that follows one.
    """
    failed = F.coalesce(F.col("status").isin(401, 403, 407), F.lit(False)) | F.coalesce(F.col("ftp_code").isin(430, 530), F.lit(False))
    passed = F.coalesce(F.col("status").between(200, 299), F.lit(False)) | F.coalesce(F.col("ftp_code") == 230, F.lit(False))
    first_failure, last_success = F.min(F.when(failed, F.col("ord"))), F.max(F.when(passed, F.col("ord")))
    return rows.groupBy("capture_id", "uid").agg(
        F.greatest(F.count_if("login_path"), F.coalesce(F.max("ssh_attempts"), F.lit(0)), F.count_if(F.upper("ftp_command") == "PASS")).alias("session_auth_attempt_count"),
        F.count_if(failed).alias("failed_login_count"), F.coalesce(last_success > first_failure, F.lit(False)).alias("success_after_failure"),
        F.bool_or(F.coalesce(F.upper("ftp_command") == "USER", F.lit(False))).alias("username_field_seen"), F.bool_or(F.coalesce(F.upper("ftp_command") == "PASS", F.lit(False))).alias("password_field_seen"),
    )


#: What makes a login, and codes of its answers.
LOGIN_FAILED, LOGIN_PASSED, FTP_FAILED, FTP_PASSED = ("401", "403", "407"), ("200", "204", "302"), ("430", "530"), ("230",)
USER_PARAMETER, PASSWORD_PARAMETER = r"(?i)^(?:user|username)=", r"(?i)^(?:password|passwd|pwd)="
LOGIN_LISTS = {"http_login_paths": 5, "auth_status_codes": 5, "ftp_response_codes": 5}


def login_indicators(http: DataFrame, ftp: DataFrame, ssh: DataFrame) -> DataFrame:
    """(capture_id, uid, auth_indicators) of every session that one of the logs knows.

    ``http(capture_id, uid, ord, uri, status, auth_header, parameters)`` has a row a request,
    ``ftp(capture_id, uid, ord, command, arg, reply_code)`` and ``ssh(capture_id, uid, auth_attempts,
    auth_success)`` their log rows. Attempts: the most of login paths, attempts of one SSH row and PASS
    commands. Failures add up: HTTP 401, 403 and 407 of sessions in which a login shows, FTP 430 and 530, and
    SSH rows that failed, each for its attempts. A success after failures is an FTP 230 that follows one,
    or any HTTP 200, 204 or 302 beside one. User names are counted, never kept.
    """
    keys = ["capture_id", "uid"]
    any_of = lambda test: F.coalesce(F.bool_or(test), F.lit(False))
    path, code = F.coalesce(has(F.col("uri"), LISTS["login_path"]), F.lit(False)), F.col("status").cast("string")
    web = http.groupBy(*keys).agg(
        F.count_if(path).alias("paths"), any_of(path | F.coalesce("auth_header", F.lit(False))).alias("web"), F.count_if(code.isin(*LOGIN_FAILED)).alias("refused"), any_of(code.isin(*LOGIN_PASSED)).alias("passed"),
        any_of(F.exists("parameters", lambda p: has(p, USER_PARAMETER))).alias("user"), any_of(F.exists("parameters", lambda p: has(p, PASSWORD_PARAMETER))).alias("password"),
    )
    command, reply = F.upper(F.coalesce("command", F.lit(""))), F.col("reply_code").cast("string")
    name = F.when((command == "USER") & ~F.col("arg").isin("", "-", "[REDACTED]"), F.col("arg"))
    files = ftp.groupBy(*keys).agg(
        F.count_if(command == "PASS").alias("pass"), any_of(command == "USER").alias("ftp_user"), F.countDistinct(name).alias("names"), F.count_if(reply.isin(*FTP_FAILED)).alias("ftp_failed"),
        F.coalesce(F.max(F.when(reply.isin(*FTP_PASSED), F.col("ord"))) > F.min(F.when(reply.isin(*FTP_FAILED), F.col("ord"))), F.lit(False)).alias("ftp_late"), F.lit(True).alias("ftp"),
    )
    tries, failed = F.coalesce(safe_long(F.col("auth_attempts")), F.lit(0).cast("long")), F.lower(F.col("auth_success").cast("string")).isin("f", "false")
    shells = ssh.groupBy(*keys).agg(F.max(tries).alias("tries"), any_of(failed).alias("ssh_failed"), F.sum(F.when(failed, F.greatest(tries, F.lit(1)))).alias("ssh_failures"), F.lit(True).alias("ssh"))
    out = web.join(files, keys, "full").join(shells, keys, "full")
    wide = http.select(*keys, F.struct(F.lit(0).alias("log"), F.col("ord").cast("long").alias("ord")).alias("at"), F.when(path, F.col("uri")).alias("http_login_paths"), F.when(code.isin(*LOGIN_FAILED, *LOGIN_PASSED), code).alias("auth_status_codes"), F.lit(None).cast("string").alias("ftp_response_codes"))
    long = ftp.select(*keys, F.struct(F.lit(1).alias("log"), F.col("ord").cast("long").alias("ord")).alias("at"), F.lit(None).cast("string").alias("http_login_paths"), F.lit(None).cast("string").alias("auth_status_codes"), reply.alias("ftp_response_codes"))
    out = out.join(first_values(wide.unionByName(long), keys, "at", LOGIN_LISTS), keys, "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    yes = lambda c: F.coalesce(c, F.lit(False))
    shown = yes("web") | yes("ftp") | yes("ssh")
    refused = F.when(shown, n("refused")).otherwise(0)
    attempts = F.greatest(n("paths"), n("tries"), n("pass"))
    failures = refused + n("ftp_failed") + n("ssh_failures")
    listed = lambda c: F.coalesce(c, F.array().cast("array<string>")).alias(c)
    return out.select(*keys, F.struct(
        F.when(yes("ssh"), "ssh").when(yes("ftp"), "ftp").when(yes("web"), "http").otherwise("unknown").alias("auth_protocol"), (attempts >= 5).alias("repeated_login_attempts"), (failures > 0).alias("failed_login_hint"),
        (yes("ftp_late") | ((refused > 0) & yes("passed"))).alias("success_after_failures_hint"), listed("http_login_paths"), F.when(shown, listed("auth_status_codes")).otherwise(F.array().cast("array<string>")).alias("auth_status_codes"),
        attempts.alias("session_auth_attempt_count"), attempts.alias("same_src_same_dst_auth_attempts"), (yes("user") | yes("ftp_user")).alias("username_field_seen"), (yes("password") | (n("pass") > 0)).alias("password_field_seen"),
        F.when(n("names") > 0, F.col("names")).otherwise(yes("user").cast("long")).alias("unique_usernames_seen"), failures.alias("failed_login_count"), listed("ftp_response_codes"), yes("ssh_failed").alias("ssh_auth_failure_hint"),
        ((attempts >= 5) & (failures == 0)).alias("weak_evidence"),
    ).alias("auth_indicators"))


#: Form keys whose values are never shown, and others that are worth showing; how many keys are read.
SECRET_KEYS = ("username", "user", "password", "passwd", "pwd", "token", "authorization", "cookie", "sessionid", "session_id", "jwt")
TELLING_KEYS, MOST_KEYS = ("cmd", "command", "exec", "action", "file", "path", "url", "username", "user"), 10


def form_parameters(keys: Column, values: Column) -> Column:
    """key=value of the form fields that tell something: those of signatures, secrets (their values hidden) and commands; each once."""
    pairs = F.slice(F.zip_with(keys, F.slice(F.concat(values, F.array_repeat(F.lit(""), F.size(keys))), F.lit(1), F.size(keys)), lambda k, v: F.struct(k.alias("k"), v.alias("v"))), 1, MOST_KEYS)

    def shown(x: Column) -> Column:
        key = redact_sensitive_text(x["k"], 80)
        secret = F.lower(key).isin(*SECRET_KEYS)
        value = F.when(secret, "[REDACTED]").otherwise(redact_sensitive_text(x["v"], 100))
        telling = (F.size(match_signatures(decode_visible_text(x["v"]))) > 0) | secret | F.lower(key).isin(*TELLING_KEYS)
        return F.when(telling, F.when(value != "", F.concat(key, F.lit("="), value)).otherwise(key))

    return F.array_distinct(F.array_compact(F.transform(pairs, shown)))


def http_observation(rows: DataFrame, uri_limit: int = 320, body_limit: int = 32768) -> DataFrame:
    """Bounded, safe rows of ``rows(method, host, uri, status, agent, cookie, authorization, body, ...)``.

    Texts are decoded and redacted, headers become flags, bodies only leave signature names and
    redacted windows around what they hit. ``full_uri``, ``referrer``, ``content_type``,
    ``content_length`` and the form fields ``form_keys`` and ``form_values`` (parts parted by |)
    may be missing. Rows in which nothing is visible are dropped.
    """
    optional = ("full_uri", "referrer", "content_type", "content_length", "form_keys", "form_values")
    full = rows.withColumns({c: F.lit(None).cast("string") for c in optional if c not in rows.columns})
    body = F.left(F.coalesce("body", F.lit("")), F.lit(body_limit))
    seen = lambda c: F.coalesce(F.col(c).cast("string") != "", F.lit(False))
    visible = seen("method") | seen("host") | seen("uri") | seen("full_uri") | seen("status") | seen("content_type") | seen("agent") | seen("body")
    role = F.when(seen("method"), "request").when(safe_long(F.col("status")).isNotNull(), "response").otherwise("unknown")
    keep = [c for c in rows.columns if c not in ("method", "host", "uri", "status", "agent", "cookie", "authorization", "body", *optional)]
    parts = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), "\\|"), lambda x: x != "")
    full = full.where(visible).withColumns({"_uri": redact_sensitive_text(F.col("uri"), uri_limit), "_url": redact_sensitive_text(F.col("full_uri"), uri_limit)})
    uri, url = F.col("_uri"), F.col("_url")
    form = F.array_join(F.zip_with(parts("form_keys"), parts("form_values"), lambda k, v: F.concat_ws("=", k, v)), "&")  # a secret value stays beside its key
    combined = F.concat_ws(" ", uri, url, body, form)
    full = full.withColumn("_seen", decode_visible_text(combined))  # columns of their own, so that many patterns read one decoded text
    return full.select(
        *keep, role.alias("body_role"), "method", redact_sensitive_text(F.col("host"), 160).alias("host"), uri.alias("uri"), url.alias("full_uri"), safe_long(F.col("status")).alias("status_code"),
        redact_sensitive_text(F.col("agent"), 180).alias("user_agent"), redact_sensitive_text(F.col("referrer"), uri_limit).alias("referrer"), redact_sensitive_text(F.col("content_type"), 120).alias("content_type"), safe_long(F.col("content_length")).alias("content_length"),
        seen("cookie").alias("cookie_present"), seen("authorization").alias("auth_header_present"), seen("body").alias("body_observed"), suspicious_contexts(body, 3).alias("body_snippets_sanitized"), suspicious_contexts(combined).alias("suspicious_payload_snippets"),
        form_parameters(parts("form_keys"), parts("form_values")).alias("suspicious_http_parameters"), match_signatures(F.concat_ws(" ", uri, url)).alias("suspicious_uri_patterns"), match_signatures(F.col("_seen")).alias("matched_keywords"),
    )


def visibility_summary(sessions: DataFrame, strict: bool = False) -> DataFrame:
    """(capture_id, sessions, encrypted_records, failed): a protocol named ``none`` counts as encrypted unless ``strict``."""
    named = F.coalesce(F.col("encrypted_protocol") != "", F.lit(False))
    encrypted = named & (F.col("encrypted_protocol") != "none") if strict else named
    return sessions.groupBy("capture_id").agg(F.count("*").alias("sessions"), F.count_if(encrypted).alias("encrypted_records"), F.count_if(is_failed(F.col("conn_state"))).alias("failed"))
