"""From rows of sessions and groups to a capture's evidence: suspicion, payload texts, and the inputs of its scores.

A row may be a session or a behaviour group. All columns but ``capture_id`` may be missing; one that
is counts as null. Indicators are structs of flags, counts and lists, or single flags.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, NumericType, StringType, StructType

from ..functions.aggregates import first_values, frequent_values
from ..functions.text import MINER, SENSITIVE_PATH, has, redact_sensitive_text
from ..functions.values import is_failed

#: The six indicators, and the fields that hold payload texts, in order.
INDICATORS = ("vuln_scan_indicators", "exploit_indicators", "auth_indicators", "implant_indicators", "backdoor_access_indicators", "c2_indicators")
PAYLOADS = ("suspicious_payload_snippets", "request_body_snippets_sanitized", "response_body_snippets_sanitized", "suspicious_http_parameters", "suspicious_uri_patterns", "http_upload_hints")
#: Parts of an indicator that are no evidence of their own, and the flags that count for logins and callbacks in a session.
NO_EVIDENCE = ("weak_evidence", "auth_protocol", "interval_summary", "beacon_score")
LOGIN_SIGNS = ("repeated_login_attempts", "failed_login_hint", "success_after_failures_hint", "username_field_seen", "password_field_seen")
CALLBACK_SIGNS = ("periodic_connections", "dns_repeated_query", "tls_sni_repeated")
#: Ports of services that are logged in to.
LOGIN_PORTS = (21, 22, 23, 25, 110, 143, 389, 445, 1433, 1521, 3306, 3389, 5432, 5900, 6379, 9200)
#: What the texts of a capture's rows show.
WEB_SHELL = r"(?i)/(?:shell|cmd|webshell|chopper|c99|r57)\.(?:php|jsp|jspx|asp|aspx)\b"
COMMAND = r"(?i)(?:[?&](?:cmd|command|exec|action)=|(?:whoami|ipconfig|ifconfig|uname|id)(?:\b|%))"
PLACEMENT = (
    r"(?i)(?:multipart/form-data|\bfilename\s*=|/(?:upload|uploads|plugin/install|admin/upload)\b|\.(?:php|jsp|jspx|asp|aspx|war|exe|dll|elf|sh|py)(?:$|[?&#/])"
    r"|(?:/var/www|/wwwroot|/webapps|htdocs|server-side path|dropped file|write file))"
)
BENIGN = r"(?i)(?:steam|valve|depot|chunk|application/x-steam-chunk|cdn|static|assets|update|updater|download|patch|manifest|\.css\b|\.js\b|\.png\b|\.jpe?g\b|\.gif\b|\.ico\b|ocsp|crl|ntp)"
PHP_PAGE = r"(?i)/[^/?#]{1,80}\.php\b"
#: Columns that name rows rather than show what happened in them.
NAMES = ("capture_id", "session_id", "record_id", "record_type", "uid", "parser_source", "candidate_hint", "conn_state", "proto")


def _no(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, map(_no, tests), F.lit(False))


def positive(kind: DataType, c: Column, variant: str = "capture") -> Column:
    """Whether an indicator of this type is set.

    Booleans count when true, arrays when not empty, structs and maps when a part of them counts.
    Numbers above zero count only in variant ``capture``. In variant ``session``, logins and
    callbacks count by their signs alone, callbacks also with a beacon score of 0.5.
    """
    if isinstance(kind, BooleanType):
        return _no(c)
    if isinstance(kind, NumericType):
        return _no(c > 0) if variant == "capture" else F.lit(False)
    if isinstance(kind, ArrayType):
        return _no(F.size(c) > 0)
    if isinstance(kind, MapType):
        return _no(F.exists(F.map_values(c), lambda x: positive(kind.valueType, x, variant)))
    if isinstance(kind, StructType):
        names = kind.names
        if variant == "session" and "auth_protocol" in names:
            return _any([c[n].cast("boolean") for n in LOGIN_SIGNS if n in names])
        if variant == "session" and "beacon_score" in names:
            return _any([c["beacon_score"] >= 0.5, *(c[n].cast("boolean") for n in CALLBACK_SIGNS if n in names)])
        return _any([positive(f.dataType, c[f.name], variant) for f in kind.fields if f.name not in NO_EVIDENCE])
    return F.lit(False)


def filled(kind: DataType, c: Column) -> Column:
    """Whether a value is there: not null, empty or '-'; for structs, whether any part is."""
    if isinstance(kind, StringType):
        return _no(~c.isin("", "-"))
    if isinstance(kind, ArrayType | MapType):
        return _no(F.size(c) > 0)
    if isinstance(kind, StructType):
        return _any([filled(f.dataType, c[f.name]) for f in kind.fields])
    return c.isNotNull()


class Row:
    """Columns of a table that may lack them."""

    def __init__(self, rows: DataFrame):
        self.kinds = {f.name: f.dataType for f in rows.schema}

    def text(self, name: str) -> Column:
        return F.col(name).cast("string") if name in self.kinds else F.lit(None).cast("string")

    def number(self, *names: str) -> Column:
        """The largest of some numbers, missing ones being 0; a name may reach into a struct."""
        found = [F.coalesce(F.expr(f"try_cast({n} AS DOUBLE)"), F.lit(0.0)) for n in names if self._there(n)]
        return F.greatest(F.lit(0.0), F.lit(0.0), *found)

    def _there(self, name: str) -> bool:
        head, _, rest = name.partition(".")
        return head in self.kinds and (not rest or (isinstance(self.kinds[head], StructType) and rest in self.kinds[head].names))

    def flag(self, name: str) -> Column:
        return _no(F.col(name).cast("boolean")) if self._there(name) else F.lit(False)

    def positive(self, name: str, variant: str = "capture") -> Column:
        return positive(self.kinds[name], F.col(name), variant) if name in self.kinds else F.lit(False)

    def filled(self, name: str) -> Column:
        return filled(self.kinds[name], F.col(name)) if name in self.kinds else F.lit(False)

    def kind(self) -> Column:
        return F.coalesce(self.text("record_type"), F.lit("session"))

    def id(self) -> Column:
        return F.coalesce(F.nullif(self.text("record_id"), F.lit("")), self.text("session_id"))

    def list(self, name: str) -> Column:
        kind = self.kinds.get(name)
        if isinstance(kind, ArrayType):
            return F.transform(F.col(name), lambda x: x.cast("string"))
        return F.array(self.text(name)) if kind else F.array().cast("array<string>")


def suspicion_scores(rows: DataFrame) -> DataFrame:
    """All rows with ``suspicion``, its ``reasons`` and the names of the indicators that are set.

    Weights are fixed values; volume (packets, and bytes by 4096) adds up to 15. Without any rule
    that holds, the reason is benign_context.
    """
    r = Row(rows)
    rules = (
        (55, "scan_high_fanout", (r.kind() == "scan_group") | (r.number("same_src_unique_dst_ports", "unique_dst_ports", "same_src_unique_dst_ips") >= 8)),
        (15, "failed_connection_rate", r.number("same_src_failed_conn_rate", "failed_conn_rate") >= 0.5),
        (50, "auth_failures", (r.kind() == "auth_attempt_group") | (r.number("failed_login_count", "auth_indicators.failed_login_count") > 0) | (r.number("attempt_count", "same_src_same_dst_auth_attempts") >= 5) | r.positive("auth_indicators")),
        (50, "beacon_or_c2", (r.kind() == "c2_callback_group") | (r.number("beacon_score", "regularity_score", "periodicity_score", "c2_indicators.beacon_score") >= 0.5) | r.positive("c2_indicators")),
        (48, "exploit_or_command_payload", r.positive("exploit_indicators")),
        (38, "vulnerability_scan", r.positive("vuln_scan_indicators")),
        (42, "upload_or_multipart", r.positive("implant_indicators") | r.flag("http_multipart_present") | r.filled("http_upload_hints")),
        (42, "backdoor_or_webshell", r.positive("backdoor_access_indicators")),
        (22, "observable_payload", _any([r.filled(c) for c in PAYLOADS])),
    )
    volume = r.number("orig_pkts") + r.number("resp_pkts") + (r.number("orig_bytes") + r.number("resp_bytes")) / 4096
    score = reduce(lambda s, x: s + F.when(x[2], x[0]).otherwise(0), rules, F.least(F.lit(15), F.floor(volume)))
    reasons = F.array_compact(F.array(*(F.when(test, F.lit(name)) for _, name, test in rules)))
    active = F.array_compact(F.array(*(F.when(r.positive(c), F.lit(c)) for c in INDICATORS)))
    return rows.withColumns({"suspicion": score.cast("long"), "reasons": F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("benign_context"))), "active_indicators": active})


def suspicion_rank(rows: DataFrame, k: int = 8) -> DataFrame:
    """Each capture's k most suspicious rows with rank, score and reasons; ties by start (unknown last), then id as text."""
    r = Row(rows)
    start = F.col("start_time") if "start_time" in r.kinds else F.lit(None).cast("double")
    best = Window.partitionBy("capture_id").orderBy(F.desc("suspicion"), F.asc_nulls_last(start), F.coalesce(r.id(), F.lit("")))
    return suspicion_scores(rows).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def payload_evidence(scored: DataFrame, fields: tuple[str, ...] = PAYLOADS, k: int = 5) -> DataFrame:
    """(capture_id, place, text, source_record_id, source_record_type, field): the first k different redacted texts of each capture.

    ``scored`` holds all of a capture's rows with their suspicion. Texts come by suspicion, then
    record id as text (sessions, which have none, first, by their start and id), then field, then
    place in the field; case doesn't count. Texts are decoded and redacted, 220 characters at most.
    """
    r = Row(scored)
    start = F.col("start_time") if "start_time" in r.kinds else F.lit(None).cast("double")
    row = F.struct((-F.col("suspicion")).alias("minus"), F.coalesce(r.text("record_id"), F.lit("")).alias("id"), start.isNull().alias("unknown"), start.alias("start"), F.coalesce(r.id(), F.lit("")).alias("any"))
    cells = [F.transform(r.list(c), lambda v, j: F.struct(F.lit(i).alias("field"), j.alias("at"), v.alias("text"))) for i, c in enumerate(fields)]  # noqa: B023
    listed = F.concat(*(F.coalesce(c, F.array().cast("array<struct<field:int,at:int,text:string>>")) for c in cells))
    found = scored.select("capture_id", row.alias("row"), r.id().alias("id"), r.kind().alias("kind"), F.explode(listed).alias("x"))
    found = found.where(~F.col("x.text").isin("-")).withColumn("text", redact_sensitive_text(F.col("x.text"), 220)).where("text <> ''")
    firsts = found.groupBy("capture_id", F.lower("text").alias("_key")).agg(F.min(F.struct("row", "x.field", "x.at", "text", "id", "kind")).alias("f"))
    placed = firsts.withColumn("place", F.row_number().over(Window.partitionBy("capture_id").orderBy("f"))).where(F.col("place") <= k)
    return placed.select("capture_id", "place", "f.text", F.col("f.id").alias("source_record_id"), F.col("f.kind").alias("source_record_type"), F.element_at(F.array(*map(F.lit, fields)), F.col("f.field") + 1).alias("field"))


def value_text(rows: DataFrame, but: tuple[str, ...] = NAMES) -> Column:
    """All texts of a row, at every depth, joined by blanks; never the names of its fields."""

    def texts(kind: DataType, c: Column) -> list[Column]:
        if isinstance(kind, StringType):
            return [c]
        if isinstance(kind, StructType):
            return [t for f in kind.fields for t in texts(f.dataType, c[f.name])]
        if isinstance(kind, ArrayType):
            inner = lambda x: F.concat_ws(" ", *texts(kind.elementType, x))
            return [F.array_join(F.transform(c, inner), " ")] if texts(kind.elementType, F.lit(None)) else []
        return texts(ArrayType(kind.valueType), F.map_values(c)) if isinstance(kind, MapType) else []

    return F.concat_ws(" ", *(t for f in rows.schema if f.name not in but for t in texts(f.dataType, F.col(f"`{f.name}`"))))


def capture_inputs(rows: DataFrame, strict: bool = False) -> DataFrame:
    """One row for each capture: the counts and flags that ``candidate_scores`` takes, in one pass over its rows.

    Patterns look at the texts of a row, never at names of fields; a web shell and a command
    may stand in different rows, a POST and the PHP page in one. ``payload`` counts rows with
    suspicious snippets and rows with any payload text. A protocol named ``none`` counts as encrypted
    unless ``strict``. Repeated logins take the number of sessions of a service from
    ``same_src_same_dst_port_count``.
    """
    r = Row(rows)
    fan = r.number("unique_dst_ports", "same_src_unique_dst_ports")
    scan = (r.kind() == "scan_group") | (fan >= 8)
    login = (r.kind() == "auth_attempt_group") | r.positive("auth_indicators") | (r.number("failed_login_count") > 0)
    beacon = (r.kind() == "c2_callback_group") | r.positive("c2_indicators") | (r.number("beacon_score", "periodicity_score", "regularity_score") >= 0.5)
    protocol = F.coalesce(r.text("encrypted_protocol"), F.lit(""))
    encrypted = _no(r.text("payload_visibility") == "encrypted_tls") | (~protocol.isin("", "none") if strict else protocol != "")
    port = F.expr("try_cast(try_cast(dst_port AS DOUBLE) AS INT)") if "dst_port" in r.kinds else F.lit(None).cast("int")
    on_login_port = _no(port.isin(*LOGIN_PORTS))
    short = _no(is_failed(r.text("conn_state"))) | (r.number("resp_pkts") == 0) | (r.number("resp_bytes") == 0)
    said = rows.withColumn("_said", F.concat(value_text(rows), F.lit(" ")))  # no text ends the row
    post = _any([F.exists(r.list("http_methods"), lambda m: F.upper(m) == "POST"), has(F.col("_said"), r"\bPOST\b")])
    most = lambda n, test: F.max(F.when(test, n))
    out = said.groupBy("capture_id").agg(
        most(fan, scan).cast("long").alias("port_fanout"), F.count_if(scan).alias("scan_rows"), F.round(most(r.number("failed_conn_rate", "same_src_failed_conn_rate"), scan), 4).alias("failed_rate"),
        *(F.count_if(r.positive(c)).alias(n) for n, c in (("vulnerability", "vuln_scan_indicators"), ("exploit", "exploit_indicators"), ("auth_rows", "auth_indicators"), ("implant", "implant_indicators"), ("backdoor", "backdoor_access_indicators"), ("callback", "c2_indicators"))),
        (F.count_if(r.filled("suspicious_payload_snippets")) + F.count_if(_any([r.filled(c) for c in PAYLOADS]))).alias("payload"),
        F.coalesce(F.sum(F.when(login, r.number("failed_login_count"))), F.lit(0.0)).cast("long").alias("login_failures"), F.coalesce(most(r.number("attempt_count"), login), F.lit(0.0)).cast("long").alias("login_attempts"),
        *(F.bool_or(_no(has(F.col("_said"), p))).alias(n) for n, p in (("sensitive_path", SENSITIVE_PATH), ("web_shell", WEB_SHELL), ("command", COMMAND), ("miner", MINER), ("benign", BENIGN))),
        F.bool_or(r.flag("http_multipart_present") | r.filled("http_upload_hints") | r.filled("transferred_files_summary") | _no(has(F.col("_said"), PLACEMENT))).alias("placement"),
        F.bool_or(post & _no(has(F.col("_said"), PHP_PAGE))).alias("php_post"), F.bool_or(beacon).alias("beacon"), F.bool_or(encrypted).alias("encrypted"),
        F.count_if(on_login_port).alias("_logins"), F.max(r.number("same_src_same_dst_port_count")).alias("_same"), F.count_if(on_login_port & short).alias("_short"),
    )
    repeated = (F.col("_logins") >= 10) & ((F.col("_logins") >= 20) | (F.col("_same") >= 10) | (F.col("_short") >= 5))
    return out.withColumns({"repeated_auth": repeated, "port_fanout": F.coalesce("port_fanout", F.lit(0).cast("long")), "failed_rate": F.coalesce("failed_rate", F.lit(0.0))}).drop("_logins", "_same", "_short")


#: Lists of a capture's HTTP, DNS, TLS and FTP context and how many values each keeps.
CONTEXT = {
    "http_methods": 10, "http_hosts": 12, "http_uris_sample": 12, "http_full_uri_sample": 6, "http_status_codes": 12, "http_user_agents": 8, "http_content_types": 8, "http_upload_hints": 8, "suspicious_http_parameters": 8,
    "dns_summary": 8, "dns_query_repetition": 8, "tls_summary": 8, "tls_sni_repetition": 8, "ftp_response_codes": 12, "status_code_summary": 8, "transferred_files_summary": 8, "auth_protocol": 8,
}


def context_summaries(rows: DataFrame, order: str = "start_time", limits: dict[str, int] = CONTEXT) -> DataFrame:
    """(capture_id, one array for each field): the first different values of each, redacted; structs and maps as JSON.

    Fields that the table lacks give empty arrays.
    """
    kinds = {f.name: f.dataType for f in rows.schema}
    deep = lambda k: isinstance(k, StructType | MapType)

    def shown(name: str) -> Column:
        kind = kinds[name]
        if isinstance(kind, ArrayType):
            return F.transform(F.col(name), lambda x: redact_sensitive_text(F.to_json(x) if deep(kind.elementType) else x.cast("string"), 220))
        return F.when(filled(kind, F.col(name)), redact_sensitive_text(F.to_json(name) if deep(kind) else F.col(name).cast("string"), 220))

    have = {c: n for c, n in limits.items() if c in kinds}
    empty = F.array().cast("array<string>")
    all_of = rows.select("capture_id").distinct()
    if have:
        all_of = all_of.join(first_values(rows.select("capture_id", order, *(shown(c).alias(c) for c in have)), ["capture_id"], order, have), "capture_id", "left")
    return all_of.select("capture_id", *((F.coalesce(c, empty) if c in have else empty).alias(c) for c in limits))


def indicator_counts(rows: DataFrame, variant: str = "capture") -> DataFrame:
    """(capture_id, one count for each indicator): rows in which it is set; and login, failed-login and callback rows with the highest beacon score."""
    r = Row(rows)
    hint, score = r.flag("auth_indicators.failed_login_hint"), r.number("c2_indicators.beacon_score")
    return rows.groupBy("capture_id").agg(
        *(F.count_if(r.positive(c, variant)).alias(c) for c in INDICATORS), F.count_if(r.positive("auth_indicators", variant) & hint).alias("failed_login_hint_sessions"),
        F.count_if(score >= 0.5).alias("beacon_sessions"), F.max(score).alias("max_beacon_score"),
    )


#: Lists of a capture by frequency, and how many values each keeps.
FREQUENT = {"proto": 20, "service": 20, "parser_source": 10, "src_ip": 10, "dst_ip": 10, "dst_port": 15}


def capture_lists(rows: DataFrame, order: str = "session_id", limits: dict[str, int] = FREQUENT) -> DataFrame:
    """(capture_id, one array of (value, count) for each field): the most frequent values, ties by first appearance."""
    return frequent_values(rows, ["capture_id"], order, {c: n for c, n in limits.items() if c in rows.columns})


def scored_captures(rows: DataFrame) -> DataFrame:
    """Rows in, scored captures out: ``candidate_scores`` over ``capture_inputs``."""
    from .capture import candidate_scores

    return candidate_scores(capture_inputs(rows))
