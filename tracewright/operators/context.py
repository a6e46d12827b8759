"""Context of a session inside its capture: by source, destination, endpoint and pair. Nothing crosses a capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import middle
from ..functions.ranks import numbered
from ..functions.values import client_initiated_external, is_failed

#: Ports on which repeated small connections are usual, and words of callbacks and of updates.
USUAL_PORTS = (21, 22, 23, 25, 53, 80, 110, 123, 143, 443, 445, 993, 995, 3389)
CALLBACK_WORDS = "callback|beacon|heartbeat|checkin|dummy-c2"
UPDATE_WORDS = "update|telemetry|health|wpad|sync|ntp"
#: What else a session may carry for its endpoint; a table without these columns has none of it.
SIGNALS = {"dns_queries": "array<string>", "server_names": "array<string>", "app_text": "string"}


def with_signals(sessions: DataFrame) -> DataFrame:
    """Sessions with all columns of SIGNALS, null where they had none."""
    return sessions.withColumns({n: F.lit(None).cast(t) for n, t in SIGNALS.items() if n not in sessions.columns})


def repeated_names(sessions: DataFrame, keys: list[str]) -> DataFrame:
    """For each key that has names: whether DNS queries and server names repeat (three or more, some twice).

    Names are counted by value first, so a hot endpoint is one row for each different name.
    """
    tag = lambda kind, c: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("name")))
    names = sessions.select(*keys, F.explode(F.concat(tag("dns", "dns_queries"), tag("sni", "server_names"))).alias("x"))
    counts = names.groupBy(*keys, "x").agg(F.count("*").alias("n"))
    of = lambda kind: F.coalesce((F.sum(F.when(F.col("x.kind") == kind, F.col("n"))) >= 3) & (F.max(F.when(F.col("x.kind") == kind, F.col("n"))) > 1), F.lit(False))
    return counts.groupBy(*keys).agg(of("dns").alias("repeated_dns"), of("sni").alias("repeated_sni"))


def said(words: str) -> Column:
    """Whether any session of a group has one of the words in its visible text."""
    return F.coalesce(F.bool_or(F.lower("app_text").rlike(words)), F.lit(False))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be null; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*(f"_{k}" for k in keys))


def benign_hints(repeated_dns: Column, update: Column, scale: Column, alone: Column) -> list[Column]:
    """Six signs that repetition is harmless, on rows with dst_port and proto."""
    no = lambda c: F.coalesce(c, F.lit(False))
    return [
        no(F.col("dst_port").isin(53, 80, 123, 443)).alias("common_service_port"), update.alias("update_or_telemetry_text"), no((F.col("dst_port") == 53) & repeated_dns).alias("dns_refresh_like"),
        no((F.col("proto") == "udp") & (F.col("dst_port") == 123)).alias("ntp_like"), no(scale < 1).alias("short_burst_not_beacon"), no(alone).alias("periodicity_alone"),
    ]


def source_context(sessions: DataFrame) -> DataFrame:
    """Each session with its source's connections, different ports and destinations, and failed share (4 digits)."""
    by = sessions.groupBy("capture_id", "src_ip").agg(
        F.count("*").alias("same_src_connections"), F.countDistinct("dst_port").alias("same_src_unique_dst_ports"),
        F.countDistinct("dst_ip").alias("same_src_unique_dst_ips"), F.round(F.avg(is_failed(F.col("conn_state")).cast("double")), 4).alias("same_src_failed_conn_rate"),
    )
    return sessions.join(by, ["capture_id", "src_ip"])


def destination_context(sessions: DataFrame) -> DataFrame:
    """Each session with its destination's different sources and the sessions of the same (source, destination, port)."""
    by = sessions.groupBy("capture_id", "dst_ip").agg(F.countDistinct("src_ip").alias("same_dst_unique_sources"))
    same = Window.partitionBy("capture_id", "src_ip", "dst_ip", "dst_port")
    return sessions.join(by, ["capture_id", "dst_ip"]).withColumn("same_endpoint_sessions", F.count("*").over(same))


def endpoint_beacon(sessions: DataFrame) -> DataFrame:
    """One row for each (capture, source, destination, port, protocol): interval statistics, signs of a beacon, a score and six benign hints.

    Starts without a time come last and give no interval. Periodic: 3 intervals or more, mean of a
    second or more, cv of 0.35 or less. Small: 4 rows or more of at most 4096 bytes. Long-lived: a
    duration of 300 seconds. DNS queries, server names and visible text count where the table has them.
    """
    keys = ["capture_id", "src_ip", "dst_ip", "dst_port", "proto"]
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("start_time"), "session_id")
    gap = F.col("start_time") - F.lag("start_time").over(order)
    full = with_signals(sessions)
    rows = full.withColumn("gap", F.when(gap >= 0, gap))
    group = Window.partitionBy(*keys)
    rows = rows.withColumns({"_place": F.row_number().over(group.orderBy(F.asc_nulls_last("gap"))) - 1, "_gaps": F.count("gap").over(group)})
    size = F.coalesce(F.col("orig_bytes"), F.lit(0)) + F.coalesce(F.col("resp_bytes"), F.lit(0))
    stats = rows.groupBy(*keys).agg(
        F.count("*").alias("connections"), F.count("gap").alias("intervals"), F.avg("gap").alias("_mean"), middle("gap", "_place", "_gaps").alias("_median"),
        F.stddev_pop("gap").alias("_std"), F.max(size).alias("max_bytes"), F.round(F.coalesce(F.max("start_time") - F.min("start_time"), F.lit(0.0)), 3).alias("fixed_endpoint_duration"),
        F.coalesce(F.bool_or(F.col("duration") >= 300), F.lit(False)).alias("long_lived"), said(CALLBACK_WORDS).alias("callback_text"), said(UPDATE_WORDS).alias("_update"),
    )
    stats = same_keys(stats, repeated_names(full, keys), keys, "left")
    stats = stats.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("repeated_dns", "repeated_sni")})
    stats = stats.withColumn("cv", F.when((F.col("_mean") > 0) & (F.col("intervals") >= 2), F.round(F.col("_std") / F.col("_mean"), 6)))
    stats = stats.withColumn("periodic", F.coalesce((F.col("intervals") >= 3) & (F.col("_mean") >= 1) & (F.col("cv") <= 0.35), F.lit(False)))
    odd = F.coalesce(~F.col("dst_port").isin(0, *USUAL_PORTS), F.lit(False))
    external = client_initiated_external(F.col("src_ip"), F.col("dst_ip"))
    small = (F.col("connections") >= 4) & (F.col("max_bytes") <= 4096)
    stats = stats.withColumns({"odd_port": odd, "external": external, "small_repeated": small})
    repeated = F.col("repeated_dns") | F.col("repeated_sni")
    add = lambda test, weight: F.when(test, weight).otherwise(0.0)
    score = add(F.col("periodic"), 0.35) + add(F.col("connections") >= 4, 0.15) + add(F.col("small_repeated"), 0.15) + add(repeated, 0.1) + add(F.col("odd_port"), 0.1) + add(F.col("external"), 0.1) + add(F.col("long_lived"), 0.05) + add(F.col("callback_text"), 0.2)
    alone = F.col("periodic") & ~(F.col("odd_port") | repeated | F.col("callback_text"))
    return stats.select(
        *keys, "connections", "intervals", F.round("_mean", 3).alias("interval_mean"), F.round("_median", 3).alias("interval_median"), F.when(F.col("intervals") >= 2, F.round("_std", 3)).alias("interval_std"),
        F.round("cv", 3).alias("interval_cv"), "periodic", "odd_port", "external", "small_repeated", "long_lived", "repeated_dns", "repeated_sni", "callback_text", "fixed_endpoint_duration", "max_bytes",
        F.round(F.least(score, F.lit(1.0)), 3).alias("beacon_score"), F.coalesce(F.round(1 / (1 + F.col("cv")), 3), F.lit(0.0)).alias("regularity_score"),
        *benign_hints(F.col("repeated_dns"), F.col("_update"), F.col("_median"), alone),
    )


#: Parts of paths by which web shells are known. Fixed values.
SHELL_PATHS = ("webshell", "shell.php", "cmd.php", "cmd.jsp", "c99", "r57")


def pair_context(sessions: DataFrame) -> DataFrame:
    """One row for each (capture, source, destination) of ``sessions(..., dst_port, uri_path, status, auth_protocol)``.

    Path fan-out, share of 404, requests of web shells, and login repetition: the most sessions of
    one port that has a session with a known login protocol.
    """
    keys = ["capture_id", "src_ip", "dst_ip"]
    shell = F.coalesce(F.lower("uri_path").rlike("|".join(SHELL_PATHS).replace(".", "[.]")), F.lit(False))
    known = F.coalesce(F.col("auth_protocol") != "unknown", F.lit(False))
    ports = sessions.groupBy(*keys, "dst_port").agg(F.count("*").alias("n"), F.bool_or(known).alias("login")).groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("login"), F.col("n"))), F.lit(0)).alias("auth_attempts"))
    by = sessions.groupBy(*keys).agg(
        F.countDistinct("uri_path").alias("unique_paths"), F.count("status").alias("statuses"),
        F.round(F.avg((F.col("status") == 404).cast("double")), 4).alias("share_404"), F.count_if(shell).alias("shell_requests"),
    ).join(ports, keys)
    return by.withColumns({
        "uri_fanout": F.col("unique_paths") >= 8, "high_404": F.coalesce((F.col("statuses") >= 5) & (F.col("share_404") >= 0.6), F.lit(False)),
        "repeated_shell": F.col("shell_requests") >= 2, "auth_repetition": F.col("auth_attempts") >= 5,
    })


def with_pair_flags(sessions: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sessions whose flags high_uri_fanout, high_404_rate, repeated_backdoor_endpoint_access and repeated_login_attempts also hold what their pair shows.

    A flag that a session lacks counts as not set. Login repetition holds for sessions of a known login protocol only.
    """
    keys = ["capture_id", "src_ip", "dst_ip"]
    named = {"high_uri_fanout": "uri_fanout", "high_404_rate": "high_404", "repeated_backdoor_endpoint_access": "repeated_shell", "repeated_login_attempts": "auth_repetition"}
    found = pairs.select(*keys, *(F.col(v).alias(f"_{v}") for v in named.values()))
    login = F.coalesce(F.col("auth_protocol") != "unknown", F.lit(False))
    own = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in sessions.columns else F.lit(False)
    set_ = {c: own(c) | (F.coalesce(F.col(f"_{v}"), F.lit(False)) & (login if v == "auth_repetition" else F.lit(True))) for c, v in named.items()}
    return sessions.join(found, keys, "left").withColumns(set_).drop(*(f"_{v}" for v in named.values()))


def capture_summary(sessions: DataFrame) -> DataFrame:
    """One row for each capture: time range, totals, failed and external sessions, sources that scan (8 ports, 0.4 failed)."""
    fan = sessions.groupBy("capture_id", "src_ip").agg(F.countDistinct("dst_port").alias("ports"), F.round(F.avg(F.coalesce(is_failed(F.col("conn_state")), F.lit(False)).cast("double")), 4).alias("failed_rate"))
    scans = fan.groupBy("capture_id").agg(F.count_if((F.col("ports") >= 8) & (F.col("failed_rate") >= 0.4)).alias("scan_sources"), F.max("ports").alias("max_unique_dst_ports"))
    total = sessions.groupBy("capture_id").agg(
        F.count("*").alias("sessions"), F.min("start_time").alias("first_time"), F.max("start_time").alias("last_time"),
        F.sum("orig_bytes").alias("orig_bytes"), F.sum("resp_bytes").alias("resp_bytes"), F.countDistinct("src_ip").alias("sources"), F.countDistinct("dst_ip").alias("destinations"),
        F.count_if(is_failed(F.col("conn_state"))).alias("failed_sessions"), F.count_if(client_initiated_external(F.col("src_ip"), F.col("dst_ip"))).alias("external_sessions"),
    )
    return total.join(scans, "capture_id")


def number_sessions(sessions: DataFrame) -> DataFrame:
    """Add session_no, zero-padded to six digits or more and counted within a capture by (start, id).

    A file order doesn't exist here. One capture may hold all rows: its numbers are made in ranges.
    """
    out = numbered(sessions, ["capture_id"], [F.asc_nulls_last("start_time"), F.asc("session_id")], "_no")
    digits = F.col("_no").cast("string")
    return out.withColumn("session_no", F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), F.lit("0"))).drop("_no")
