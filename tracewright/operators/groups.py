"""Behaviour groups: scans, login attempts and callbacks, and what no group covers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.aggregates import burstiness, numeric_pattern
from ..functions.values import is_failed
from .context import CALLBACK_WORDS, UPDATE_WORDS, USUAL_PORTS, benign_hints, repeated_names, said, same_keys, with_signals

SCAN_KEYS = ["capture_id", "src_ip", "dst_ip", "proto"]
AUTH_KEYS = ["capture_id", "src_ip", "dst_ip", "dst_port", "proto"]
#: Ports of services that ask for a login.
COMMON_PORTS = USUAL_PORTS + (587,)
LOGIN_PROTOCOLS = {21: "ftp", 22: "ssh", 23: "telnet", 80: "http", 443: "http", 445: "smb", 3389: "rdp", 8080: "http", 8443: "http"}
LOGIN_SERVICES = {"ftp": "ftp", "ssh": "ssh", "http": "http", "https": "http", "rdp": "rdp", "smb": "smb", "smb2": "smb", "telnet": "telnet"}
#: Flags of a session that speak for another behaviour than a callback.
COMPETING = ("vulnerability", "auth", "exploit", "implant", "backdoor")
AUTH_PORTS = (21, 22, 23, 25, 110, 143, 389, 445, 1433, 1521, 3306, 3389, 5432, 5900, 6379, 9200)


def scan_candidates(sessions: DataFrame, min_fanout: int = 8, min_failed_rate: float = 0.4) -> DataFrame:
    """Short, small TCP or UDP sessions of a source with port fan-out and failures; needs the source context."""
    size = F.coalesce(F.col("orig_bytes"), F.lit(0)) + F.coalesce(F.col("resp_bytes"), F.lit(0))
    return sessions.where(
        F.col("proto").isin("tcp", "udp") & F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull() & (F.col("same_src_unique_dst_ports") >= min_fanout)
        & (F.col("same_src_failed_conn_rate") >= min_failed_rate) & (F.col("duration").isNull() | (F.col("duration") <= 5)) & (size <= 2000)
    )


def start_intervals(sessions: DataFrame, keys: list[str]) -> DataFrame:
    """Seconds since the previous start of the same key, where both are known and not negative."""
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("start_time"), "session_id")
    gap = F.col("start_time") - F.lag("start_time").over(order)
    return sessions.select(*keys, "session_id", gap.alias("interval")).where("interval >= 0")


def anchors_of(times: np.ndarray, window: float, anchor: float | None) -> np.ndarray:
    """For sorted times of one key, the start of the episode of each; ``anchor`` is that of the rows before."""
    out = np.empty(len(times))
    at = 0
    while at < len(times):
        anchor = times[at] if anchor is None else anchor
        stop = at + int(np.searchsorted(times[at:], anchor + window, "right"))
        while stop > at and times[stop - 1] - anchor > window:  # the sum above may round
            stop -= 1
        while stop < len(times) and not times[stop] - anchor > window:
            stop += 1
        out[at:stop] = anchor
        at, anchor = stop, anchor if stop == len(times) else None
    return out


def scan_episodes(candidates: DataFrame, window_seconds: float = 300.0, min_ports: int = 8, min_sessions: int = 8) -> DataFrame:
    """Candidate sessions with the episode they belong to: all columns and episode_start.

    An episode is anchored at its first row and closed by the first row more than
    ``window_seconds`` after the anchor. Each anchor hangs on the one before, so keys are read in
    order of time, a batch at a time, and only the last anchor is carried on: no key is ever
    held whole. A row without a time never splits: it joins the last episode. Episodes with fewer
    ports (a null port counts as one) or sessions are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, anchor = None, None
        for batch in batches:
            keys, times = batch.column(batch.num_columns - 1), batch.column(batch.schema.names.index("start_time"))
            known = times.is_valid().to_numpy(zero_copy_only=False)
            values = times.fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.full(len(batch), np.nan)
            edges = np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1 if len(batch) > 1 else []
            for lo, hi in zip([0, *edges], [*edges, len(batch)], strict=True):
                anchor = anchor if keys[lo].as_py() == last else None
                last = keys[lo].as_py()
                end = lo + int(known[lo:hi].sum())  # unknown times come last
                if end > lo:
                    starts[lo:end] = anchors_of(values[lo:end], window_seconds, anchor)
                    anchor = starts[end - 1]
                if anchor is not None:
                    starts[end:hi] = anchor
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(starts, from_pandas=True)], [*batch.schema.names[:-1], "episode_start"])

    rows = candidates.withColumn("start_time", F.col("start_time").cast("double"))
    order = [*SCAN_KEYS, F.asc_nulls_last("start_time"), "session_id"]
    sorted_rows = rows.repartition(*SCAN_KEYS).sortWithinPartitions(*order).withColumn("_key", F.to_json(F.struct(*SCAN_KEYS)))
    placed = sorted_rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("episode_start", DoubleType())]))
    episode = [*SCAN_KEYS, "episode_start"]
    kept = placed.groupBy(*episode).agg(F.countDistinct(F.coalesce("dst_port", F.lit(-1))).alias("_ports"), F.count("*").alias("_n")).where((F.col("_ports") >= min_ports) & (F.col("_n") >= min_sessions))
    return same_keys(placed, kept.select(*episode), episode, "left_semi")


def scan_groups(episodes: DataFrame) -> DataFrame:
    """One row for each scan episode: members, ports, failed share, duration, interval count and rate of probes."""
    keys = [*SCAN_KEYS, "episode_start"]
    span = F.max("start_time") - F.min("start_time")
    return episodes.groupBy(*keys).agg(
        F.count("*").alias("probe_count"), F.countDistinct("dst_port").alias("unique_dst_ports"), F.round(F.avg(is_failed(F.col("conn_state")).cast("double")), 4).alias("failed_rate"),
        F.min("start_time").alias("start_time"), F.max("start_time").alias("end_time"), F.round(span, 3).alias("scan_duration"),
        F.when(span > 0, F.round(F.count("*") / span, 4)).alias("probe_rate"),
    )


def gap_episodes(sessions: DataFrame, keys: list[str], window_seconds: float = 300.0) -> DataFrame:
    """Sessions with a running episode number: a new one after a silence of more than ``window_seconds``."""
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("start_time"), "session_id")
    new = F.coalesce(F.col("start_time") - F.lag("start_time").over(order) > window_seconds, F.lit(False)).cast("int")
    return sessions.withColumn("_new", new).withColumn("episode", F.sum("_new").over(order)).drop("_new")


LOGIN_KEYS = [*AUTH_KEYS, "auth_protocol"]


def login_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with a login protocol: their own (unless unknown), else by service, else by port; others are left out."""
    lookup = lambda table, key: F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)
    column = lambda c: F.lower(F.col(c)) if c in sessions.columns else F.lit(None).cast("string")
    own = F.when(~column("auth_protocol").isin("", "unknown"), column("auth_protocol"))
    found = F.coalesce(own, lookup(LOGIN_SERVICES, column("service")), lookup(LOGIN_PROTOCOLS, F.col("dst_port")))
    return sessions.withColumn("auth_protocol", found).where("auth_protocol is not null and src_ip <> '' and dst_ip <> ''")


def auth_groups(sessions: DataFrame, window_seconds: float = 300.0, min_attempts: int = 3) -> DataFrame:
    """Login episodes: attempts, failures, failure rate, attempt rate, tier (high: 5 attempts and 2 failures).

    Each session is an attempt of its own unless the column ``attempts`` says more. Failures are
    the sum of ``failed_logins`` or, without that column, the failed connections.
    """
    attempts = F.col("attempts") if "attempts" in sessions.columns else F.lit(1)
    failures = F.coalesce("failed_logins", F.lit(0)) if "failed_logins" in sessions.columns else is_failed(F.col("conn_state")).cast("int")
    rows = gap_episodes(login_sessions(sessions).withColumns({"_attempts": attempts, "_failures": failures}), LOGIN_KEYS, window_seconds)
    out = rows.groupBy(*LOGIN_KEYS, "episode").agg(
        F.count("*").alias("sessions"), F.greatest(F.count("*"), F.sum("_attempts")).alias("attempts"), F.sum("_failures").alias("failures"),
        F.min("start_time").alias("start_time"), F.max("start_time").alias("end_time"),
    )
    span = F.col("end_time") - F.col("start_time")
    return out.where(F.col("attempts") >= min_attempts).withColumns({
        "failure_rate": F.round(F.col("failures") / F.col("attempts"), 4), "attempt_rate": F.when(span > 0, F.round(F.col("attempts") / span, 4)),
        "tier": F.when((F.col("attempts") >= 5) & (F.col("failures") >= 2), "high").otherwise("weak"),
    })


def callback_groups(sessions: DataFrame, min_connections: int = 4, min_score: float = 0.45) -> DataFrame:
    """Endpoint groups that look like callbacks, with a weighted score, tier, competing behaviour and benign hints.

    Weights: 0.25 base; 0.15 for ten rows, else 0.05; periodic 0.2; 90 % of sizes up to 8192 bytes
    0.15; odd port 0.15; repeated DNS or server names 0.1; callback words 0.15. Periodic: 3
    intervals, median (else mean) of a second, regularity of 0.6. High: 5 rows, 0.65, periodic and
    no competing behaviour unless the text speaks of a callback. Starts without a time give no interval.
    """
    keys = AUTH_KEYS
    flags = [c for c in COMPETING if c in sessions.columns]
    rows = with_signals(sessions).where("src_ip <> '' and dst_ip <> ''").withColumn("_size", F.coalesce("orig_bytes", F.lit(0)) + F.coalesce("resp_bytes", F.lit(0)))
    seen = rows.groupBy(*keys).agg(
        F.min("start_time").alias("start_time"), F.max("start_time").alias("end_time"), said(CALLBACK_WORDS).alias("callback_text"), said(UPDATE_WORDS).alias("_update"),
        *(F.coalesce(F.bool_or(c), F.lit(False)).alias(f"_is_{c}") for c in flags),
    )
    gaps = numeric_pattern(start_intervals(rows, keys), keys, "interval").select(*keys, F.col("count").alias("intervals"), F.col("median").alias("interval_median"), F.col("mean").alias("interval_mean"), F.col("std").alias("interval_std"), F.col("cv").alias("interval_cv"))
    sizes = numeric_pattern(rows, keys, "_size").select(*keys, F.col("count").alias("connections"), F.col("p90").alias("bytes_p90"))
    both = sizes.where(F.col("connections") >= min_connections)
    for part, how in ((seen, "inner"), (gaps, "left"), (repeated_names(rows, keys), "left")):
        both = same_keys(both, part, keys, how)
    both = both.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("repeated_dns", "repeated_sni")})
    regularity = F.coalesce(F.round(1 / (1 + F.col("interval_cv")), 3), F.lit(0.0))
    scale = F.when(F.col("interval_median") > 0, F.col("interval_median")).otherwise(F.col("interval_mean"))
    periodic = F.coalesce((F.col("intervals") >= 3) & (scale >= 1) & (regularity >= 0.6), F.lit(False))
    odd, repeated = F.coalesce(~F.col("dst_port").isin(*COMMON_PORTS), F.lit(False)), F.col("repeated_dns") | F.col("repeated_sni")
    add = lambda test, weight, other=0.0: F.when(test, weight).otherwise(other)
    score = F.lit(0.25) + add(F.col("connections") >= 10, 0.15, 0.05) + add(periodic, 0.2) + add(F.col("bytes_p90") <= 8192, 0.15) + add(odd, 0.15) + add(repeated, 0.1) + add(F.col("callback_text"), 0.15)
    competing = F.array_compact(F.array(*(F.when(F.col(f"_is_{c}"), F.lit(c)) for c in flags))) if flags else F.array().cast("array<string>")
    out = both.withColumns({
        "regularity_score": regularity, "periodic": periodic, "burstiness": burstiness(F.col("interval_mean"), F.col("interval_std"), F.col("intervals")),
        "score": F.round(F.least(score, F.lit(1.0)), 3), "competing": F.array_join(competing, ","), "_odd": odd,
    })
    sure = (F.col("connections") >= 5) & (F.col("score") >= 0.65) & F.col("periodic") & ((F.col("competing") == "") | F.col("callback_text"))
    out = out.where(F.col("score") >= min_score).withColumn("tier", F.when(sure, "high").when(F.col("score") >= 0.45, "medium").otherwise("weak"))
    hints = benign_hints(F.col("repeated_dns"), F.col("_update"), F.when(scale > 0, scale), F.col("periodic") & ~(F.col("_odd") | repeated | F.col("callback_text")))
    return out.select("*", *hints).drop("_update", "_odd", *(f"_is_{c}" for c in flags))


def group_members(sessions: DataFrame, auth: DataFrame, callbacks: DataFrame, window_seconds: float = 300.0) -> DataFrame:
    """(session_id) of the sessions that belong to a login or callback group of the high tier."""
    high = lambda groups, keys: groups.where("tier = 'high'").select(*keys)
    logins = gap_episodes(login_sessions(sessions), LOGIN_KEYS, window_seconds)
    first = same_keys(logins, high(auth, [*LOGIN_KEYS, "episode"]), [*LOGIN_KEYS, "episode"], "left_semi").select("session_id")
    return first.union(same_keys(sessions, high(callbacks, AUTH_KEYS), AUTH_KEYS, "left_semi").select("session_id"))


def uncovered_sessions(sessions: DataFrame, members: DataFrame) -> DataFrame:
    """Sessions that are in no accepted group; ``members(session_id)``."""
    return sessions.join(members.select("session_id").distinct(), "session_id", "left_anti")


def classification_records(sessions: DataFrame, episodes: DataFrame, auth: DataFrame | None = None, callbacks: DataFrame | None = None, window_seconds: float = 300.0) -> DataFrame:
    """Scan groups, login and callback groups of the high tier, and the sessions that no such group covers, in one table.

    (record_id, record_type, capture_id, src_ip, dst_ip, start_time, sessions). ``auth`` and
    ``callbacks`` come from ``auth_groups`` (of the same window) and ``callback_groups``; both or
    neither are given. A session can be in groups of several kinds.
    """
    ends = ["capture_id", "src_ip", "dst_ip", "start_time"]
    name = lambda kind, *parts: F.concat_ws(":", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)).alias("record_id")
    place = F.row_number().over(Window.partitionBy(*SCAN_KEYS).orderBy("episode_start"))
    out = scan_groups(episodes).select(name("scan", *map(F.col, SCAN_KEYS), place), F.lit("scan_group").alias("record_type"), *ends, F.col("probe_count").alias("sessions"))
    covered = episodes.select("session_id")
    if auth is not None:
        out = out.unionByName(auth.where("tier = 'high'").select(name("auth", *map(F.col, LOGIN_KEYS), F.col("episode")), F.lit("auth_attempt_group").alias("record_type"), *ends, "sessions"))
        out = out.unionByName(callbacks.where("tier = 'high'").select(name("callback", *map(F.col, AUTH_KEYS)), F.lit("callback_group").alias("record_type"), *ends, F.col("connections").alias("sessions")))
        covered = covered.union(group_members(sessions, auth, callbacks, window_seconds))
    rest = uncovered_sessions(sessions, covered).select(name("session", F.col("session_id")), F.lit("session").alias("record_type"), *ends, F.lit(1).cast("long").alias("sessions"))
    return out.unionByName(rest)
