"""One scored record for each capture: ranked evidence, rule scores and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import TECHNIQUES, is_failed
from .groups import AUTH_PORTS


def repeated_auth_service(sessions: DataFrame) -> DataFrame:
    """For each capture: sessions on login ports, the busiest service, short or failed logins, and whether logins repeat.

    The busiest service is the most sessions of one (source, destination, port), on any port.
    Short: nothing came back, by packets where the table has ``resp_pkts``, or by bytes; null counts
    as none. Repeated: ten or more, and either twenty, or a service of ten, or five short or failed.
    """
    login = F.col("dst_port").isin(*AUTH_PORTS)
    silent = [F.coalesce(F.col(c), F.lit(0)) == 0 for c in ("resp_pkts", "resp_bytes") if c in sessions.columns]
    short = F.coalesce(is_failed(F.col("conn_state")), F.lit(False))
    for test in silent:
        short = short | test
    service = sessions.groupBy("capture_id", "src_ip", "dst_ip", "dst_port").agg(F.count("*").alias("n"), F.count_if(login).alias("logins"), F.count_if(login & short).alias("short"))
    out = service.groupBy("capture_id").agg(F.sum("logins").alias("auth_rows"), F.max("n").alias("busiest"), F.sum("short").alias("short_or_failed")).where("auth_rows > 0")
    return out.withColumn("repeated", (F.col("auth_rows") >= 10) & ((F.col("auth_rows") >= 20) | (F.col("busiest") >= 10) | (F.col("short_or_failed") >= 5)))


#: Conditions that several rules share, on capture-level counts and flags.
SCAN = "(port_fanout >= 8 OR scan_rows > 0)"
ACCESS = "(web_shell AND command)"
LOGINS = "(auth_rows > 0 OR login_failures > 0 OR login_attempts >= 5)"
EXPLICIT = (
    f"({SCAN} OR vulnerability > 0 OR sensitive_path OR exploit > 0 OR {ACCESS} OR {LOGINS} OR repeated_auth"
    " OR (implant > 0 AND placement) OR backdoor > 0 OR (callback > 0 AND NOT repeated_auth) OR miner)"
)
WEAK = "((payload > 0 AND exploit = 0) OR (implant > 0 AND NOT placement) OR (implant = 0 AND php_post))"
#: Score rules: condition, then effects (code, change, side, reason). Codes and weights are fixed
#: values. Sides: "for" and "weak" evidence, and what speaks "against" the code.
CANDIDATE_RULES = (
    (SCAN, (("TA43_01", 3.5, "for", "many ports or targets"),)),
    (f"{SCAN} AND failed_rate >= 0.4", (("TA43_01", 0.8, "for", "most connections fail"),)),
    (f"{SCAN} AND (vulnerability > 0 OR sensitive_path)", (("TA43_01", -1.2, "against", "probes of applications, not of ports alone"),)),
    ("vulnerability > 0", (("TA43_02", 3.0, "for", "vulnerability probes"), ("TA01_02", -0.8, "against", "probes may only look for weaknesses"))),
    ("sensitive_path", (("TA43_02", 4.5, "for", "probe of a sensitive path"), ("TN01_01", -1.0, "against", "sensitive paths are no ordinary requests"))),
    ("exploit > 0", (("TA01_02", 3.2, "for", "exploit indicators"),)),
    ("exploit > 0 AND payload > 0", (("TA01_02", 3.2, "for", "exploit indicators with payload"), ("TN01_01", -2.0, "against", "exploit with payload"))),
    ("exploit = 0 AND payload > 0", (("TA01_02", 0.7, "weak", "suspicious payload without exploit indicators"),)),
    (ACCESS, (("TA11_01", 5.0, "for", "commands sent to a web shell"), ("TA01_02", -1.8, "against", "the web shell is there already"))),
    (f"NOT {ACCESS} AND exploit > 0", (("TA11_01", -0.6, "against", "exploit without a web shell"),)),
    (LOGINS, (("TA01_01", 3.2, "for", "login attempts or failures"),)),
    ("repeated_auth", (
        ("TA01_01", 5.0, "for", "short logins repeat on a login service"), ("TA11_02", -3.5, "against", "repeated logins, not callbacks"), ("TA43_01", -1.2, "against", "one login service, not many ports"),
    )),
    ("implant > 0 AND placement", (("TA03_01", 4.6, "for", "a file is placed"), ("TA01_02", -1.0, "against", "placing a file goes beyond exploitation"))),
    ("implant > 0 AND NOT placement", (("TA03_01", 1.0, "for", "implant indicators without a placed file"),)),
    ("implant > 0 AND NOT placement AND (exploit > 0 OR payload > 0)", (("TA01_02", 2.0, "for", "exploit request without a placed file"), ("TA03_01", -1.0, "against", "no placed file"))),
    ("implant = 0 AND php_post", (("TA03_01", 0.6, "weak", "POST to a PHP page"), ("TA03_01", -0.4, "against", "no upload, script or file"))),
    ("backdoor > 0", (("TA11_01", 3.8, "for", "backdoor access"),)),
    ("callback > 0 AND NOT repeated_auth", (("TA11_02", 2.6, "for", "callback indicators"),)),
    ("callback > 0 AND repeated_auth", (("TA11_02", 0.8, "weak", "repetition on a login service"), ("TA11_02", -2.0, "against", "login services repeat without callbacks"))),
    ("callback > 0 AND beacon AND NOT repeated_auth", (("TA11_02", 4.0, "for", "regular callbacks"), ("TN01_01", -2.0, "against", "regular callbacks"))),
    ("encrypted AND beacon AND NOT repeated_auth", (("TA11_02", 1.2, "for", "encrypted and regular"),)),
    ("encrypted AND beacon AND repeated_auth", (("TA11_02", 1.2, "weak", "encrypted and regular"),)),
    ("miner", (("TA11_02", 5.0, "for", "miner heartbeat"), ("TN01_01", -1.5, "against", "miner heartbeat"))),
    (f"benign AND {EXPLICIT}", (
        ("TA01_02", -1.0, "against", "download/chunk traffic explains encoded content"), ("TA11_02", -1.0, "against", "download/chunk traffic explains repetition"), ("TN01_01", 0.0, "against", "attack indicators beside benign context"),
    )),
    (f"benign AND NOT {EXPLICIT}", (
        ("TN01_01", 3.5, "for", "update or download/chunk traffic only"), ("TA01_02", -1.4, "against", "download/chunk traffic explains encoded content"), ("TA11_02", -1.2, "against", "download/chunk traffic explains repetition"),
    )),
    (f"NOT {EXPLICIT} AND {WEAK}", (("TN01_01", 0.8, "for", "only weak evidence of an attack"), ("TN01_01", 0.0, "against", "weak evidence needs review"))),
    (f"NOT {EXPLICIT} AND NOT {WEAK}", (("TN01_01", 2.2, "for", "no evidence of an attack"),)),
)
#: Names of conflicts, fixed values, and their conditions on the inputs and results.
CONFLICTS = (
    ("low_score_margin", "margin < 1.5"),
    ("weak_evidence", "strength = 'weak'"),
    ("attack_indicators_vs_normal_candidate", f"{EXPLICIT} AND primary = 'TN01_01'"),
    ("benign_context_vs_attack_candidate", f"benign AND primary <> 'TN01_01' AND NOT {EXPLICIT}"),
    ("auth_service_repetition_counters_c2", "repeated_auth AND score_TA11_02 > 0"),
    ("generic_php_post_weak_implant_evidence", "php_post AND NOT placement"),
)
#: Inputs of the rules; a count or flag that is null or that the table lacks is 0 or false.
COUNTS = "port_fanout scan_rows failed_rate vulnerability exploit payload auth_rows login_failures login_attempts implant backdoor callback".split()
FLAGS = "sensitive_path web_shell command placement php_post repeated_auth beacon encrypted miner benign".split()


def _noted(side: str) -> Column:
    """Structs (code, reason) of the rules that hold, in the order of the rules."""
    all_of = [F.when(F.expr(test), F.struct(F.lit(code).alias("code"), F.lit(reason).alias("reason"))) for test, effects in CANDIDATE_RULES for code, _, s, reason in effects if s == side]
    return F.filter(F.array(*all_of), lambda x: x.isNotNull())


def candidate_scores(captures: DataFrame) -> DataFrame:
    """Add scores of all technique codes with their evidence, the primary code and what is doubtful about it.

    Scores are sums of the rules, held in 0 to 10 after the sum and rounded to 3 digits; ties go
    to the earlier code. Strong: 6 or more with a margin of 2; medium: 3 or a margin of 1.
    ``evidence``, ``weak_evidence`` and ``counter_evidence`` are arrays of (code, reason); ``top``
    has the three best (technique, score); ``rule_evidence`` has the reasons for the primary code,
    or its weak ones, eight at most; ``flag_names`` are the conflicts.
    """
    known = {c: F.coalesce(F.col(c), F.lit(0)) if c in captures.columns else F.lit(0) for c in COUNTS}
    known |= {c: F.coalesce(F.col(c), F.lit(False)) if c in captures.columns else F.lit(False) for c in FLAGS}
    out = captures.withColumns(known)
    totals = {}
    for code in TECHNIQUES:
        total = F.lit(0.0)
        for test, effects in CANDIDATE_RULES:
            for _, change, _, _ in (e for e in effects if e[0] == code and e[1]):
                total = total + F.when(F.expr(test), change).otherwise(0.0)
        totals[f"score_{code}"] = F.round(F.least(F.greatest(total, F.lit(0.0)), F.lit(10.0)), 3)
    out = out.withColumns(totals | {"evidence": _noted("for"), "weak_evidence": _noted("weak"), "counter_evidence": _noted("against")})
    order = F.array_sort(F.array(*(F.struct((-F.col(f"score_{c}")).alias("minus"), F.lit(i).alias("place"), F.lit(c).alias("code")) for i, c in enumerate(TECHNIQUES))))
    out = out.withColumn("_order", order)
    best, second = -F.col("_order")[0]["minus"], -F.col("_order")[1]["minus"]
    top = F.transform(F.slice("_order", 1, 3), lambda x: F.struct(x["code"].alias("technique"), (-x["minus"]).alias("score")))
    out = out.withColumns({"primary": F.col("_order")[0]["code"], "best": best, "margin": F.round(best - second, 3), "top": top})
    strength = F.when((F.col("best") >= 6) & (F.col("margin") >= 2), "strong").when((F.col("best") >= 3) | (F.col("margin") >= 1), "medium").otherwise("weak")
    own = lambda c: F.slice(F.transform(F.filter(c, lambda x: x["code"] == F.col("primary")), lambda x: x["reason"]), 1, 8)
    out = out.withColumns({"strength": strength, "rule_evidence": F.when(F.size(own("evidence")) > 0, own("evidence")).otherwise(own("weak_evidence"))})
    return out.withColumn("flag_names", F.filter(F.array(*(F.when(F.expr(test), F.lit(name)) for name, test in CONFLICTS)), lambda x: x.isNotNull())).drop("_order")


def capture_records(sessions: DataFrame, records: DataFrame, parses: DataFrame) -> DataFrame:
    """One row for each capture seen in any table; evidence comes from its records, or from its sessions if it has none."""
    s = sessions.groupBy("capture_id").agg(F.count("*").alias("session_count"), F.min("start_time").alias("s_first"), F.max("start_time").alias("s_last"), F.max("orig_bytes").alias("s_bytes"))
    r = records.groupBy("capture_id").agg(F.count("*").alias("record_count"), F.min("start_time").alias("r_first"), F.max("start_time").alias("r_last"), F.max("orig_bytes").alias("r_bytes"))
    out = s.join(r, "capture_id", "full").join(parses.select("capture_id", "file_name"), "capture_id", "full")
    has = F.col("record_count").isNotNull()
    return out.select(
        "capture_id", "file_name", F.coalesce("session_count", F.lit(0)).alias("session_count"), F.coalesce("record_count", F.lit(0)).alias("record_count"),
        F.when(has, F.col("r_first")).otherwise(F.col("s_first")).alias("first_time"), F.when(has, F.col("r_last")).otherwise(F.col("s_last")).alias("last_time"),
        F.when(has, F.col("r_bytes")).otherwise(F.col("s_bytes")).alias("max_bytes"), F.when(has, "records").otherwise("sessions").alias("evidence"),
    )


def behaviour_summaries(sessions: DataFrame) -> DataFrame:
    """One row for each capture: filtered counts, maxima and sums of scan, login and callback evidence."""
    return sessions.groupBy("capture_id").agg(
        F.count_if(F.col("same_src_unique_dst_ports") >= 8).alias("scan_rows"), F.max("same_src_unique_dst_ports").alias("max_ports"), F.max("same_src_failed_conn_rate").alias("max_failed_rate"),
        F.count_if(F.col("dst_port").isin(*AUTH_PORTS)).alias("login_rows"), F.count_if(F.col("dst_port").isin(*AUTH_PORTS) & is_failed(F.col("conn_state"))).alias("login_failures"),
        F.sum(F.when(is_failed(F.col("conn_state")), F.col("orig_bytes")).otherwise(0)).alias("failed_bytes"), F.count_if(F.col("dst_port") == 443).alias("encrypted_rows"),
    )
