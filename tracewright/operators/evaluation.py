"""Matching predictions with answers, and the metrics over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import numbered
from ..functions.values import stage_of
from ..sources.checkpoints import held

STAGES = ("TA43", "TA01", "TA03", "TA11", "TN01")


def with_signature(rows: DataFrame, fields: tuple[str, ...] = ("file", "start_time", "end_time", "src_ip", "src_port", "dst_ip", "dst_port")) -> DataFrame:
    """Add signature: all fields as one text; null where all but the first are empty."""
    text = [F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in fields]
    return rows.withColumn("signature", F.when(F.concat(*text[1:]) != "", F.concat_ws("|", *text)))


def match_answers(predictions: DataFrame, answers: DataFrame, tiers: tuple[tuple[str, ...], ...] = (("file", "number"), ("number",), ("signature",), ("file",))) -> DataFrame:
    """(prediction_id, answer_id, method) in tiers of keys, each using only what earlier tiers left.

    Both tables need the columns of all tiers; ``with_signature`` makes the third. A key matches
    where exactly one unused prediction and one unused answer have it. Contended keys stay open for
    the next tier, so the result doesn't depend on row order.

    Each side is one narrow table with the key of every tier. Each tier counts the keys of both, and
    the rows that it used are taken out of their own side, by its own ids, before the next one reads
    what is left.
    """
    key = lambda cols: F.when(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in cols)), F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in cols))))
    keys = [key(cols).alias(f"key_{i}") for i, cols in enumerate(tiers)]
    left, out = {"prediction_id": predictions, "answer_id": answers}, None
    left = {name: held(df.select(name, *keys)) for name, df in left.items()}
    for i, cols in enumerate(tiers):
        seen = {name: df.where(F.col(f"key_{i}").isNotNull()).select(f"key_{i}", name) for name, df in left.items()}
        both = seen["prediction_id"].unionByName(seen["answer_id"], allowMissingColumns=True)
        counts = [F.count("prediction_id").alias("_p"), F.count("answer_id").alias("_a"), F.min("prediction_id").alias("prediction_id"), F.min("answer_id").alias("answer_id")]
        hit = both.groupBy(f"key_{i}").agg(*counts).where("_p = 1 and _a = 1").select("prediction_id", "answer_id", F.lit("+".join(cols)).alias("method"))
        out = hit if out is None else out.unionByName(hit)
        if i + 1 < len(tiers):
            left = {name: held(df.join(hit.select(name), name, "left_anti")) for name, df in left.items()}
    return out


def unmatched_rows(predictions: DataFrame, answers: DataFrame, matches: DataFrame) -> DataFrame:
    """(side, id, reason) of the answers and predictions that no match uses."""
    left = answers.join(matches, "answer_id", "left_anti").select(F.lit("answer").alias("side"), F.col("answer_id").alias("id"), F.lit("no unique prediction match").alias("reason"))
    return left.unionByName(predictions.join(matches, "prediction_id", "left_anti").select(F.lit("prediction").alias("side"), F.col("prediction_id").alias("id"), F.lit("unused prediction row").alias("reason")))


def confusion_grid(rows: DataFrame) -> DataFrame:
    """(expected, predicted, n) for all pairs of stages of ``rows(truth, guess)``; pairs that never occur have 0, unknown stages are left out."""
    counts = rows.groupBy(stage_of(F.col("truth")).alias("expected"), stage_of(F.col("guess")).alias("predicted")).agg(F.count("*").alias("n"))
    grid = rows.sparkSession.createDataFrame([(e, p) for e in STAGES for p in STAGES], "expected string, predicted string")
    return grid.join(counts, ["expected", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def overall_metrics(rows: DataFrame) -> DataFrame:
    """One row over ``rows(truth, guess)`` with known stages: stage, technique, normal-or-attack, normal and attack accuracy, 4 digits, and macro F1."""
    t, g = stage_of(F.col("truth")), stage_of(F.col("guess"))
    known = rows.where(t.isin(*STAGES) & g.isin(*STAGES)).select("truth", "guess", t.alias("t"), g.alias("g"))
    normal, right = F.col("t") == "TN01", F.col("t") == F.col("g")
    share = lambda hit, of: F.round(F.when(F.count_if(of) > 0, F.count_if(hit & of) / F.count_if(of)).otherwise(0.0), 4)
    all_rows = F.lit(True)
    macro = stage_metrics(known).agg(F.round(F.avg("f1"), 4).alias("macro_f1"))
    return known.agg(
        F.count("*").alias("n"), share(right, all_rows).alias("stage_accuracy"), share(F.col("truth") == F.col("guess"), all_rows).alias("technique_accuracy"),
        share(normal == (F.col("g") == "TN01"), all_rows).alias("normal_vs_attack"), share(right, normal).alias("normal_accuracy"), share(right, ~normal).alias("attack_accuracy"),
    ).join(F.broadcast(macro))  # one row each


def stage_metrics(rows: DataFrame) -> DataFrame:
    """For each stage of ``rows(truth, guess)``: support, predicted, right, precision, recall and F1, 4 digits; stages without rows too."""
    pairs = rows.select(stage_of(F.col("truth")).alias("t"), stage_of(F.col("guess")).alias("g")).groupBy("t", "g").agg(F.count("*").alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("t").alias("stage"), F.lit("t").alias("side")), F.struct(F.col("g").alias("stage"), F.lit("g").alias("side")))).alias("x"), "t", "g", "n").select("x.*", "t", "g", "n")
    sums = sides.groupBy("stage").agg(
        F.sum(F.when(F.col("side") == "t", F.col("n")).otherwise(0)).alias("support"), F.sum(F.when(F.col("side") == "g", F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when((F.col("side") == "t") & (F.col("t") == F.col("g")), F.col("n")).otherwise(0)).alias("correct"),
    )
    every = rows.sparkSession.createDataFrame([(s,) for s in STAGES], "stage string")
    full = every.join(sums, "stage", "left").select("stage", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("support", "predicted", "correct")))
    rate = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = rate(F.col("correct"), F.col("predicted")), rate(F.col("correct"), F.col("support"))
    return full.select("*", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 4).alias("f1"))


def paired_effect(rows: DataFrame) -> DataFrame:
    """Each record of ``rows(record_id, truth, a, b)`` as helpful (only b right), harmful (only a right), both or neither, with agreement."""
    a, b = F.col("a") == F.col("truth"), F.col("b") == F.col("truth")
    effect = F.when(b & ~a, "helpful").when(a & ~b, "harmful").when(a & b, "both_right").otherwise("both_wrong")
    return rows.select("record_id", effect.alias("effect"), (F.col("a") == F.col("b")).alias("agree"))


def scope_metrics(rows: DataFrame, scopes: dict[str, Column]) -> DataFrame:
    """(scope, n, correct, accuracy) over scopes that may overlap; ``rows(truth, guess, ...)``."""
    inside = F.filter(F.array(F.lit("all"), *(F.when(test, F.lit(name)) for name, test in scopes.items())), lambda s: s.isNotNull())
    out = rows.select(F.explode(inside).alias("scope"), (F.col("truth") == F.col("guess")).alias("ok"))
    return out.groupBy("scope").agg(F.count("*").alias("n"), F.count_if("ok").alias("correct"), F.round(F.avg(F.col("ok").cast("double")), 4).alias("accuracy"))


#: Confidence tiers, and the scopes that they and the kinds of records make.
TIERS = ("external_high_pcap", "external_high_flow", "external_medium", "external_low", "synthetic_controlled")


def confidence_level(rows: DataFrame, synthetic: tuple[str, ...] = ()) -> Column:
    """The tier of a record: its own, else synthetic for the named datasets, else by how sure its label is and whether it is a flow only."""
    own = F.nullif(F.trim("confidence_level"), F.lit("")) if "confidence_level" in rows.columns else F.lit(None).cast("string")
    sure = F.col("label_confidence")
    made = F.when(F.col("dataset_id").isin(*synthetic), TIERS[4]) if synthetic else F.lit(None).cast("string")
    return F.coalesce(own, made, F.when((sure == "high") & (F.col("record_type") == "flow_only"), TIERS[1]).when(sure == "high", TIERS[0]).when(sure == "medium", TIERS[2]).otherwise(TIERS[3]))


def failure_class(guess: Column, error: Column) -> Column:
    """Why an answer has no code: missing, illegal_code, json_parse_failure or failed; null if it has one."""
    low = F.lower(error)
    return F.when(guess.isNotNull(), F.lit(None)).when(F.coalesce(error, F.lit("")) == "", "missing").when(low.contains("invalid technique code") | (low == "unknown_code"), "illegal_code").when(
        low.contains("json") | low.isin("no_object", "many_objects"), "json_parse_failure"
    ).otherwise("failed")


def answer_metrics(rows: DataFrame, by_class: bool = False) -> DataFrame:
    """(mode, scope, total, correct, accuracy, and the rates of failures) over nine overlapping scopes, 6 digits.

    ``rows(mode, record_type, label_confidence, truth, guess, error)`` hold one answer of a mode each;
    ``guess`` is null where there is none and ``error`` says why. Scopes: the five tiers, both high ones as
    strict external, flow_only, pcap/session-derived, and coverage all. ``by_class`` splits each scope by the
    true code. Scopes without rows are missing.
    """
    tier, flow = confidence_level(rows), F.coalesce(F.col("record_type") == "flow_only", F.lit(False))
    scopes = F.array_compact(F.array(
        F.lit("coverage all"), F.when(tier.isin(*TIERS), tier), F.when(tier.isin(*TIERS[:2]), "strict external"), F.when(flow, "flow_only").otherwise("pcap/session-derived"),
    ))
    split = ["technique"] if by_class else []
    each = rows.select("mode", F.explode(scopes).alias("scope"), F.col("truth").alias("technique"), F.coalesce(F.col("guess") == F.col("truth"), F.lit(False)).alias("ok"), failure_class(F.col("guess"), F.col("error")).alias("failure"))
    share = lambda test: F.round(F.count_if(test) / F.count("*"), 6)
    return each.groupBy("mode", "scope", *split).agg(
        F.count("*").alias("total"), F.count_if("ok").alias("correct"), share(F.col("ok")).alias("accuracy"), share(F.col("failure") == "json_parse_failure").alias("json_parse_failure_rate"), share(F.col("failure") == "illegal_code").alias("illegal_code_rate"),
        share(F.col("failure").isin("missing", "failed")).alias("other_failure_rate"),
    )


def run_cost(calls: DataFrame, in_price: float = 0.3, out_price: float = 2.4, retries: tuple[float, ...] = (0.0, 0.1, 0.2), elapsed: float | None = None, estimate: float = 32.8) -> DataFrame:
    """For each (mode, retry share) of ``calls(mode, tokens_in, tokens_out, latency)``: cost, latency, throughput and serial days.

    The 95 % latency is the value at place max(0, floor(0.95 n) - 1) of the sorted latencies, by
    ranks in ranges, so a mode may hold all calls. ``throughput`` is calls a second over the
    ``elapsed`` seconds of the run or, without them, one after the other; ``serial_days`` what the
    calls take one after the other at the mean latency, or at ``estimate`` seconds where it isn't positive.
    """
    sums = calls.groupBy("mode").agg(
        F.count("*").alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.avg("latency").alias("_mean"),
    )
    place = F.greatest(F.floor(F.lit(0.95) * F.col("calls")) - 1, F.lit(0)) + 1
    ranked = numbered(calls.select("mode", "latency"), ["mode"], [F.asc("latency")], "_i")
    p95 = ranked.join(sums.select(F.col("mode").alias("_mode"), place.alias("_wanted")), F.col("mode").eqNullSafe(F.col("_mode")) & (F.col("_i") == F.col("_wanted"))).select("_mode", F.round("latency", 3).alias("p95_latency"))
    both = sums.join(p95, F.col("mode").eqNullSafe(F.col("_mode"))).drop("_mode")
    grid = both.select("*", F.explode(F.array(*map(F.lit, retries))).alias("retry"))
    mean = F.round("_mean", 3)
    seconds = F.lit(elapsed) if elapsed is not None else F.col("_mean") * F.col("calls")
    return grid.select(
        "mode", "calls", "tokens_in", "tokens_out", mean.alias("mean_latency"), "p95_latency", "retry",
        F.round((F.col("tokens_in") * in_price + F.col("tokens_out") * out_price) / 1e6 * (1 + F.col("retry")), 6).alias("cost"),
        F.coalesce(F.when(seconds > 0, F.round(F.col("calls") / seconds, 4)), F.lit(0.0)).alias("throughput"),
        F.round(F.col("calls") * F.coalesce(F.when(mean > 0, mean), F.lit(estimate)) / 86400, 4).alias("serial_days"),
    )


def layer_retention(layers: dict[str, DataFrame], tests: dict[str, Column]) -> DataFrame:
    """(layer, evidence, rows, with_evidence) for each layer and kind of evidence."""
    out = None
    for name, df in layers.items():
        one = df.agg(F.count("*").alias("rows"), *(F.count_if(t).alias(k) for k, t in tests.items()))
        pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("evidence"), F.col(k).alias("with_evidence")) for k in tests))).alias("p")
        one = one.select(F.lit(name).alias("layer"), "rows", pairs).select("layer", "p.evidence", "rows", "p.with_evidence")
        out = one if out is None else out.unionByName(one)
    return out


def retention_verdicts(retention: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(evidence, verdict, lost_after) of ``layer_retention`` rows over layers in ``order``, the first being the raw one.

    Verdicts: ``kept`` where every layer that has rows still shows the evidence; ``possible_loss`` where one that
    has rows shows none though a layer before did, ``lost_after`` naming the last that did; ``not_assessed`` where a layer
    after the evidence has no rows at all; ``absent`` where the first layer shows none; ``sparse`` where the first
    shows it in 20 rows or more and no layer after it in more than one.
    """
    place = F.array_position(F.array(*map(F.lit, order)), F.col("layer"))
    layers = F.array_sort(F.collect_list(F.struct(place.alias("at"), "layer", "rows", F.col("with_evidence").alias("n"))))
    rows = retention.where(F.col("layer").isin(*order)).groupBy("evidence").agg(layers.alias("l"))
    begin = F.struct(F.lit(None).cast("string").alias("last"), F.lit(None).cast("string").alias("lost"), F.lit(False).alias("blind"))

    def step(s: Column, x: Column) -> Column:
        seen, gap = x["n"] > 0, (x["rows"] > 0) & (x["n"] == 0) & s["last"].isNotNull()
        return F.struct(
            F.when(seen, x["layer"]).otherwise(s["last"]).alias("last"), F.coalesce(s["lost"], F.when(gap, s["last"])).alias("lost"), (s["blind"] | ((x["rows"] == 0) & s["last"].isNotNull())).alias("blind"),
        )

    rows = rows.withColumn("s", F.aggregate("l", begin, step))
    later = F.aggregate(F.slice("l", 2, len(order)), F.lit(0).cast("long"), lambda a, x: F.greatest(a, x["n"]))
    verdict = (
        F.when(F.col("l")[0]["n"] == 0, "absent").when(F.col("s.lost").isNotNull(), "possible_loss").when(F.col("s.blind"), "not_assessed")
        .when((F.col("l")[0]["n"] >= 20) & (later <= 1), "sparse").otherwise("kept")
    )
    return rows.select("evidence", verdict.alias("verdict"), F.when(F.col("l")[0]["n"] > 0, F.col("s.lost")).alias("lost_after"))
