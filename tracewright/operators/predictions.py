"""Prediction tables: routing, rule predictions, parsing, context and submission rows."""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, StringType, StructType

from ..functions.text import redact_sensitive_text
from ..functions.values import TECHNIQUES, compact_text, confidence, estimate_tokens, file_key, file_stem, format_epoch, normalize_label, stage_of, trim_value


#: Strengths of evidence in rising order; flags that send a record to the model however few there
#: are; names of the tests in their order. Fixed values.
STRENGTHS = ("weak", "medium", "strong")
STAGE_CODES = ("TA43", "TA01", "TA03", "TA11", "TN01")
BLOCKING_FLAGS = ("weak_attack_uncertainty", "payload_observability_gap", "model_prediction_differs_from_primary_rule_candidate")
REASONS = (
    "missing_primary_rule_candidate", "normal_rule_direct_disabled", "score_below_threshold", "margin_below_threshold", "evidence_strength_below_threshold",
    "too_many_conflicts", "blocking_conflict_flag", "high_confidence_rule_candidate",
)


def route_records(records: DataFrame, done: DataFrame, min_score: float = 7.0, min_margin: float = 2.5, max_flags: int = 0, allow_normal: bool = False, min_strength: str = "strong", blocking: tuple[str, ...] = BLOCKING_FLAGS) -> DataFrame:
    """Records that are not done, with route rule_direct or model and the first failing test as reason.

    Tests in order: a primary code, not normal unless allowed, score, margin, strength, number of
    conflicts, blocking conflicts. ``strength`` is weak, medium or strong; null or another word is
    below all. Null scores and margins are 0. ``flag_names`` is an array whose different names
    count as conflicts; without it ``flags`` has their number. A test is left out only if the table
    lacks its column.
    """
    test = lambda c, n: F.coalesce(F.col(c), F.lit(0.0)) < n
    reason = F.when(F.coalesce(F.trim("primary"), F.lit("")) == "", REASONS[0]).when(~F.lit(allow_normal) & (F.col("primary") == "TN01_01"), REASONS[1])
    reason = reason.when(test("score", min_score), REASONS[2]).when(test("margin", min_margin), REASONS[3])
    if "strength" in records.columns:
        enough = F.lower(F.trim("strength")).isin(*STRENGTHS[STRENGTHS.index(min_strength) :])
        reason = reason.when(~F.coalesce(enough, F.lit(False)), REASONS[4])
    if "flag_names" in records.columns:
        names = F.array_distinct(F.coalesce("flag_names", F.array().cast("array<string>")))
        reason = reason.when(F.size(names) > max_flags, REASONS[5]).when(F.exists(names, lambda f: f.isin(*blocking)), REASONS[6])
    elif "flags" in records.columns:
        reason = reason.when(F.col("flags") > max_flags, REASONS[5])
    rest = records.join(done.select("record_id").distinct(), "record_id", "left_anti")
    return rest.withColumn("reason", F.coalesce(reason, F.lit(REASONS[7]))).withColumn("route", F.when(F.col("reason") == REASONS[7], "rule_direct").otherwise("model"))


def rule_direct_prediction(records: DataFrame, forced: bool = False, reason_chars: int = 300) -> DataFrame:
    """(record_id, technique, stage, confidence, reason) by the rules alone.

    The primary code; without one the code of the best score among the columns ``score_<code>``
    (ties: not the normal one, then the earlier code), else the normal one. Confidence starts at 0.78
    (0.72 if forced) and gains 0.015 a point above a score of 7 (0.07 at most) and above a margin of 2.5
    (0.05 at most); strong evidence adds 0.04, weak takes 0.08, the normal code takes 0.06; held in
    0.55 to 0.9. The score is that of the code where the columns are there, else ``score``. The
    reason is the first two of ``rule_evidence``, if the table has that and it isn't empty.
    """
    own = F.upper(F.trim("primary"))
    technique, score = F.when(own.isin(*TECHNIQUES), own), F.coalesce(F.col("score"), F.lit(0.0)) if "score" in records.columns else F.lit(0.0)
    scored = [(i, c) for i, c in enumerate(TECHNIQUES) if f"score_{c}" in records.columns]
    if scored:
        worth = lambda c: F.coalesce(F.col(f"score_{c}"), F.lit(0.0))
        best = F.array_max(F.array(*(F.struct(worth(c).alias("score"), F.lit(c != "TN01_01").alias("attack"), F.lit(-i).alias("place"), F.lit(c).alias("code")) for i, c in scored)))
        technique = F.coalesce(technique, best["code"])
        score = F.coalesce(*(F.when(technique == c, worth(c)) for _, c in scored), F.lit(0.0))
    technique = F.coalesce(technique, F.lit("TN01_01"))
    above = lambda c, least, most: F.least(F.greatest(c - least, F.lit(0.0)) * 0.015, F.lit(most))
    sure = F.lit(0.72 if forced else 0.78) + above(score, 7.0, 0.07) + above(F.coalesce(F.col("margin"), F.lit(0.0)), 2.5, 0.05)
    if "strength" in records.columns:
        strength = F.lower(F.trim("strength"))
        sure = sure + F.when(strength == "strong", 0.04).when(strength == "weak", -0.08).otherwise(0.0)
    sure = F.round(F.least(F.greatest(sure - F.when(technique == "TN01_01", 0.06).otherwise(0.0), F.lit(0.55)), F.lit(0.9)), 4)
    plain = F.concat(F.lit("Rule scores favour "), technique, F.lit("."))
    lines = F.array_distinct(F.filter(F.transform("rule_evidence", lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")) if "rule_evidence" in records.columns else None
    reason = plain if lines is None else F.when(F.size(lines) > 0, F.array_join(F.slice(lines, 1, 2), "; ")).otherwise(plain)
    return records.select("record_id", technique.alias("technique"), stage_of(technique).alias("stage"), sure.alias("confidence"), compact_text(reason, reason_chars).alias("reason"))


def shard(records: DataFrame, n: int) -> DataFrame:
    """Add shard in 0 to n - 1 by a hash of the id: equal everywhere, without numbering all rows."""
    return records.withColumn("shard", F.pmod(F.xxhash64("record_id"), F.lit(n)).cast("int"))


def merge_shards(predictions: DataFrame) -> DataFrame:
    """One row for each record_id: the row of the last shard, of these the last attempt."""
    last = Window.partitionBy("record_id").orderBy(F.desc("shard"), F.desc("attempt"))
    return predictions.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def _one_object(text: str | None) -> str | None:
    """The one JSON object of a text outside think blocks; 'many' if there are more, objects inside objects included."""
    text = re.sub(r"(?is)<think>.*?</think>", "", text or "")
    decoder, found = json.JSONDecoder(), []
    for m in re.finditer(r"\{", text):
        try:
            found.append(decoder.raw_decode(text, m.start())[0])
        except (ValueError, RecursionError):
            continue
        if len(found) > 1:
            return "many"
    return json.dumps(found[0], ensure_ascii=False) if found else None


def parse_predictions(responses: DataFrame, most: int = 500) -> DataFrame:
    """(record_id, stage, technique, consistent, confidence, reason, error) of ``responses(record_id, response)``.

    A response must hold exactly one JSON object, outside think blocks. Its technique is
    ``technique_guess``, else ``technique_code`` or ``predicted_code``, and may be missing; its
    stage is ``stage_code``, else that of the technique. Stage and technique must be known codes
    (``consistent`` says whether they agree), the reason must not be blank, the confidence be a
    number of 0 to 1 or high, medium or low. The first failing test is the error, and all else is null then.
    """

    @F.pandas_udf(StringType())
    def objects(texts: pd.Series) -> pd.Series:
        return texts.map(_one_object)

    rows = responses.withColumn("_o", objects("response"))
    field = lambda n: F.nullif(F.get_json_object("_o", f"$.{n}"), F.lit(""))
    code = F.upper(F.coalesce(field("technique_guess"), field("technique_code"), field("predicted_code")))
    rows = rows.withColumns({"_id": field("record_id"), "_code": F.nullif(F.when(code != "NULL", code), F.lit("")), "_stage": field("stage_code")})
    rows = rows.withColumn("_stage", F.upper(F.coalesce("_stage", stage_of(F.trim("_code")))))
    reason, sure = F.trim(F.regexp_replace(F.coalesce(field("reason"), F.lit("")), r"\s+", " ")), F.round(confidence(field("confidence")), 4)
    error = (
        F.when(F.col("_o").isNull(), "no_object").when(F.col("_o") == "many", "many_objects").when(~F.col("_id").eqNullSafe(F.col("record_id").cast("string")), "wrong_id")
        .when(~F.coalesce(F.col("_stage").isin(*STAGE_CODES), F.lit(False)), "bad_stage").when(F.col("_code").isNotNull() & ~F.col("_code").isin(*TECHNIQUES), "unknown_code")
        .when(reason == "", "no_reason").when(sure.isNull(), "bad_confidence")
    )
    same = F.col("_code").isNull() | (stage_of(F.col("_code")) == F.col("_stage"))
    fine = lambda c, n: F.when(F.col("error").isNull(), c).alias(n)
    return rows.withColumn("error", error).select("record_id", fine(F.col("_stage"), "stage"), fine(F.col("_code"), "technique"), fine(same, "consistent"), fine(sure, "confidence"), fine(F.left(reason, F.lit(most)), "reason"), "error")


def attach_context(predictions: DataFrame, records: DataFrame, parses: DataFrame | None = None) -> DataFrame:
    """Predictions with what they lack from the record of the same id or, failing that, the first record of their capture.

    A column of a prediction wins where it isn't null; the others come from the record. ``context``
    says which it was: record, capture or none. With ``parses(capture_id, file_name)``, an empty file
    name is filled from there. Record ids are unique; the first record is the one of the least id.
    """
    whole = F.struct(*(F.col(c) for c in records.columns))
    own = records.select(F.col("record_id").alias("_id"), whole.alias("_own"))
    first = records.groupBy(F.col("capture_id").alias("_capture")).agg(F.min_by(whole, "record_id").alias("_first"))
    out = predictions.join(own, F.col("record_id") == F.col("_id"), "left").join(first, F.col("capture_id") == F.col("_capture"), "left")
    out = out.withColumns({"_base": F.coalesce("_own", "_first"), "context": F.when(F.col("_own").isNotNull(), "record").when(F.col("_first").isNotNull(), "capture").otherwise("none")})
    mine = [F.coalesce(F.col(c), F.col("_base")[c]).alias(c) if c in records.columns else F.col(c) for c in predictions.columns]
    theirs = [F.col("_base")[c].alias(c) for c in records.columns if c not in predictions.columns]
    out = out.select(*mine, *theirs, "context")
    if parses is None:
        return out
    names = parses.groupBy(F.col("capture_id").alias("_capture")).agg(F.max("file_name").alias("_name"))
    own_name = F.nullif(F.trim("file_name"), F.lit("")) if "file_name" in out.columns else F.lit(None).cast("string")
    return out.join(names, F.col("capture_id") == F.col("_capture"), "left").withColumn("file_name", F.coalesce(own_name, "_name")).drop("_capture", "_name")


#: Addresses that stand for none, and what parts of an endpoint are worth.
PLACEHOLDERS = ("1.1.1.1", "2.2.2.2")
ADDRESS = r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9a-fA-F]*:[0-9a-fA-F:.]+)$"


def _address_worth(ip: Column) -> Column:
    text = F.trim(F.coalesce(ip, F.lit("")))
    return F.when((text == "") | (F.lower(text) == "multiple"), -20).when(text.isin(*PLACEHOLDERS), -120).when(text.rlike(ADDRESS), 45).otherwise(5)


def _port_worth(port: Column, many: Column) -> Column:
    text = F.lower(F.trim(F.coalesce(port.cast("string"), F.lit(""))))
    return F.when(text.isin("", "-"), -8).when(text == "multiple", F.when(many, 2).otherwise(-4)).when(text.contains(","), F.when(many, 8).otherwise(2)).otherwise(12)


def representative_endpoint(rows: DataFrame, captures: DataFrame) -> DataFrame:
    """One endpoint for each of ``captures(capture_id, technique, src_ip, dst_ip, dst_port, ports)``.

    Candidates are ``rows(capture_id, kind, place, start_time, end_time, src_ip, src_port, dst_ip,
    dst_port)``: of kind ``scan`` for scans (``session`` if there are none), ``benign`` for normal
    captures, else ``session``. The first is taken unless another scores strictly higher. Fields it
    lacks come from the capture. A scan shows the capture's list of ports where there is one.
    """
    wanted = F.when(F.col("technique") == "TA43_01", "scan").when(stage_of(F.col("technique")) == "TN01", "benign").otherwise("session")
    heads = captures.select("capture_id", "technique", *(F.col(c).alias(f"_{c}") for c in ("src_ip", "dst_ip", "dst_port")), "ports", wanted.alias("wanted"))
    scan = F.col("wanted") == "scan"
    known = lambda c: F.coalesce(~F.trim(F.col(c).cast("string")).isin("", "-"), F.lit(False))
    score = _address_worth(F.col("src_ip")) + _address_worth(F.col("dst_ip")) + _port_worth(F.col("src_port"), F.lit(False)) + _port_worth(F.col("dst_port"), scan)
    score = score + F.when(known("start_time"), 4).otherwise(0) + F.when(known("end_time"), 4).otherwise(0)
    score = score - F.when(F.col("src_ip").isin(*PLACEHOLDERS) & F.col("dst_ip").isin(*PLACEHOLDERS), 80).otherwise(0)
    fits = (F.col("kind") == F.col("wanted")) | (scan & (F.col("kind") == "session"))
    scored = rows.join(heads, "capture_id").where(fits).withColumn("endpoint_score", score)
    best = Window.partitionBy("capture_id").orderBy(F.col("kind") != F.col("wanted"), F.desc("endpoint_score"), "place")
    top = scored.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("capture_id", "kind", "place", "endpoint_score", "src_ip", "dst_ip", "dst_port")
    out = heads.join(top, "capture_id", "left")
    part = lambda c: F.when(known(c), F.col(c).cast("string")).otherwise(F.col(f"_{c}").cast("string"))
    return out.select(
        "capture_id", "technique", "kind", "place", "endpoint_score", part("src_ip").alias("src_ip"), part("dst_ip").alias("dst_ip"),
        F.when(scan & F.coalesce(F.col("ports") != "", F.lit(False)), F.col("ports")).otherwise(part("dst_port")).alias("dst_port"),
    )


#: Cells of a submission row besides its number, label and reason; more keys whose values a reason never shows. Fixed values.
CELLS = ("start", "end", "src_ip", "src_port", "dst_ip", "dst_port")
REASON_KEYS = r"(?i)\b(api[_-]?key|secret[_-]?key|authorization)\s*[:=]\s*\S+"


def submission_rows(predictions: DataFrame, templates: DataFrame, zone: str = "Asia/Shanghai", reason_limit: int = 300, label_level: str = "stage") -> DataFrame:
    """(record_id, number, start, end, src_ip, src_port, dst_ip, dst_port, label, reason): predictions in submission form.

    ``templates(key, number, ...)`` may have the six cells from start to dst_port: where the id, the
    file name or its stem matches a key, in this order and whatever the case, the template's number and
    cells are taken as they are, also its empty ones; of equal keys the least row. Elsewhere the cells
    come from ``predictions(record_id, file_name, start_time, end_time, ..., technique, reason)`` with
    times in ``zone``. Null or missing cells are empty. The label is the stage or the technique; the
    reason is on one line, redacted and cut.
    """
    text = lambda df, c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) if c in df.columns else F.lit("")
    time = lambda c: format_epoch(F.col(c).cast("string"), zone) if c in predictions.columns else F.lit("")
    keys = predictions.select("record_id", F.posexplode(F.array(F.lower(F.col("record_id").cast("string")), file_key(F.col("file_name")), file_stem(F.col("file_name")))).alias("_p", "_key"))
    rows = templates.groupBy(F.lower(F.trim("key")).alias("_key")).agg(F.min(F.struct(*(text(templates, c).alias(c) for c in ("number", *CELLS)))).alias("_t"))
    found = keys.join(rows, "_key").groupBy("record_id").agg(F.min_by("_t", "_p").alias("_t"))
    own = F.struct(F.col("record_id").cast("string").alias("number"), time("start_time").alias("start"), time("end_time").alias("end"), *(text(predictions, c).alias(c) for c in CELLS[2:]))
    out = predictions.join(found, "record_id", "left").withColumn("_row", F.coalesce("_t", own))
    label = F.col("technique") if label_level == "technique" else F.coalesce(stage_of(F.col("technique")), F.col("technique"))
    line = redact_sensitive_text(F.coalesce("reason", F.lit("")), reason_limit)
    return out.select("record_id", "_row.*", label.alias("label"), F.left(F.regexp_replace(line, REASON_KEYS, "$1=[REDACTED]"), F.lit(reason_limit)).alias("reason"))


def conflict_cases(predictions: DataFrame) -> DataFrame:
    """Predictions that need review of ``(record_id, technique, rule, attack_score, benign_evidence)`` with sorted flags."""
    normal = F.col("technique") == "TN01_01"
    flags = F.filter(F.array(
        F.when(F.col("technique") != F.col("rule"), "differs_from_rule"), F.when(normal & (F.col("attack_score") >= 3), "normal_with_attack"), F.when(~normal & F.col("benign_evidence"), "attack_with_benign"),
    ), lambda f: f.isNotNull())
    return predictions.withColumn("conflicts", F.array_sort(F.array_distinct(flags))).where(F.size("conflicts") > 0)


def _sparse(kind: DataType, c: Column) -> Column:
    """A value without false flags, blank texts and empty lists; null if nothing is left."""
    if isinstance(kind, StructType):
        parts = {f.name: _sparse(f.dataType, c[f.name]) for f in kind.fields}
        left = reduce(lambda a, b: a | b, (p.isNotNull() for p in parts.values()), F.lit(False))
        return F.when(left, F.struct(*(p.alias(n) for n, p in parts.items())))
    if isinstance(kind, BooleanType):
        return F.when(c, c)
    if isinstance(kind, StringType):
        return F.nullif(c, F.lit(""))
    if isinstance(kind, ArrayType):
        kept = F.filter(F.transform(c, lambda x: _sparse(kind.elementType, x)), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    return F.when(F.size(c) > 0, c) if isinstance(kind, MapType) else c


def listed_fields(records: DataFrame, fields: tuple[str, ...], most: int = 5) -> Column:
    """Array of (name, text) of the fields that a record has, in order: JSON without what is empty or false.

    Arrays keep their first ``most`` values and say how many more there are.
    """
    kinds = {f.name: f.dataType for f in records.schema}

    def text(name: str) -> Column:
        kind, value = kinds[name], _sparse(kinds[name], F.col(name))
        if isinstance(kind, StringType):
            return value
        if isinstance(kind, ArrayType):
            shown = F.to_json(F.slice(value, 1, most))
            return F.when(F.size(value) > most, F.concat(shown, F.lit("...["), (F.size(value) - most).cast("string"), F.lit(" more]"))).otherwise(shown)
        return F.to_json(value) if isinstance(kind, StructType | MapType) else value.cast("string")

    return F.array_compact(F.array(*(F.when(text(n).isNotNull(), F.struct(F.lit(n).alias("name"), text(n).alias("text"))) for n in fields if n in kinds)))


def dealt_text(listed: Column, budget: Column, mark: str = "...[truncated]") -> Column:
    """The fields, a line each, within ``budget`` characters: the longest ones are cut to a common length.

    Names and line ends are part of the budget. Fields that are shorter than the common length stay
    whole, and what they leave is dealt to the others.
    """
    frame = F.aggregate(listed, F.lit(0), lambda s, x: s + F.length(x["name"]) + 3) - 1
    sizes = F.array_sort(F.transform(listed, lambda x: F.length(x["text"])))
    begin = F.struct(F.greatest(budget - frame, F.lit(0)).cast("int").alias("left"), F.size(listed).alias("n"), F.lit(-1).alias("level"))

    def step(s: Column, size: Column) -> Column:
        fits = size * s["n"] <= s["left"]
        return F.when(s["level"] >= 0, s).when(fits, F.struct((s["left"] - size).alias("left"), (s["n"] - 1).alias("n"), s["level"])).otherwise(
            F.struct(s["left"], s["n"], F.floor(s["left"] / s["n"]).cast("int").alias("level"))
        )

    level = F.aggregate(sizes, begin, step)["level"]
    # the level as the only element of an array, so that it is worked out once
    cut = lambda t, n: F.when((n < 0) | (F.length(t) <= n), t).when(n <= len(mark), F.left(t, n)).otherwise(F.concat(F.left(t, n - len(mark)), F.lit(mark)))
    return F.transform(F.array(level), lambda n: F.array_join(F.transform(listed, lambda x: F.concat(x["name"], F.lit(": "), cut(x["text"], n))), "\n"))[0]


def prompt_text(records: DataFrame, snippets: DataFrame, head: str, budget: int = 4000, per_snippet: int = 550, body_limit: int = 1800, least_body: int = 450, fields: tuple[str, ...] = ()) -> DataFrame:
    """Prompts of ``records(record_id, body, context)`` and ``snippets(record_id, rank, pinned, text)`` within a budget of characters.

    Parts, a line each: head, context, snippets by rank, record. What doesn't fit goes in this
    order: ordinary snippets from the lowest rank up; then the record is shortened (to
    ``least_body`` at the least); then all snippets; then the context. A prompt that is still too
    long is marked ``over``. Long snippets and records are trimmed before. Null parts are left out.

    With ``fields``, the record is made of these columns instead of ``body``, and whenever it has to
    be shorter, its longest fields are cut to a common length (``dealt_text``).
    """
    listed = listed_fields(records, fields) if fields else F.array().cast("array<struct<name:string,text:string>>")
    whole = dealt_text(F.col("_fields"), F.lit(body_limit)) if fields else trim_value(F.coalesce("body", F.lit("")), body_limit)
    rows = records.withColumn("_fields", listed).select("record_id", "_fields", whole.alias("_body"), F.col("context").alias("_context"))
    rows = rows.withColumn("_fixed", F.lit(len(head)) + 1 + F.coalesce(F.length("_context") + 1, F.lit(0)))
    bits = snippets.select("record_id", "rank", F.coalesce("pinned", F.lit(False)).alias("pinned"), trim_value(F.col("text"), per_snippet).alias("text")).where("text is not null")
    order = Window.partitionBy("record_id").orderBy(F.desc("pinned"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    sized = bits.join(rows, "record_id").withColumn("_end", F.sum(F.length("text") + 1).over(order))
    kept = F.col("pinned") | (F.col("_fixed") + F.col("_end") + F.length("_body") <= budget)
    packed = sized.groupBy("record_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(kept, F.struct((~F.col("pinned")).alias("later"), "rank", "text")))), lambda s: s["text"]), "\n").alias("_text"),
        F.count_if(kept).alias("_kept"), F.count("*").alias("_all"),
    )
    out = rows.join(packed, "record_id", "left").withColumn("_text", F.when(F.col("_kept") > 0, F.col("_text")))
    wide = F.coalesce(F.length("_text") + 1, F.lit(0))
    room = F.greatest(budget - F.col("_fixed") - wide, F.lit(least_body))
    mark = "...[truncated]"
    out = out.withColumn("shortened", F.length("_body") > room)
    shorter = dealt_text(F.col("_fields"), room) if fields else F.concat(F.left("_body", room - len(mark)), F.lit(mark))
    out = out.withColumn("_body", F.when(F.col("shortened"), shorter).otherwise(F.col("_body")))
    out = out.withColumn("_text", F.when(F.col("_fixed") + wide + F.length("_body") <= budget, F.col("_text")))
    out = out.withColumn("context_dropped", F.col("_context").isNotNull() & (F.col("_fixed") + wide + F.length("_body") > budget))
    prompt = F.concat_ws("\n", F.lit(head), F.when(~F.col("context_dropped"), F.col("_context")), "_text", "_body")
    used = F.when(F.col("_text").isNotNull(), F.col("_kept")).otherwise(0)
    out = out.select("record_id", prompt.alias("prompt"), used.cast("long").alias("used"), (F.coalesce("_all", F.lit(0)) - used).cast("long").alias("dropped"), "shortened", "context_dropped")
    return out.withColumns({"over": F.length("prompt") > budget, "tokens": estimate_tokens(F.col("prompt"))})
