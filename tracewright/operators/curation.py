"""Label tables and evaluation sets: joins in both directions, tiers, ranked picks and safe splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from ..functions.ranks import numbered


def majority_flow_label(records: DataFrame, labels: DataFrame) -> DataFrame:
    """Records with the most frequent label of their 4-tuple in either direction (ties: label in order); unmatched rows stay.

    Labels are counted by tuple before the join, so a hot pair of hosts is one row a label.
    """
    ends = ("src_ip", "src_port", "dst_ip", "dst_port")
    forward = labels.groupBy(*ends, "label").agg(F.count("*").alias("n"))
    back = forward.select(F.col("dst_ip").alias("src_ip"), F.col("dst_port").alias("src_port"), F.col("src_ip").alias("dst_ip"), F.col("src_port").alias("dst_port"), "label", "n")
    counts = forward.unionByName(back).groupBy(*ends, "label").agg(F.sum("n").alias("n"))
    best = counts.groupBy(*ends).agg(F.min_by(F.struct("label", "n"), F.struct((-F.col("n")).alias("m"), "label")).alias("b")).select(*ends, "b.*")
    return records.join(best, list(ends), "left").select(records.columns + [F.col("label").alias("flow_label"), F.coalesce("n", F.lit(0)).alias("label_rows")])


#: What public flow labels say: code, family and how sure they are; and what makes a label explicit.
LABEL_REFERENCES = (("From-Botnet", "TA11_02", "ctu_botnet_like", "high"), ("From-Normal", "TN01_01", "ctu_normal_like", "medium"), ("Background", "TN01_01", "ctu_background_like", "low"))
EXPLICIT_START, EXPLICIT_PART = "flow=From-Botnet", "-TCP-CC"


def label_reference(label: Column) -> Column:
    """(reference_code, reference_family, reference_quality) of a public flow label; null is unmatched, other labels are unknown."""
    part = lambda i, other: F.coalesce(*(F.when(label.contains(r[0]), F.lit(r[i])) for r in LABEL_REFERENCES), other)
    quality = F.when(label.isNull(), "unmatched").otherwise(part(3, F.lit("unknown")))
    return F.struct(part(1, F.lit(None).cast("string")).alias("reference_code"), part(2, F.lit("unknown")).alias("reference_family"), quality.alias("reference_quality"))


def is_explicit(label: Column) -> Column:
    """Whether a label names a botnet's control connection."""
    return F.coalesce(label.startswith(EXPLICIT_START) & label.contains(EXPLICIT_PART), F.lit(False))


def endpoint_label_join(endpoints: DataFrame, labels: DataFrame, min_labels: int = 5, min_connections: int = 5, min_score: float = 0.45) -> DataFrame:
    """Endpoints of ``(src_ip, dst_ip, dst_port, proto, connections, score)`` with enough explicit labels, connections and score.

    With a column ``label``, only explicit labels count, and ``primary_label`` is the most frequent one
    (ties: label in order). With a column ``tier``, only endpoints of the high tier stay.
    """
    keys = ["src_ip", "dst_ip", "dst_port", "proto"]
    if "label" in labels.columns:
        each = labels.where(is_explicit(F.col("label"))).groupBy(*keys, "label").agg(F.count("*").alias("n"))
        counted = each.groupBy(*keys).agg(F.sum("n").alias("labels"), F.min_by("label", F.struct((-F.col("n")).alias("m"), "label")).alias("primary_label"))
    else:
        counted = labels.groupBy(*keys).agg(F.count("*").alias("labels"))
    fit = endpoints.where((F.col("connections") >= min_connections) & (F.col("score") >= min_score))
    fit = fit.where("tier = 'high'") if "tier" in endpoints.columns else fit
    return fit.join(counted.where(F.col("labels") >= min_labels), keys)


def refresh_records(records: DataFrame, updates: DataFrame, flow_only: Column) -> DataFrame:
    """Records with the evidence of the update of the same id, except flow-only rows; ``refreshed`` says which changed."""
    new = updates.select("record_id", F.col("evidence").alias("_new"))
    out = records.join(new, "record_id", "left")
    use = ~flow_only & F.col("_new").isNotNull()
    return out.withColumns({"evidence": F.when(use, F.col("_new")).otherwise(F.col("evidence")), "refreshed": use}).drop("_new")


def missing_keys(records: DataFrame, updates: DataFrame, key: str = "record_id") -> DataFrame:
    """(side, key) of the keys that only one side has: records without an update, updates without a record."""
    only = lambda a, b, side: a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti").select(F.lit(side).alias("side"), key)
    return only(records, updates, "records").unionByName(only(updates, records, "updates"))


def boundary_documents(ranked: DataFrame, rules: DataFrame) -> DataFrame:
    """(record_id, docs): the documents of each record's ranked rules (``boundary_rule_join``) in order, each once; ``rules(rule_id, docs)``."""
    listed = ranked.join(rules.select("rule_id", F.posexplode("docs").alias("at", "doc")), "rule_id")
    firsts = listed.groupBy("record_id", "doc").agg(F.min(F.struct("place", "at")).alias("first"))
    return firsts.groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "doc"))), lambda x: x["doc"]).alias("docs"))


def boundary_rule_join(records: DataFrame, rules: DataFrame, limit: int = 6) -> DataFrame:
    """(record_id, place, rule_id): rules that share two candidates or more first, then those that share one; at most ``limit``.

    Joined by candidate code, so only pairs that share one meet. There are few codes and many records of
    each, so the rules, a short table, are sent to the records and no task gathers the records of a code.
    """
    pairs = records.select("record_id", F.explode("candidates").alias("code")).join(F.broadcast(rules.select("rule_id", F.explode("codes").alias("code"))), "code")
    shared = pairs.distinct().groupBy("record_id", "rule_id").agg(F.count("*").alias("n"))
    best = Window.partitionBy("record_id").orderBy(F.desc(F.col("n") >= 2), "rule_id")
    return shared.withColumn("place", F.row_number().over(best)).where(F.col("place") <= limit).select("record_id", "place", "rule_id", "n")


def label_counts(rows: DataFrame, keys: list[str], codes: tuple[str, ...], code: str) -> DataFrame:
    """Rows for each combination of ``keys`` (which hold ``code``); codes that never occur have one row of 0."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("rows"))
    known = rows.sparkSession.createDataFrame([(c,) for c in codes], f"{code} string")
    missing = known.join(counts.select(code).distinct(), code, "left_anti").withColumn("rows", F.lit(0).cast("long"))
    return counts.unionByName(missing, allowMissingColumns=True)


def confidence_tier(rows: DataFrame) -> DataFrame:
    """Tier of ``rows(source, level)``: strict for high outside synthetic sources, medium for medium, else synthetic or weak."""
    tier = F.when(F.col("source") == "synthetic", "synthetic").when(F.col("level") == "high", "strict").when(F.col("level") == "medium", "medium").otherwise("weak")
    return rows.withColumn("tier", tier)


def row_checks(rows: DataFrame, required: list[str], legal: tuple[str, ...]) -> DataFrame:
    """(record_id, problem): required fields that are empty, illegal codes, ids that occur more than once."""
    empty = [F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"missing_{c}")) for c in required]
    problems = F.filter(F.array(*empty, F.when(~F.col("truth").isin(*legal), F.lit("illegal_code"))), lambda p: p.isNotNull())
    own = rows.select("record_id", F.explode(problems).alias("problem"))
    twice = rows.groupBy("record_id").count().where("count > 1").select("record_id", F.lit("duplicate_id").alias("problem"))
    return own.unionByName(twice)


def first_per_class(rows: DataFrame, label: str, order: list[Column], n: int) -> DataFrame:
    """At most ``n`` rows for each class in the given order, with their place."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(label).orderBy(*order))).where(F.col("place") <= n)


def tiered_fill(rows: DataFrame, label: str, n: int, tiers: tuple[str, ...] = ("strict", "medium", "synthetic")) -> DataFrame:
    """First n rows of each class from the tiers in order, and whether the class is short."""
    rank = reduce(lambda c, i: c.when(F.col("tier") == tiers[i], i), range(1, len(tiers)), F.when(F.col("tier") == tiers[0], 0))
    kept = first_per_class(rows.withColumn("_t", rank).where("_t is not null"), label, [F.col("_t"), F.col("record_id")], n)
    return kept.withColumn("short", F.count("*").over(Window.partitionBy(label)) < n).drop("_t")


def round_robin(rows: DataFrame, label: str, limit: int) -> DataFrame:
    """The first row of every class before the second of any, up to ``limit`` rows; only ``limit`` rows a class are ranked on."""
    ranked = first_per_class(rows, label, [F.col("record_id")], limit)
    return ranked.orderBy("place", label).limit(limit)


def heuristic_top_sets(rows: DataFrame, first: str, second: str, k: int = 45) -> DataFrame:
    """The k best by one score, then the k best of the rest by the other; ties by id."""
    a = rows.orderBy(F.desc(first), "record_id").limit(k).withColumn("chosen_by", F.lit(first))
    b = rows.join(a, "record_id", "left_anti").orderBy(F.desc(second), "record_id").limit(k).withColumn("chosen_by", F.lit(second))
    return a.unionByName(b)


def best_per_label(rows: DataFrame, label: str, limit: int) -> DataFrame:
    """The best-scored row of each label (ties by id), of these the ``limit`` best."""
    return first_per_class(rows, label, [F.desc("score"), F.col("record_id")], 1).orderBy(F.desc("score"), "record_id").limit(limit)


def _renamed(value: Column, kind: DataType, capture: Column, record: Column, aliases: tuple[Column, Column]) -> Column:
    """``value`` with the two ids replaced wherever they occur as a whole string, at any depth."""
    if isinstance(kind, StringType):
        return F.when(value == record, aliases[1]).when(value == capture, aliases[0]).otherwise(value)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _renamed(x, kind.elementType, capture, record, aliases))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, x: _renamed(x, kind.valueType, capture, record, aliases))
    if isinstance(kind, StructType):
        inner = F.struct(*(_renamed(value[f.name], f.dataType, capture, record, aliases).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), inner)
    return value


def pseudonymize(rows: DataFrame) -> DataFrame:
    """Add capture_alias and record_alias: captures run by their first record, records by id inside their capture.

    The ids of the row are replaced by its aliases in all other string columns too, nested ones
    included; capture_id and record_id stay as the key. Both numberings are made in ranges, so
    neither many captures nor one huge capture meet in one task.
    """
    firsts = numbered(rows.groupBy("capture_id").agg(F.min("record_id").alias("_first")), [], [F.asc("_first"), F.asc("capture_id")], "_c")
    named = firsts.select("capture_id", F.concat(F.lit("capture_"), F.col("_c").cast("string")).alias("capture_alias"))
    placed = numbered(rows, ["capture_id"], [F.asc("record_id")], "_n")
    out = placed.join(named, "capture_id").withColumn("record_alias", F.concat_ws("_", "capture_alias", F.lit("record"), F.col("_n").cast("string"))).drop("_n")
    ids, aliases = [F.col(c).cast("string") for c in ("capture_id", "record_id")], (F.col("capture_alias"), F.col("record_alias"))
    nested = {f.name: _renamed(F.col(f.name), f.dataType, *ids, aliases) for f in rows.schema.fields if f.name not in ("capture_id", "record_id")}
    return out.withColumns(nested) if nested else out


def group_safe_split(rows: DataFrame, group: str, holdout: DataFrame, bucket: Column, train: int = 80, valid: int = 10) -> DataFrame:
    """Rows whose id isn't held out, with split by a bucket (0 to 99) of their group: no group is in two splits."""
    rest = rows.join(holdout.select("record_id").distinct(), "record_id", "left_anti")
    return rest.withColumn("split", F.when(bucket < train, "train").when(bucket < train + valid, "valid").otherwise("test"))
