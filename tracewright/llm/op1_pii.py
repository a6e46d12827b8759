"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

All of it is built from SQL functions on the rows of one scan; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SPAN = "array<struct<start:int,stop:int,value:string,score:double>>"
CUT = "struct<start:int,stop:int,kind:string>"
#: Code points on either side in which context words count, and what one adds.
NEAR, CONTEXT_BONUS = 40, 0.3
#: Spans of a lower score are dropped.
LEAST_SCORE = 0.5
#: Items that one fold takes; code points of a block of text.
PIECE, BLOCK = 64, 1024


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    each = F.transform(F.split(F.reverse(number), ""), worth)
    return F.aggregate(each, F.lit(0), lambda total, x: total + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (country, check digits, rest) passes the mod-97 check."""
    moved = F.concat(F.substr(account, F.lit(5)), F.left(account, F.lit(4)))
    rest = lambda r, c: F.when(c.between("0", "9"), (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(moved, ""), F.lit(0), rest) == 1


def in_byte(parts: Column) -> Column:
    return F.forall(parts, lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))


@dataclass(frozen=True)
class Kind:
    """How one kind of personal data is found.

    ``hint`` is a plain regular expression without which no match is possible (a cheap test);
    ``pattern`` matches leftmost and without overlaps; ``base`` is the score of a match that
    ``confirm`` accepts; ``context`` (lower case) raises it.
    """

    name: str
    hint: str
    pattern: str
    confirm: Callable[[Column], Column]
    base: float
    context: str


def _sized(value: Column, least: int, most: int) -> Column:
    return F.length(digits(value)).between(least, most)


#: Possessive and bounded forms of the plain patterns: equal matches, without deep recursion or
#: quadratic search in very long runs. A card is a whole run of 13 to 19 digits with single separators.
BASE_KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda v: F.lit(True), 0.8, "mail|contact|write|courriel|correo"),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda v: in_byte(F.split(v, "[.]")), 0.7, "ip|host|server|address|login"),
    Kind("card", "[0-9][ -]?[0-9]", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])", lambda v: luhn(digits(v)), 0.7, "card|visa|mastercard|credit|payment|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", lambda v: _sized(v, 9, 15), 0.7, "phone|call|tel|mobile|fax"),
)
#: Whole length of account numbers by country; others are taken as far as blocks of four go on.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
ANY_IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"


def _iban() -> str:
    """A number of its country's length with nothing after it, else the general form."""
    known = (rf"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, names in IBAN_LENGTHS.items())
    return f"(?:{'|'.join(known)})(?![A-Z0-9])|{ANY_IBAN}"


#: Kinds that the method adds: account numbers need the checksum, nine-digit numbers need context.
ADDED_KINDS = (
    Kind("iban", "[A-Z][A-Z][0-9][0-9] ?[A-Z0-9]", _iban(), lambda v: F.length(F.replace(v, F.lit(" "))).between(15, 34) & mod97(F.replace(v, F.lit(" "))), 0.9, "iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", "[0-9]-[0-9][0-9]-[0-9]", "[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda v: ~v.rlike("^(000|666|9)"), 0.3, "ssn|social security|tax|insured"),
)
KINDS = BASE_KINDS + ADDED_KINDS


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def gathered(items: Column, worth: Callable[[Column], Column], join: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str) -> Column:
    """Struct (carry, list): what ``emit(carry before x, x)`` gives for each item, and the carry at the end.

    The carry starts at 0 and joins the worth of each item, in any grouping (a sum or a maximum). A
    fold copies its state at each step, so items are taken in pieces whose carries come first;
    then long lists take linear time.
    """
    pieces = F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.size(items) - 1, F.lit(PIECE)), lambda i: F.slice(items, i + 1, F.lit(PIECE))))
    state = lambda carry, of: F.struct(carry.alias("carry"), F.array().cast(f"array<{of}>").alias("list"))

    def carries(parts: Column) -> Column:
        sums = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda c, x: join(c, worth(x))))
        return F.aggregate(sums, state(F.lit(0), "int"), lambda s, v: F.struct(join(s["carry"], v).alias("carry"), F.concat(s["list"], F.array(s["carry"])).alias("list")))

    def lists(parts: Column, before: Column) -> Column:
        step = lambda s, x: F.struct(join(s["carry"], worth(x)).alias("carry"), F.concat(s["list"], emit(s["carry"], x)).alias("list"))
        each = F.zip_with(parts, before["list"], lambda p, c: F.aggregate(p, state(c, kind), step)["list"])
        return F.struct(before["carry"].alias("carry"), F.flatten(each).alias("list"))

    return F.coalesce(let(pieces, lambda parts: let(carries(parts), lambda before: lists(parts, before))), state(F.lit(0), kind))


def blocks_of(text: Column) -> Column:
    """The text in blocks of BLOCK code points, so that parts of it are found without counting from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part_of(blocks: Column, start: Column, stop: Column) -> Column:
    """Code points start to stop, stop exclusive and possibly past the end."""
    first = F.floor(start / BLOCK).cast("int")
    near = F.array_join(F.slice(blocks, first + 1, F.floor(stop / BLOCK).cast("int") - first + 1), "")
    return F.substr(near, start - first * BLOCK + 1, stop - start)


def spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind in order: start and stop in code points, stop exclusive, matched text, score.

    The pieces between matches give the places. Null text gives no spans.
    """
    pair = F.zip_with(
        F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )

    def place(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        found = F.array(F.struct(start.alias("start"), (start + F.length(x["value"])).alias("stop"), x["value"].alias("value"), F.lit(0.0).alias("score")))
        return F.when(x["value"].isNull(), F.array().cast(SPAN)).otherwise(found)

    placed = let(pair, lambda p: gathered(p, lambda x: x["gap"] + F.coalesce(F.length(x["value"]), F.lit(0)), lambda c, v: c + v, place, SPAN[len("array<") : -1]))["list"]

    def score(x: Column, blocks: Column) -> Column:
        near = F.lower(part_of(blocks, F.greatest(x["start"] - NEAR, F.lit(0)), x["stop"] + NEAR))
        value = F.lit(kind.base) + F.when(near.rlike(f"(?<![a-z])({kind.context})(?![a-z])"), CONTEXT_BONUS).otherwise(0.0)
        return F.struct(x["start"], x["stop"], x["value"], F.least(value, F.lit(1.0)).alias("score"))

    def scored(confirmed: Column) -> Column:
        own = let(blocks_of(text), lambda blocks: F.transform(confirmed, lambda x: score(x, blocks)))
        return F.when(F.size(confirmed) > 0, F.filter(own, lambda x: x["score"] >= LEAST_SCORE).cast(SPAN)).otherwise(F.array().cast(SPAN))

    return F.when(text.rlike(kind.hint), let(F.filter(placed, lambda x: kind.confirm(x["value"])), scored)).otherwise(F.array().cast(SPAN))


def find_pii(docs: DataFrame) -> DataFrame:
    """Add one array of spans for each kind, named as the kind with ``pii_`` before it.

    Works on the whole of ``text``; null or empty text has no spans, so the arrays are never null.
    Kinds are sought apart, so spans of two kinds may overlap. Columns that already have these
    names are replaced.
    """
    names = {f"pii_{k.name}": k for k in KINDS}
    text = F.col("text").cast("string")
    return docs.drop(*names).withColumns({c: spans(text, k) for c, k in names.items()})


def listed(kinds: tuple[Kind, ...]) -> Column:
    """Comma-joined kind:start:stop of all spans, by kind as listed, then start."""

    def one(kind: Kind) -> Column:
        return F.transform(f"pii_{kind.name}", lambda x: F.concat_ws(":", F.lit(kind.name), x["start"].cast("string"), x["stop"].cast("string")))

    return F.array_join(F.concat(*map(one, kinds)), ",")


def redact(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` with every span of ``text`` replaced by its kind in brackets.

    Overlapping spans become one, named after the kind that starts first (the longer one if both
    do). ``n_chars``, where there is one, is counted anew. Rows without spans stay as they are.
    """
    found = find_pii(docs)

    def tagged(kind: Kind) -> Column:
        return F.transform(f"pii_{kind.name}", lambda x: F.struct(x["start"].alias("start"), (-x["stop"]).alias("minus_stop"), F.lit(kind.name).alias("kind")))

    ordered = F.array_sort(F.concat(*map(tagged, KINDS)))

    def merge(end: Column, x: Column) -> Column:
        # spans come in order: one that starts inside the ones before only makes them longer
        gap = F.struct(end.alias("start"), x["start"].alias("stop"), F.lit(None).cast("string").alias("kind"))
        tag = F.struct(x["start"].alias("start"), x["start"].alias("stop"), x["kind"].alias("kind"))
        return F.when(x["start"] >= end, F.array(gap, tag)).otherwise(F.array().cast(f"array<{CUT}>"))

    def cleaned(cuts: Column) -> Column:
        def joined(blocks: Column) -> Column:
            pieces = F.transform(cuts["list"], lambda p: F.coalesce(F.concat(F.lit("["), p["kind"], F.lit("]")), part_of(blocks, p["start"], p["stop"])))
            return F.concat(F.array_join(pieces, ""), part_of(blocks, cuts["carry"], F.length(text)))

        return F.when(F.size(cuts["list"]) > 0, let(blocks_of(text), joined)).otherwise(text)

    text = F.col("text").cast("string")
    cuts = let(ordered, lambda spans: gathered(spans, lambda x: -x["minus_stop"], F.greatest, merge, CUT))
    out = let(cuts, cleaned)
    clean = found.withColumn("text", out)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by base kind, digest of the base spans, all spans, and their scores in hundredths, for each document; null text is empty."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(f"pii_{k.name}").cast("long").alias(f"n_{k.name}") for k in BASE_KINDS]
    scores = F.array_join(F.concat(*(F.transform(f"pii_{k.name}", lambda x: F.round(x["score"] * 100).cast("int").cast("string")) for k in KINDS)), ",")
    return found.select("doc_id", *counts, F.sha2(listed(BASE_KINDS), 256).alias("base_sha256"), listed(KINDS).alias("spans"), scores.alias("scores"))


#: DuckDB: the plain patterns and the condition on a match.
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = "list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 0 THEN (2 * substr(reverse(d), i, 1)::INT) // 10 + (2 * substr(reverse(d), i, 1)::INT) % 10 ELSE substr(reverse(d), i, 1)::INT END)) % 10 = 0"
_MOD97 = "list_reduce(list_prepend(0, list_transform(string_split(substr(a, 5) || a[:4], ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), lambda r, c: (r * CASE WHEN c < 10 THEN 10 ELSE 100 END + c) % 97) = 1"
_SQL_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(v, '.'), lambda x: x::HUGEINT > 255)) = 0"),
    ("card", r"[0-9]([\x20-]?[0-9])+", f"length(d) BETWEEN 13 AND 19 AND {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 9 AND 15"),
    ("iban", ANY_IBAN, f"length(a) BETWEEN 15 AND 34 AND {_MOD97}"),
    ("ssn", ADDED_KINDS[1].pattern, f"NOT regexp_matches(v, '^(000|666|9)') AND regexp_matches(lower(substr(t, greatest(s - {NEAR}, 0) + 1, e - greatest(s - {NEAR}, 0) + {NEAR})), '(^|[^a-z])({ADDED_KINDS[1].context})($|[^a-z])')"),
)


def _sql() -> str:
    sets = " UNION ALL ".join(
        f"""SELECT doc_id, t, {o} AS o, '{kind}' AS kind, v, s, s + length(v) AS e FROM (
            SELECT doc_id, t, v, (list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::BIGINT AS s FROM (
            SELECT doc_id, t, m, g, unnest(m) AS v, generate_subscripts(m, 1) AS i FROM (
            SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS g FROM d)))"""
        for o, (kind, pattern, _) in enumerate(_SQL_KINDS)
    )
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in BASE_KINDS)
    joined = lambda limit: f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) FILTER (o < {limit}), '')"
    near = f"lower(substr(t, greatest(s - {NEAR}, 0) + 1, e - greatest(s - {NEAR}, 0) + {NEAR}))"
    score = "CASE kind " + " ".join(f"WHEN '{k.name}' THEN {round(k.base * 100)} + CASE WHEN regexp_matches({near}, '(^|[^a-z])({k.context})($|[^a-z])') THEN {round(CONTEXT_BONUS * 100)} ELSE 0 END" for k in KINDS) + " END"
    # conditions are tried kind by kind, so that no test sees another kind's matches
    good = "CASE kind " + " ".join(f"WHEN '{kind}' THEN {test}" for kind, _, test in _SQL_KINDS) + " END"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS (SELECT *, {_DIGITS} AS d, replace(v, ' ', '') AS a FROM ({sets})),
    kept AS (SELECT *, least({score}, 100) AS score FROM found WHERE {good})
    SELECT doc_id, {counts}, sha256({joined(len(BASE_KINDS))}) AS base_sha256, {joined(len(_SQL_KINDS))} AS spans,
           coalesce(string_agg(score::VARCHAR, ',' ORDER BY o, s), '') AS scores
    FROM d LEFT JOIN kept USING (doc_id) GROUP BY doc_id
    """


ORACLE_SQL = _sql()
