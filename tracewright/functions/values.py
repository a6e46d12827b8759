"""Column helpers for dirty log values, endpoints, labels and times. All return a Column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Connection states that count as failed, and the codes of techniques in order.
FAILED_STATES = ("S0", "REJ", "RSTOS0", "RSTRH", "SH", "SHR")
TECHNIQUES = ("TA43_01", "TA43_02", "TA01_01", "TA01_02", "TA03_01", "TA11_01", "TA11_02", "TN01_01")
#: Names that stand for a technique code.
LABEL_NAMES = {
    "正常流量": "TN01_01", "正常": "TN01_01", "端口扫描": "TA43_01", "漏洞扫描": "TA43_02", "密码爆破": "TA01_01",
    "漏洞利用": "TA01_02", "植入后门": "TA03_01", "访问后门": "TA11_01", "木马回连": "TA11_02",
    "normal": "TN01_01", "port_scan": "TA43_01", "vulnerability_scan": "TA43_02", "brute_force": "TA01_01",
    "exploit": "TA01_02", "implant": "TA03_01", "backdoor": "TA11_01", "callback": "TA11_02",
}
#: Address ranges that count as private: first address and prefix length.
PRIVATE_V4 = (
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 24),
    ("192.0.2.0", 24), ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("240.0.0.0", 4),
)
#: Ranges of IPv6 that are private or reserved, and what of either kind is public inside them.
PRIVATE_V6 = (
    ((0, 0, 0, 0, 0, 0, 0, 1), 128), ((), 128), ((0, 0, 0, 0, 0, 0xFFFF), 96), ((0x64, 0xFF9B, 1), 48), ((0x100,), 64), ((0x2001,), 23), ((0x2001, 0xDB8), 32), ((0x2002,), 16), ((0xFC00,), 7), ((0xFE80,), 10),
)
PUBLIC_V6 = (
    ((0x2001, 1, 0, 0, 0, 0, 0, 1), 128), ((0x2001, 1, 0, 0, 0, 0, 0, 2), 128), ((0x2001, 3), 32), ((0x2001, 4, 0x112), 48), ((0x2001, 0x20), 28), ((0x2001, 0x30), 28),
)
PUBLIC_V4 = ("192.0.0.9", "192.0.0.10")


def safe_number(value: Column) -> Column:
    """Double of a text; null for null, '', '-', text that isn't a number, and NaN."""
    number = F.trim(value.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_long(value: Column) -> Column:
    """Whole part of safe_number."""
    return safe_number(value).try_cast("long")


def is_failed(state: Column) -> Column:
    return F.coalesce(state.isin(*FAILED_STATES), F.lit(False))


def safe_rate(total: Column, duration: Column) -> Column:
    """total / duration to 4 digits; null where the duration is null or not positive."""
    return F.when(duration > 0, F.round(F.coalesce(total, F.lit(0)) / duration, 4))


def endpoint(ip: Column, port: Column) -> Column:
    return F.struct(F.coalesce(ip, F.lit("")).alias("ip"), F.coalesce(port.cast("string"), F.lit("")).alias("port"))


def canonical_key(src_ip: Column, src_port: Column, dst_ip: Column, dst_port: Column, proto: Column) -> Column:
    """One text for both directions of a connection: ends in string order, protocol in lower case."""
    a, b = endpoint(src_ip, src_port), endpoint(dst_ip, dst_port)
    low, high = F.least(a, b), F.greatest(a, b)
    return F.concat_ws("|", low["ip"], low["port"], high["ip"], high["port"], F.lower(F.coalesce(proto, F.lit(""))))


def packet_protocol(proto: Column, tcp_port: Column, udp_port: Column) -> Column:
    """tcp with TCP ports or a TCP-like name, udp with UDP ports or a UDP-like name, else as it is."""
    name = F.lower(F.coalesce(proto, F.lit("")))
    has = lambda c: F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))
    return F.when(has(tcp_port) | name.isin("tcp", "http", "tls", "ssh", "ftp"), "tcp").when(has(udp_port) | name.isin("udp", "dns"), "udp").otherwise(name)


def uri_path(uri: Column) -> Column:
    return F.substring_index(F.substring_index(uri, "?", 1), "#", 1)


def word_count(text: Column) -> Column:
    """Runs of ASCII letters, digits and _.:/+-, and each CJK character."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9_.:/+-]+|[\u4e00-\u9fff]"), F.lit(0))), F.lit(0))


def estimate_tokens(text: Column) -> Column:
    """A third of the characters, rounded up."""
    return F.floor((F.length(text) + 2) / 3)


def tokenize(text: Column) -> Column:
    """Lower-case runs of word characters and .:/+- or of CJK, without edge punctuation, two characters at least."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[A-Za-z0-9_.:/+-]+|[\\u4e00-\\u9fff]+"), F.lit(0))
    return F.filter(F.transform(runs, lambda t: F.regexp_replace(t, "^[.,;()\\[\\]{}<>\"']+|[.,;()\\[\\]{}<>\"']+$", "")), lambda t: F.length(t) >= 2)


def trim_value(text: Column, limit: int, mark: str = "...[truncated]") -> Column:
    """Text of at most ``limit`` characters, the mark included."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(max(0, limit - len(mark)))), F.lit(mark))).otherwise(text)


def trim_list(values: Column, limit: int, most: int = 12, least: int = 80, mark: str = "...[truncated]") -> Column:
    """The first ``most`` texts of an array, ``limit`` characters dealt among them (``least`` each at least), and how many more there are."""
    shown = F.slice(values, 1, most)
    room = F.greatest(F.lit(least), F.floor(F.lit(limit) / F.greatest(F.size(shown), F.lit(1))).cast("int"))
    cut = F.transform(shown, lambda t: F.when(F.length(t) > room, F.concat(F.left(t, room - len(mark)), F.lit(mark))).otherwise(t))
    more = F.size(values) - most
    return F.when(more > 0, F.concat(cut, F.array(F.concat(F.lit("...["), more.cast("string"), F.lit(" more]"))))).otherwise(cut)


def compact_text(text: Column, limit: int) -> Column:
    """White space collapsed; past ``limit`` cut and closed with one full stop."""
    one = F.trim(F.regexp_replace(text, "\\s+", " "))
    return F.when(F.length(one) > limit, F.concat(F.regexp_replace(F.left(one, F.lit(limit - 1)), "[ ,.;]+$", ""), F.lit("."))).otherwise(one)


def any_positive(fields: dict[str, str], parent: Column, variant: str = "session") -> Column:
    """Whether any field of the struct ``parent`` is set. ``fields``: name to Spark type.

    Booleans count when true and arrays when not empty, in every variant. Numbers above zero count
    only in variant ``capture``; variant ``group`` ignores strings, the others take any text but '' and '-'.
    """
    tests = []
    for name, kind in fields.items():
        c = parent[name]
        if kind == "boolean":
            tests.append(c)
        elif kind.startswith("array"):
            tests.append(F.size(c) > 0)
        elif kind == "string" and variant != "group":
            tests.append(~c.isin("", "-", "none"))
        elif kind in ("int", "bigint", "double") and variant == "capture":
            tests.append(c > 0)
    out = F.lit(False)
    for t in tests:
        out = out | F.coalesce(t, F.lit(False))
    return out


def normalize_label(value: Column) -> Column:
    """Technique code of a code or name in any case; null if unknown."""
    text = F.trim(value)
    code = F.upper(F.regexp_replace(text, "[.-]", "_"))
    names = F.create_map(*(F.lit(x) for pair in LABEL_NAMES.items() for x in pair))
    return F.when(code.isin(*TECHNIQUES), code).otherwise(F.try_element_at(names, F.lower(text)))


def stage_of(technique: Column) -> Column:
    return F.substring_index(technique, "_", 1)


def format_epoch(value: Column, zone: str = "Asia/Shanghai") -> Column:
    """Epoch seconds of 2000 to 2099 as local time without trailing zeros; other numbers plain; other text collapsed."""
    number = safe_number(value)
    inside = number.between(946684800.0, 4102444799.999999)
    local = F.from_utc_timestamp(F.timestamp_micros(F.round(number * 1e6).cast("long")), zone)
    shown = F.regexp_replace(F.regexp_replace(F.date_format(local, "yyyy-MM-dd HH:mm:ss.SSSSSS"), "0+$", ""), "\\.$", "")
    plain = F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(F.regexp_replace(F.format_string("%.6f", number), "\\.?0+$", ""))
    return F.when(inside, shown).when(number.isNotNull(), plain).otherwise(F.trim(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), "\\s+", " ")))


def file_key(path: Column) -> Column:
    """Lower-case base name of a path of either style."""
    return F.lower(F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_key(path), "(.)\\.[^.]*$", "$1")


def v4_number(ip: Column) -> Column:
    """Number of a dotted IPv4 address; null if it isn't one."""
    parts = F.split(ip, "\\.")
    good = ip.rlike("^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\\.(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$")
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s * 256 + p.cast("long"))
    return F.when(good, number)


def v6_groups(ip: Column) -> Column:
    """The eight numbers of an IPv6 address; null if it isn't one. A zone after % doesn't count, the last two numbers may be an IPv4 address."""
    text = F.lower(F.regexp_replace(ip, "%[^%]+$", ""))
    tail = v4_number(F.regexp_extract(text, r":([0-9.]+)$", 1))
    four = F.concat(F.lower(F.hex(F.floor(tail / 65536))), F.lit(":"), F.lower(F.hex(tail % 65536)))
    plain = F.when(F.contains(text, F.lit(".")), F.when(tail.isNotNull(), F.concat(F.regexp_extract(text, r"^(.*:)[0-9.]+$", 1), four))).otherwise(text)
    sides = F.split(plain, "::", -1)
    listed = lambda side: F.filter(F.split(side, ":"), lambda g: g != "")
    head, end = listed(sides[0]), F.coalesce(listed(F.get(sides, F.lit(1))), F.array().cast("array<string>"))
    missing = 8 - F.size(head) - F.size(end)
    zeros = F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0)))
    groups = F.transform(F.concat(head, zeros, end), lambda g: F.conv(g, 16, 10).cast("int"))
    shape = plain.rlike("^([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?(::([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?)?$")
    fits = F.when(F.size(sides) == 1, missing == 0).otherwise(missing >= 1)
    return F.when(F.coalesce(shape & fits & F.contains(plain, F.lit(":")), F.lit(False)), groups)


def _within(groups: Column, first: tuple[int, ...], length: int) -> Column:
    """Whether the first ``length`` bits of the groups are those of ``first``, whose further groups are zero."""
    out = F.lit(True)
    for i in range((length + 15) // 16):
        bits = min(16, length - 16 * i)
        mask = ((1 << bits) - 1) << (16 - bits)
        out = out & (groups[i].bitwiseAND(F.lit(mask)) == ((first[i] if i < len(first) else 0) & mask))
    return out


def is_private(ip: Column) -> Column:
    """Whether an IPv4 or IPv6 address lies in a private or reserved range; null if it isn't one.

    The address is turned into numbers once, as the only element of an array; into those of IPv6 only where there is a colon.
    """
    four = lambda text: sum(int(p) << s for p, s in zip(text.split("."), (24, 16, 8, 0), strict=True))

    def inside(x: Column) -> Column:
        n, g = x["n"], x["g"]
        low = reduce(lambda a, r: a | n.between(four(r[0]), four(r[0]) + (1 << (32 - r[1])) - 1), PRIVATE_V4, F.lit(False))
        narrow = reduce(lambda a, r: a & (n != four(r)), PUBLIC_V4, low)
        wide = reduce(lambda a, r: a & ~_within(g, *r), PUBLIC_V6, reduce(lambda a, r: a | _within(g, *r), PRIVATE_V6, F.lit(False)))
        return F.when(n.isNotNull(), narrow).when(g.isNotNull(), wide)

    numbers = F.struct(v4_number(ip).alias("n"), F.when(F.contains(ip, F.lit(":")), v6_groups(ip)).alias("g"))
    return F.transform(F.array(numbers), inside)[0]


def client_initiated_external(src: Column, dst: Column) -> Column:
    """Private source to public destination; false for bad addresses."""
    return F.coalesce(is_private(src) & ~is_private(dst), F.lit(False))


def leaks(text: Column, tokens: tuple[str, ...]) -> Column:
    """Whether a text carries one of the forbidden tokens, in any case."""
    return F.coalesce(F.lower(text).rlike("|".join(tokens)), F.lit(False))


def confidence(level: Column) -> Column:
    """Number of a confidence given as high, medium or low, or as a number, in 0 to 1."""
    named = F.lower(F.trim(level))
    number = F.when(named == "high", 0.85).when(named == "medium", 0.6).when(named == "low", 0.35).otherwise(safe_number(level))
    return F.when(number.between(0, 1), number)
