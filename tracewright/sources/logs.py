"""Readers of log and packet files, and writers of result tables. Files are read where Spark reads them, never by the driver."""

from __future__ import annotations

import codecs
import csv
import io
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from ..functions.text import redact_sensitive_text

#: Columns of a connection log.
CONN = ("ts", "uid", "id_orig_h", "id_orig_p", "id_resp_h", "id_resp_p", "proto", "service", "duration", "orig_pkts", "resp_pkts", "orig_bytes", "resp_bytes", "conn_state", "history")
#: Names under which result tables give their fields, first match wins.
ALIASES = {
    "pcap": ("pcap", "pcap_name", "filename", "sample", "样本", "文件名", "pcap文件名"),
    "number": ("编号", "record_id", "number", "序号", "id"),
    "stage": ("攻击阶段编号或正常流量编号", "stage_code", "stage", "阶段", "label", "结果"),
    "technique": ("攻击技术编号或正常流量编号", "technique_guess", "technique_code", "技术编号", "技术"),
    "start": ("开始时间", "start_time", "start"),
    "end": ("结束时间", "end_time", "end"),
    "src_ip": ("源ip", "src_ip", "source_ip"),
    "src_port": ("源端口", "src_port", "source_port"),
    "dst_ip": ("目的ip", "dst_ip", "destination_ip"),
    "dst_port": ("目的端口", "dst_port", "destination_port"),
}


#: Names of fields that give labels away.
HIDDEN = ("label", "truth", "answer", "technique_code", "stage_code", "label_quality", "label_source", "pcap_case", "case_id")
HIDDEN_PREFIXES = ("expected_", "original_")


def capture_of(path: Column) -> Column:
    """Capture id of a log's path: the folder names below ``captures`` joined by __, without zeek and logs."""
    folder = F.regexp_replace(F.regexp_extract(path, "captures/(.*)/[^/]*$", 1), "(^|/)(zeek|logs)$", "")
    return F.replace(folder, F.lit("/"), F.lit("__"))


def read_tsv_log(spark: SparkSession, path: str, columns: tuple[str, ...] = CONN) -> DataFrame:
    """Tab-separated logs with a #fields line each; other # lines are skipped, missing cells are ''.

    Each file's header is a row of a small table that is joined to its lines. Dots in names become underscores. All columns are text.
    """
    lines = spark.read.text(path, wholetext=False).select("value", F.col("_metadata.file_path").alias("file_path"))
    names = lines.where("value like '#fields%'").groupBy("file_path").agg(F.min("value").alias("_h"))
    names = names.select("file_path", F.array_except(F.split(F.replace("_h", F.lit("."), F.lit("_")), "\t"), F.array(F.lit("#fields"))).alias("_names"))
    rows = lines.where("value not like '#%' and value <> ''").join(names, "file_path").withColumn("_cells", F.split("value", "\t"))
    cell = lambda c: F.when(F.array_position("_names", c) > 0, F.coalesce(F.get("_cells", (F.array_position("_names", c) - 1).cast("int")), F.lit("")))
    return rows.select("file_path", capture_of(F.col("file_path")).alias("capture_id"), *(cell(c).alias(c) for c in columns))


def read_json_log(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines of the given schema; blank, malformed and non-object lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_packets(spark: SparkSession, path: str) -> DataFrame:
    """Packet tables with a header, all columns as text."""
    return spark.read.option("header", True).csv(path)


def discover_logs(files: DataFrame) -> DataFrame:
    """Of ``files(path)`` one for each (capture_id, log): a zeek folder before the capture's own, before logs; ssl before tls."""
    rows = files.select("path", capture_of(F.col("path")).alias("capture_id"), F.regexp_extract("path", "([^/]+)\\.log$", 1).alias("name")).where("name <> ''")
    rows = rows.withColumn("log", F.when(F.col("name") == "ssl", "tls").otherwise(F.col("name")))
    place = F.when(F.col("path").rlike("/zeek/[^/]*$"), 0).when(F.col("path").rlike("/logs/[^/]*$"), 2).otherwise(1)
    best = Window.partitionBy("capture_id", "log").orderBy(place, F.when(F.col("name") == "tls", 1).otherwise(0), "path")
    return rows.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("capture_id", "log", "path")


def read_flow_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label tables of either header dialect as (src_ip, src_port, dst_ip, dst_port, proto, label)."""
    raw = spark.read.option("header", True).csv(path)
    named = {c.strip().lower().replace(" ", "_"): c for c in raw.columns}
    pick = lambda *options: F.trim(F.coalesce(*(F.col(f"`{named[o]}`") for o in options if o in named), F.lit(None).cast("string")))
    return raw.select(
        pick("srcaddr", "source_ip").alias("src_ip"), pick("sport", "source_port").alias("src_port"), pick("dstaddr", "destination_ip").alias("dst_ip"),
        pick("dport", "destination_port").alias("dst_port"), F.lower(pick("proto", "protocol")).alias("proto"), pick("label").alias("label"),
    )


def normal_header(name: str) -> str:
    return "".join(ch for ch in name.strip().lower() if ch not in " _()（）-:/")


def header_alias(df: DataFrame) -> DataFrame:
    """Columns of ``df`` under their logical names; the first alias that is there wins, others are left out."""
    have = {normal_header(c): c for c in df.columns}
    hit = {name: next((have[normal_header(a)] for a in aliases if normal_header(a) in have), None) for name, aliases in ALIASES.items()}
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in hit.items() if c))


def redact_log_columns(log: DataFrame) -> DataFrame:
    """A log without secrets: uri and referrer redacted, user names and passwords replaced, FTP arguments of USER and PASS too."""
    out = log
    for c in ("uri", "referrer"):
        if c in log.columns:
            out = out.withColumn(c, redact_sensitive_text(F.col(c), 320))
    for c in ("username", "password"):
        if c in log.columns:
            out = out.withColumn(c, F.when(F.col(c).isNotNull() & (F.col(c) != "") & (F.col(c) != "-"), F.lit("[REDACTED]")).otherwise(F.col(c)))
    if {"command", "arg"} <= set(log.columns):
        out = out.withColumn("arg", F.when(F.upper("command").isin("USER", "PASS"), F.lit("[REDACTED]")).otherwise(F.col("arg")))
    return out


def drop_label_columns(df: DataFrame, hidden: tuple[str, ...] = HIDDEN, prefixes: tuple[str, ...] = HIDDEN_PREFIXES) -> DataFrame:
    """``df`` without columns, struct fields and map entries of these names or prefixes, at every depth of structs, arrays and maps.

    Null values stay null. A struct that has no other field goes with them.
    """
    gone = lambda name: name in hidden or name.startswith(prefixes)

    def holds(kind: DataType) -> bool:
        """Whether anything inside may have to go."""
        if isinstance(kind, StructType):
            return any(gone(f.name) or holds(f.dataType) for f in kind)
        return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and holds(kind.elementType))

    def clean(c: Column, kind: DataType) -> Column | None:
        if not holds(kind):
            return c
        if isinstance(kind, StructType):
            parts = [(f.name, clean(c[f.name], f.dataType)) for f in kind if not gone(f.name)]
            parts = [part.alias(name) for name, part in parts if part is not None]
            return F.when(c.isNotNull(), F.struct(*parts)) if parts else None
        if isinstance(kind, ArrayType):
            return F.transform(c, lambda x: clean(x, kind.elementType)) if _left(kind.elementType) else None
        named = F.map_filter(c, lambda k, _: ~(k.isin(*hidden) | _starts(k, prefixes))) if isinstance(kind.keyType, StringType) else c
        return F.transform_values(named, lambda _, x: clean(x, kind.valueType)) if _left(kind.valueType) else named

    def _left(kind: DataType) -> bool:
        return not isinstance(kind, StructType) or any(not gone(f.name) and _left(f.dataType) for f in kind)

    columns = [(f.name, clean(F.col(f"`{f.name}`"), f.dataType)) for f in df.schema if not gone(f.name)]
    return df.select(*(c.alias(n) for n, c in columns if c is not None))


def _starts(c: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(c, F.lit(p))
    return out


def parse_quality(parses: DataFrame) -> DataFrame:
    """Captures whose parse has warnings or where neither parser worked."""
    return parses.where((F.size("warnings") > 0) | ~(F.col("logs_ok") | F.col("packets_ok")))


#: Bytes of a result table that are decoded at once.
PIECE = 1 << 20


def read_result_table(spark: SparkSession, path: str, encodings: tuple[str, ...] = ("utf-8-sig", "gb18030")) -> DataFrame:
    """CSV result tables under their logical names, as text: file_path and all fields of ALIASES, null where a file lacks one.

    Each file has a header and an encoding of its own; the first of ``encodings`` that reads the whole
    file is taken, the last one with replacements. Executors read the files through Spark and turn
    one file at a time into rows. Of a file only its bytes are held: they are decoded and read piece by piece.
    Cells are trimmed; rows without any cell are left out.
    """
    names, last = list(ALIASES), encodings[-1]

    def reads(raw: memoryview, encoding: str) -> bool:
        decoder = codecs.getincrementaldecoder(encoding)()
        try:
            for at in range(0, len(raw), PIECE):
                decoder.decode(raw[at : at + PIECE])
            decoder.decode(b"", True)
        except UnicodeDecodeError:
            return False
        return True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                raw = content.as_buffer()
                encoding = next((e for e in encodings if reads(memoryview(raw), e)), None)
                whole = io.TextIOWrapper(io.BufferedReader(pa.BufferReader(raw)), encoding or last, errors="strict" if encoding else "replace", newline="")
                lines = csv.reader(whole)
                have = {}
                for i, h in enumerate(next(lines, [])):
                    have.setdefault(normal_header(h), i)
                at = [next((have[normal_header(a)] for a in ALIASES[n] if normal_header(a) in have), None) for n in names]
                rows = ([r[i].strip() if i is not None and i < len(r) else None for i in at] for r in lines if any(c.strip() for c in r))
                while part := list(itertools.islice(rows, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array([file.as_py()] * len(part), pa.string()), *(pa.array([r[i] for r in part], pa.string()) for i in range(len(names)))], ["file_path", *names])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, ", ".join(f"{n} string" for n in ("file_path", *names)))


def _json_arrays(df: DataFrame) -> DataFrame:
    """One text column: the lines of one JSON array for each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            if len(batch):
                lines = [f"{before if i == 0 else ','} {x}" for i, x in enumerate(batch.column(0).to_pylist())]
                before = ","
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"], pa.string())], ["value"])

    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).mapInArrow(run, "value string")


def write_tables(df: DataFrame, folder: str, form: str = "parquet", by: str | None = None) -> None:
    """Write a result, in folders by a column if named, a file for each task.

    ``form``: parquet; json (one object a line); csv (with a header); csv-bom (the same, each file
    beginning with a byte-order mark, so that spreadsheets read it as UTF-8); json-array (each file
    one JSON array; in no folders).
    """
    if form == "json-array":
        _json_arrays(df).write.mode("overwrite").text(folder)
        return
    if form == "csv-bom":  # the mark is part of the header, which every file begins with
        first = next(c for c in df.columns if c != by)
        df, form = df.select(first, *(c for c in df.columns if c != first)).withColumnRenamed(first, f"\ufeff{first}"), "csv"
    writer = df.write.mode("overwrite").option("header", True)
    (writer.partitionBy(by) if by else writer).format(form).save(folder)
