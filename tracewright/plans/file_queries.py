"""Queries of the readers and writers: rows of the driver tables go to files in the shared folder and come back through a reader."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import retrieval as K
from ..sources import logs as L
from ..sources.checkpoints import shared_folder
from .evidence_queries import _TOK
from .views import chunks, duck, flow, records


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/files-{uuid.uuid4().hex}"


def read_tsv_log(spark, d):
    """One log for each capture, with a header of its own: captures of even number lack the column service."""
    rows = flow(spark, d)
    odd = F.substring("capture_id", 4, 1).cast("int") % 2 == 1
    cells = F.concat_ws("\t", F.col("session_id").cast("string"), F.format_string("C%d", "session_id"), "src_ip", F.when(odd, "http"), "conn_state")
    header = F.when(odd, "#fields\tts\tuid\tid.orig_h\tservice\tconn_state").otherwise("#fields\tts\tuid\tid.orig_h\tconn_state")
    lines = rows.select("capture_id", F.lit(1).alias("at"), cells.alias("value")).unionByName(rows.select("capture_id", F.lit(0).alias("at"), header.alias("value")).distinct())
    folder = f"{_folder(spark)}/captures"
    lines.repartition("capture_id").sortWithinPartitions("capture_id", "at").select("capture_id", "value").write.partitionBy("capture_id").text(folder)
    out = L.read_tsv_log(spark, folder, ("ts", "uid", "id_orig_h", "service", "history"))
    return out.select(F.regexp_replace("capture_id", "^capture_id=", "").alias("capture_id"), "ts", "uid", "id_orig_h", "service", "history")


def read_json_log(spark, d):
    folder = _folder(spark)
    L.write_tables(flow(spark, d).select("session_id", "src_ip", "start_time"), folder, "json")
    return L.read_json_log(spark, folder, "session_id long, src_ip string, start_time double").select("session_id", "src_ip", F.round("start_time", 3).alias("start_time"))


def read_packets(spark, d):
    folder = _folder(spark)
    L.write_tables(flow(spark, d).select(F.col("session_id").alias("frame.number"), F.col("src_ip").alias("ip.src"), F.when(F.col("k") % 2 == 0, F.col("k")).alias("tcp.stream")), folder, "csv")
    rows = L.read_packets(spark, folder)
    return rows.select(F.col("`frame.number`").alias("number"), F.col("`ip.src`").alias("src_ip"), F.col("`tcp.stream`").alias("stream"))


def read_flow_labels(spark, d):
    folder = _folder(spark)
    rows = flow(spark, d)
    named = lambda r, names: r.select(F.col("src_ip").alias(names[0]), F.col("src_port").alias(names[1]), F.concat(F.lit(" "), F.col("dst_ip"), F.lit(" ")).alias(names[2]), F.col("dst_port").alias(names[3]), F.upper("proto").alias(names[4]), F.col("event_type").alias(names[5]))
    L.write_tables(named(rows, ("SrcAddr", "Sport", "DstAddr", "Dport", "Proto", "Label")), folder, "csv")
    return L.read_flow_labels(spark, folder)


def read_result_table(spark, d):
    """Files that begin with a byte-order mark, under headers of another language."""
    folder = _folder(spark)
    rows = records(spark, d).select(F.concat("capture_id", F.lit(".pcap")).alias("PCAP 文件名"), F.col("record_id").alias("编号"), F.col("truth").alias("技术编号"))
    L.write_tables(rows, folder, "csv-bom")
    return L.read_result_table(spark, f"{folder}/*.csv").select("pcap", "number", "technique", "stage")


def write_json_arrays(spark, d):
    """Every file is one array; read whole, they hold all rows."""
    folder = _folder(spark)
    L.write_tables(records(spark, d).select("record_id", F.when(F.col("k") % 3 > 0, F.col("truth")).alias("truth")), folder, "json-array")
    files = spark.read.text(folder, wholetext=True)
    return files.select(F.explode(F.from_json("value", "array<struct<record_id:long,truth:string>>")).alias("x")).select("x.*")


def keyword_totals(spark, d):
    return K.index_totals(K.keyword_index(chunks(spark, d)))


QUERIES = {f.__name__: f for f in (read_tsv_log, read_json_log, read_packets, read_flow_labels, read_result_table, write_json_arrays, keyword_totals)}

ORACLES = {
    "read_tsv_log": duck("SELECT capture_id, session_id::VARCHAR AS ts, 'C' || session_id AS uid, src_ip AS id_orig_h, CASE WHEN substr(capture_id, 4, 1)::INT % 2 = 1 THEN 'http' END AS service, NULL::VARCHAR AS history FROM flow"),
    "read_json_log": duck("SELECT session_id, src_ip, round(start_time, 3) AS start_time FROM flow"),
    "read_packets": duck("SELECT session_id::VARCHAR AS number, src_ip, CASE WHEN k % 2 = 0 THEN k::VARCHAR END AS stream FROM flow"),
    "read_flow_labels": duck("SELECT src_ip, src_port::VARCHAR AS src_port, dst_ip, dst_port::VARCHAR AS dst_port, proto, event_type AS label FROM flow"),
    "read_result_table": duck("SELECT capture_id || '.pcap' AS pcap, record_id::VARCHAR AS number, truth AS technique, NULL::VARCHAR AS stage FROM record"),
    "write_json_arrays": duck("SELECT record_id, CASE WHEN k % 3 > 0 THEN truth END AS truth FROM record"),
    "keyword_totals": duck(f"""WITH t AS (SELECT chunk_id, unnest({_TOK.format("concat_ws(chr(32), doc_id, title, category, keywords, array_to_string(attack_type, ' '), array_to_string(attack_stage, ' '), text)")}) AS token FROM chunk)
        SELECT count(DISTINCT token) AS tokens, count(DISTINCT chunk_id) AS chunks, count(DISTINCT (token, chunk_id)) AS postings, count(*) AS occurrences FROM t"""),
}
