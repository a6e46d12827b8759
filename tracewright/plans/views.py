"""Session, page and record views of the driver tables, as SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: What differs between the engines.
SPARK = {"epoch": "unix_micros(CAST(ts AS TIMESTAMP)) / 1e6", "lambda": "{0} -> "}
DUCK = {"epoch": "epoch_us(ts) / 1e6"}

FLOW = """
SELECT event_id AS session_id, CONCAT('cap', CAST(user_id % 8 AS STRING)) AS capture_id, CONCAT('10.0.0.', CAST(user_id % 30 AS STRING)) AS src_ip,
       CAST(40000 + event_id % 20000 AS INT) AS src_port,
       CASE event_id % 3 WHEN 0 THEN '10.1.0.7' WHEN 1 THEN '93.184.216.34' ELSE '151.101.1.69' END AS dst_ip,
       CASE WHEN k < 60 THEN CASE k % 4 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 22 ELSE 5678 END ELSE 1000 + k END AS dst_port,
       CASE event_type WHEN 'view' THEN 'udp' ELSE 'tcp' END AS proto,
       CASE event_type WHEN 'error' THEN 'REJ' WHEN 'signup' THEN 'S0' ELSE 'SF' END AS conn_state,
       CASE WHEN event_id % 97 = 5 THEN NULL ELSE start_time END AS start_time, value % 5 AS duration,
       CAST(FLOOR(value * 10) AS BIGINT) AS orig_bytes, CAST(FLOOR(value * 40) AS BIGINT) AS resp_bytes, k, event_type, user_id
FROM (SELECT event_id, user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k, {epoch} AS start_time FROM events)
"""
WIDE = """
SELECT CONCAT('cap', CAST(l_orderkey % 16 AS STRING)) AS capture_id, CONCAT('s', CAST(l_suppkey AS STRING)) AS src_ip, CONCAT('d', CAST(l_partkey % 40 AS STRING)) AS dst_ip,
       CAST(l_partkey % 500 AS INT) AS dst_port, CASE l_returnflag WHEN 'R' THEN 'REJ' WHEN 'A' THEN 'S0' ELSE 'SF' END AS conn_state
FROM lineitem
"""
PAGES = """
SELECT page_id, CONCAT('cap', CAST(page_id % 5 AS STRING)) AS capture_id, CONCAT('10.0.0.', CAST(page_id % 3 AS STRING)) AS src_ip, CONCAT('d', CAST(page_id % 4 AS STRING)) AS dst_ip,
       url, html, CAST(CASE WHEN page_id % 5 < 3 THEN 404 ELSE 200 END AS INT) AS status, CAST(CASE page_id % 2 WHEN 0 THEN 80 ELSE 443 END AS INT) AS dst_port, page_id % 7 = 0 AS login,
       CASE WHEN page_id % 7 = 0 THEN 'http' ELSE 'unknown' END AS auth_protocol
FROM pages
"""
CHUNKS = """
SELECT doc_id AS chunk_id, doc_id, substr(text, 1, 60) AS title, CASE doc_id % 11 WHEN 0 THEN 'false_positive_rules' WHEN 1 THEN 'protocols' ELSE source END AS category, lang AS keywords, text,
       split(CASE doc_id % 7 WHEN 0 THEN 'port_scan' WHEN 1 THEN 'c2' WHEN 2 THEN 'exploit' ELSE '' END, ',') AS attack_type, split(CASE WHEN doc_id % 5 = 0 THEN 'reconnaissance' ELSE '' END, ',') AS attack_stage
FROM documents
"""
RECORDS = """
SELECT event_id AS record_id, CONCAT('cap', CAST(user_id % 8 AS STRING)) AS capture_id,
       CASE k % 8 WHEN 0 THEN 'TA43_01' WHEN 1 THEN 'TA43_02' WHEN 2 THEN 'TA01_01' WHEN 3 THEN 'TA01_02' WHEN 4 THEN 'TA03_01' WHEN 5 THEN 'TA11_01' WHEN 6 THEN 'TA11_02' ELSE 'TN01_01' END AS truth,
       CASE (k + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END) % 8 WHEN 0 THEN 'TA43_01' WHEN 1 THEN 'TA43_02' WHEN 2 THEN 'TA01_01' WHEN 3 THEN 'TA01_02' WHEN 4 THEN 'TA03_01' WHEN 5 THEN 'TA11_01' WHEN 6 THEN 'TA11_02' ELSE 'TN01_01' END AS plain_guess,
       CASE (k + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) % 8 WHEN 0 THEN 'TA43_01' WHEN 1 THEN 'TA43_02' WHEN 2 THEN 'TA01_01' WHEN 3 THEN 'TA01_02' WHEN 4 THEN 'TA03_01' WHEN 5 THEN 'TA11_01' WHEN 6 THEN 'TA11_02' ELSE 'TN01_01' END AS context_guess,
       CAST(k % 11 AS DOUBLE) AS score, CAST(k % 5 AS DOUBLE) AS margin, CAST(event_id % 4 AS INT) AS flags, value, k, event_type,
       CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS level
FROM (SELECT event_id, user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM events)
"""


def view(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """A view over the named tables of ``sf_dir``."""
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    body = sql.format(epoch=SPARK["epoch"])
    for n in names:
        body = body.replace(f"FROM {n}", f"FROM {{{n}}}")
    return spark.sql(body, **tables)


def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, FLOW, "events")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, WIDE, "lineitem")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, PAGES, "pages")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, CHUNKS, "documents")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, RECORDS, "events")


def duck(body: str, **views: str) -> str:
    """DuckDB SQL with the views it reads in front."""
    defined = {"flow": FLOW, "wide": WIDE, "page": PAGES, "chunk": CHUNKS, "record": RECORDS} | views
    used = [f"{n} AS ({sql.format(**DUCK)})" for n, sql in defined.items() if n in body]
    if any(n in views and sql.find("FROM flow") >= 0 for n, sql in defined.items() if n in body) and not any(u.startswith("flow AS") for u in used):
        used.insert(0, f"flow AS ({defined['flow'].format(**DUCK)})")
    joined = ", ".join(used)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {joined}, {body[14:]}"
    if body.upper().startswith("WITH"):
        return f"WITH {joined}, {body[4:]}"
    return f"WITH {joined} {body}" if used else body


def visible(column: str) -> str:
    """DuckDB SQL of a text after one layer of URL decoding, without what can't be seen."""
    plain = f"regexp_replace(url_decode(replace({column}, '+', ' ')), '[^\\x20-\\x7e\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g')"
    return f"trim(regexp_replace({plain}, ' +', ' ', 'g'))"
