"""The domain's tables as fixed views of the driver's test tables.

Each view is one SQL text that Spark and DuckDB both understand, so queries
and their oracles start from the same rows.  ``{name}`` stands for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TODAY = "2001-12-31"
LOCI = 25
OVERLAP = 0.6

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]

VIEWS = {
    # One sample for each supplier; every tenth is an input.
    "samples": """
        SELECT s_suppkey AS sample_id, CASE WHEN s_suppkey % 10 = 0 THEN 'input' ELSE 'context' END AS role,
               CASE WHEN s_suppkey % 13 = 3 THEN 'unknown' ELSE n_name END AS country, r_name AS region,
               CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE concat('city ', cast(s_suppkey % 17 AS string)) END AS city,
               CASE s_suppkey % 5 WHEN 0 THEN '  homo   SAPIENS ' WHEN 1 THEN 'not available' WHEN 2 THEN 'BOS taurus' ELSE 'gallus gallus' END AS host,
               CASE WHEN s_suppkey % 2 = 0 THEN 'Species_one' ELSE 'species  ONE' END AS species,
               CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE concat('ST', cast(s_suppkey % 3 AS string)) END AS st,
               CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE 'mlst_a' END AS mlst_scheme,
               CASE WHEN s_suppkey % 17 = 5 THEN 'unknown' ELSE 'scheme' END AS scheme,
               CASE WHEN s_suppkey % 19 = 7 THEN '2' ELSE '1' END AS version,
               CASE s_suppkey % 9 WHEN 0 THEN repeat('a', 64) WHEN 1 THEN repeat('b', 64) ELSE '' END AS database_sha256,
               concat_ws('_', cast(s_suppkey % 2 AS string), cast(s_nationkey % 3 AS string), cast(s_suppkey % 4 AS string),
                         CASE WHEN s_suppkey % 6 = 5 THEN '*' ELSE cast(s_suppkey % 5 AS string) END,
                         CASE WHEN s_suppkey % 6 = 5 THEN '' WHEN s_suppkey % 8 = 0 THEN 'x' ELSE cast(s_suppkey % 3 AS string) END) AS lineage,
               s_acctbal AS balance
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # A call for each sample and locus, where any late shipment exists.
    "calls": """
        SELECT l_suppkey AS sample_id, p_brand AS locus, cast(max(p_size) AS string) AS allele
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_shipdate >= timestamp '2001-06-01 00:00:00' GROUP BY l_suppkey, p_brand""",
    # Every cell called.
    "dense_calls": """
        SELECT l_suppkey AS sample_id, p_brand AS locus, cast(max(p_size) AS string) AS allele
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY l_suppkey, p_brand""",
    # Partial dates as text, with blanks, intervals and errors.
    "dates": """
        SELECT o_orderkey AS id,
               CASE o_orderkey % 11 WHEN 7 THEN '' WHEN 8 THEN 'not collected' WHEN 9 THEN concat(substr(cast(cast(o_orderdate AS date) AS string), 1, 4), '/2001') WHEN 10 THEN '2000-13'
                    ELSE substr(cast(cast(o_orderdate AS date) AS string), 1, CASE o_orderkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 7 ELSE 10 END) END AS raw
        FROM {orders}""",
    # Dated measurements of each sample.
    "points": """
        SELECT l_suppkey AS sample_id, cast(l_shipdate AS date) AS day, cast(max(l_quantity) AS double) AS value
        FROM {lineitem} WHERE l_shipdate >= timestamp '2001-01-01 00:00:00' GROUP BY l_suppkey, cast(l_shipdate AS date)""",
    # A fixed tree: root, regions, nations, suppliers.
    "tree": """
        SELECT 'root' AS node, cast(NULL AS string) AS parent, cast(0 AS double) AS length, cast(NULL AS bigint) AS sample_id
        UNION ALL SELECT concat('r', cast(r_regionkey AS string)), 'root', cast(r_regionkey + 1 AS double), NULL FROM {region}
        UNION ALL SELECT concat('n', cast(n_nationkey AS string)), concat('r', cast(n_regionkey AS string)), cast(n_nationkey % 4 - 1 AS double), NULL FROM {nation}
        UNION ALL SELECT concat('s', cast(s_suppkey AS string)), concat('n', cast(s_nationkey AS string)), cast(s_suppkey % 7 AS double) + 0.5, s_suppkey FROM {supplier}""",
    # Short sequences of equal length.
    "sequences": """
        SELECT s_suppkey AS sample_id, translate(concat(md5(cast(s_suppkey % 40 AS string)), md5(cast(s_suppkey % 7 AS string))), '0123456789abcdef', 'ACGTACGTACGTACGN') AS seq FROM {supplier}""",
    # Half-open intervals on records.
    "intervals": """
        SELECT l_suppkey % 5 AS record, l_suppkey AS node, min(l_partkey) AS start_at, min(l_partkey) + cast(max(l_quantity) AS bigint) AS end_at FROM {lineitem} GROUP BY l_suppkey, l_orderkey % 3""",
    # Identity fields of records that may name the same thing.
    "identities": """
        SELECT c_custkey AS id, concat('SAMN', cast(c_custkey % 400 AS string)) AS sample_accession, concat('SRR', cast(c_custkey % 37 * 1000 + c_nationkey AS string)) AS run_accession,
               CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('c', cast(c_nationkey % 9 AS string)) END AS country, c_acctbal AS quality FROM {customer}""",
    # Selections of several runs.
    "runs": """
        SELECT k.run AS run, s_suppkey AS sample_id, CASE WHEN s_suppkey % 10 = 0 THEN 'input' ELSE 'context' END AS role, cast(s_suppkey % 9 AS double) + k.run AS estimate
        FROM {supplier} CROSS JOIN (SELECT 1 AS run UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) k WHERE s_suppkey % 10 = 0 OR (s_suppkey + k.run) % 4 = 0""",
    # p-values of windows, some missing.
    "windows": """
        SELECT s_suppkey AS id, s_suppkey % 4 AS record, cast(s_suppkey * 50 AS bigint) AS start_at, cast(s_suppkey * 50 + 120 AS bigint) AS end_at,
               CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE cast((s_suppkey * 37) % 1009 AS double) / 1009 END AS p FROM {supplier}""",
    # Typing results: each event is one hit of a locus.
    "hits": "SELECT user_id AS sample_id, event_type AS locus, cast(json_k AS string) AS allele FROM (SELECT user_id, event_type, {props_k} AS json_k FROM {events}) e",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the Parquet files below ``sf_dir``."""
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES} | {"props_k": "get_json_object(props, '$.k')"}
    return spark.sql(VIEWS[name].format(**tables))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence of every supplier."""
    return view(spark, sf_dir, "sequences")


def with_views(*names: str) -> str:
    """A WITH clause for DuckDB with the views named."""
    tables = {t: t for t in TABLES} | {"props_k": "json_extract_string(props, '$.k')"}
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].format(**tables)})" for n in names) + " "


def sql(text: str) -> str:
    """``@name`` at the start lists the views that a DuckDB text uses."""
    found = list(dict.fromkeys(re.findall(r"\b(?:FROM|JOIN|,)\s+@(\w+)", text)))
    body = re.sub(r"@(\w+)", r"\1", text).strip()
    if not found:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return with_views(*found).replace("WITH ", "WITH RECURSIVE ", 1) + ", " + body[len("WITH RECURSIVE") :]
    if body.upper().startswith("WITH"):
        return with_views(*found) + ", " + body[4:]
    return with_views(*found) + body
