"""Supply-chain deliveries projected from the provided star-schema tables.

The text is plain SQL that Spark and DuckDB read alike, so both sides of a
comparison start from the same rows. Defects are planted by key arithmetic over
every row of the tables.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from siltstone.config import SOURCES, PipelineConfig, SourceSpec

PROJECTIONS: dict[str, str] = {
    "supplier_master": """
        SELECT 'SUP-' || CAST(s.s_suppkey AS STRING) AS supplier_id,
               CASE WHEN s.s_suppkey % 7 = 3 THEN '  ' || s.s_name || ' '
                    ELSE s.s_name END AS supplier_name,
               n.n_name AS country,
               CASE WHEN s.s_suppkey % 10 = 0 THEN ''
                    ELSE 'c' || CAST(s.s_suppkey AS STRING) || '@x.org' END AS contact_email,
               CASE WHEN s.s_suppkey % 33 = 7 THEN 'not-a-date'
                    ELSE '1994-0' || CAST(1 + s.s_suppkey % 9 AS STRING) || '-15'
               END AS contract_start_date,
               'Tier ' || CAST(1 + s.s_suppkey % 3 AS STRING) AS performance_tier
        FROM {supplier} s JOIN {nation} n ON n.n_nationkey = s.s_nationkey""",
    "medicine_catalogue": """
        SELECT 'MED-' || CAST(p_partkey AS STRING) AS medicine_id,
               p_name AS medicine_name,
               CASE WHEN p_partkey % 60 = 7 THEN '  ' ELSE p_type END AS category,
               p_brand AS unit_of_measure,
               CASE WHEN p_partkey % 50 = 0 THEN '0'
                    WHEN p_partkey % 50 = 1 THEN '5.0'
                    ELSE CAST(p_size * 15 AS STRING) END AS shelf_life_days
        FROM {part}""",
    "purchase_orders": """
        SELECT 'PO-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS po_id,
               CASE WHEN l_orderkey % 20 = 3 THEN 'SUP-ORPHAN'
                    ELSE 'SUP-' || CAST(l_suppkey AS STRING) END AS supplier_id,
               'MED-' || CAST(l_partkey AS STRING) AS medicine_id,
               CASE WHEN l_orderkey % 101 = 6 THEN '1997-13-45'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
               CASE WHEN l_orderkey % 97 = 5 THEN '-1'
                    ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
               CASE WHEN l_orderkey % 89 = 4 THEN 'n/a'
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)
               END AS total_cost,
               CASE l_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'KES'
                    WHEN 2 THEN 'NGN' ELSE 'GHS' END AS currency
        FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey""",
    "shipment_records": """
        SELECT 'SHP-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
                 AS shipment_id,
               'PO-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS po_id,
               'WH-' || CAST(1 + l_partkey % 12 AS STRING) AS warehouse_id,
               CASE WHEN k = 20 THEN 'soon' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING)
               END AS eta,
               CASE WHEN k < 3 THEN ''
                    WHEN k < 18 THEN
                      CAST(CAST(l_shipdate AS DATE) + CAST(1 + k % 10 AS INT) AS STRING)
                    WHEN k = 18 THEN CAST(CAST(l_shipdate AS DATE) - CAST(2 AS INT) AS STRING)
                    WHEN k = 19 THEN 'bad'
                    ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS actual_arrival,
               CASE WHEN k = 21 THEN '   ' ELSE ' Carrier ' || l_returnflag END
                 AS transport_company,
               CASE WHEN k < 3 THEN 'In Transit' ELSE 'Delivered' END AS status
        FROM (SELECT *, (l_orderkey * 7 + l_linenumber) % 100 AS k FROM {lineitem}) li""",
    "warehouse_inventory": """
        SELECT 'WH-' || CAST(1 + l_partkey % 12 AS STRING) AS warehouse_id,
               'MED-' || CAST(l_partkey AS STRING) AS medicine_id,
               CASE WHEN k < 5 THEN '-3' WHEN k = 5 THEN 'x'
                    ELSE CAST(CAST(l_quantity AS INT) * 100 AS STRING) END AS quantity_on_hand,
               CASE WHEN k = 6 THEN '2001-02-30'
                    ELSE CAST(CAST(l_shipdate AS DATE) + CAST(180 AS INT) AS STRING)
               END AS expiry_date,
               'BATCH-' || CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
                 AS batch_number
        FROM (SELECT *, (l_orderkey * 7 + l_linenumber) % 100 AS k FROM {lineitem}) li""",
    "ingest_log": """
        SELECT event_type AS source_file,
               'run-' || CAST(CAST(ts AS DATE) AS STRING) AS run_id,
               ts AS ingested_at
        FROM {events}""",
}

TABLES_USED = {
    "supplier_master": ("supplier", "nation"),
    "medicine_catalogue": ("part",),
    "purchase_orders": ("lineitem", "orders"),
    "shipment_records": ("lineitem",),
    "warehouse_inventory": ("lineitem",),
    "ingest_log": ("events",),
}


def spread(scan: DataFrame, least: int = 1 << 20) -> DataFrame:
    """A scan of fewer tasks than cores dealt to more, each of at least ``least`` bytes: a
    Parquet file of one row group is read by one task however many cores there are. A scan that
    already has a task for each core stays as it is."""
    size = int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = min(scan.sparkSession.sparkContext.defaultParallelism, size // least)
    return scan.repartition(tasks) if tasks > scan.rdd.getNumPartitions() else scan


def delivery(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {t: spread(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in TABLES_USED[name]}
    return spark.sql(PROJECTIONS[name], **tables)


def duckdb_sql(name: str) -> str:
    """The same projection over DuckDB views of the plain table names."""
    return PROJECTIONS[name].format(**{t: t for t in TABLES_USED[name]})


def spec(name: str) -> SourceSpec:
    """Copies of a key arrive in no particular order, so the first by content is
    kept; equal copies are interchangeable."""
    s = SOURCES[name]
    return replace(s, first_by=(*s.columns, "bronze_id"), path=f"tables:{name}")


CONFIG = PipelineConfig(
    calendar_start_year=2003,  # the data's own dates lie outside, on purpose
    calendar_end_year=2004,
    sources=tuple(spec(n) for n in SOURCES),
)
