"""The domain model over the driver's star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The technology whose projects are counted, but whose figures are not summed.
LINE = "5-LOW"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"), F.col("o_custkey").alias("developer_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("technology"), F.col("o_orderdate").cast("date").alias("first_seen"),
        F.when(key % 3 != 0, price).alias("mw_nominal"), F.when(key % 5 != 0, price * 1.2).alias("mw_peak"), F.when(key % 4 == 0, price / 100).alias("hectares"),
    )


def project_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge (id, nation): the nations of a project's suppliers. Some projects have none."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_suppkey")
    return lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).select("id", "nation").distinct()


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"), F.col("r_name").alias("province"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated documents of projects, with a role and a verdict."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("line"), F.col("l_shipdate").cast("date").alias("published"), F.col("l_returnflag").alias("role"), F.col("l_linestatus").alias("verdict"), F.col("l_extendedprice").alias("amount"))


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one id: project, role, JSON payload."""
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("project"), F.col("ts").cast("timestamp_ntz").alias("published"), F.col("event_type").alias("role"), "value", "props")


# The same views for DuckDB, put before each oracle.
VIEWS = """WITH projects AS (SELECT o_orderkey AS id, o_custkey AS developer_id, o_orderstatus AS status, o_orderpriority AS technology, CAST(o_orderdate AS DATE) AS first_seen,
 CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS mw_nominal, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * 1.2 END AS mw_peak, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice / 100 END AS hectares FROM orders),
 bridge AS (SELECT DISTINCT l_orderkey AS id, s_nationkey AS nation FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
 places AS (SELECT n_nationkey AS nation, n_name AS name, r_name AS province FROM nation JOIN region ON n_regionkey = r_regionkey),
 docs AS (SELECT l_orderkey AS id, l_partkey AS part, l_suppkey AS supplier, l_linenumber AS line, CAST(l_shipdate AS DATE) AS published, l_returnflag AS role, l_linestatus AS verdict, l_extendedprice AS amount FROM lineitem),
 notices AS (SELECT event_id, user_id AS project, ts AS published, event_type AS role, value, props FROM events),
 measured AS (SELECT *, CASE WHEN technology <> '5-LOW' THEN COALESCE(mw_nominal, mw_peak) END AS mw_best, CASE WHEN technology <> '5-LOW' THEN mw_nominal END AS mw, (technology <> '5-LOW' AND mw_nominal IS NULL AND mw_peak IS NOT NULL) AS peak_fallback FROM projects)
"""
