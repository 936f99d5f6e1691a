"""Queries over delimited files, tables, SQL tasks and the matrix join."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.operators import index, joins, lookup, sinks, sqltask
from locusframe.plans import inputs
from locusframe.plans.registry import query
from locusframe.session import shared_path
from locusframe.sources import text

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "orders").select(*ORDER_COLUMNS)


def _new_table(name: str) -> str:
    return f"locusframe.{name}_{uuid.uuid4().hex}"


@query(
    "csv_scan",
    """SELECT o_orderkey::VARCHAR AS _c0, o_custkey::VARCHAR AS _c1, o_orderstatus AS _c2,
       o_orderpriority AS _c3 FROM orders""",
)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "csv-scan")
    sinks.write_csv(_orders(spark, sf), path, header=False)
    return text.read_csv(spark, path, header=False)


@query("csv_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "csv")
    orders = _orders(spark, sf)
    sinks.write_csv(orders, path, delimiter=";")
    return text.read_csv(spark, path, header=True, sep=";", schema=orders.schema)


@query(
    "typed_tsv_scan",
    """SELECT 'chr' || (o_custkey % 22 + 1) AS "CHROM", ((o_orderkey * 7919) % 20000000 + 1)::INTEGER AS "POS",
       'rs' || o_orderkey AS "ID", o_totalprice AS "SCORE" FROM orders""",
)
def typed_tsv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "tsv")
    rows = inputs.table(spark, sf, "orders").selectExpr(
        "concat('chr', o_custkey % 22 + 1) AS a",
        "(o_orderkey * 7919) % 20000000 + 1 AS b",
        "concat('rs', o_orderkey) AS c",
        "o_totalprice AS d",
    )
    sinks.write_csv(rows, path, delimiter="\t", header=False)
    spec = {"1:CHROM": "String", "2:POS": 0, "3:ID": "String", "4:SCORE": 0.0}
    return text.read_typed_tsv(spark, path, spec)


@query(
    "union_tables",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def union_tables(spark: SparkSession, sf: str) -> DataFrame:
    customer = inputs.table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance"
    )
    supplier = inputs.table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name")
    return text.union_tables([customer, customer, supplier])


@query(
    "matrix_join",
    """WITH features AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS i FROM part),
barcodes AS (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier)
SELECT l_partkey + 1 AS gene, l_suppkey + 1 AS cell, l_quantity AS value, p_name AS gene_name,
       p_brand AS gene_type, s_name AS barcode
FROM lineitem JOIN features f ON l_partkey + 1 = f.i JOIN barcodes b ON l_suppkey + 1 = b.i
ORDER BY cell, gene DESC""",
)
def matrix_join(spark: SparkSession, sf: str) -> DataFrame:
    matrix = inputs.table(spark, sf, "lineitem").selectExpr(
        "l_partkey + 1 AS gene", "l_suppkey + 1 AS cell", "l_quantity AS value"
    )
    parts = inputs.table(spark, sf, "part").selectExpr("p_partkey", "p_name AS gene_name", "p_brand AS gene_type")
    suppliers = inputs.table(spark, sf, "supplier").selectExpr("s_suppkey", "s_name AS barcode")
    features = index.row_index(parts, 1, ["p_partkey"], "feature_index").drop("p_partkey")
    barcodes = index.row_index(suppliers, 1, ["s_suppkey"], "barcode_index").drop("s_suppkey")
    return joins.matrix_join(matrix, features, barcodes)


@query(
    "heavy_key_join",
    """SELECT l_orderkey, l_linenumber, l_quantity, p_name, p_brand
FROM lineitem JOIN part ON p_partkey = CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END""",
)
def heavy_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """A shuffled lookup in which one key holds a third of all rows."""
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_partkey")).alias("key")
    rows = inputs.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", key)
    parts = inputs.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return lookup.lookup_join(rows, parts, on=[("key", "p_partkey")], max_broadcast_rows=0).drop("key")


@query(
    "select_limit",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey DESC LIMIT 100",
)
def select_limit(spark: SparkSession, sf: str) -> DataFrame:
    sql = "SELECT o_orderkey, o_custkey, o_orderstatus FROM limit_source ORDER BY o_orderkey DESC LIMIT 100"
    return sqltask.sql_task(spark, sql, {"limit_source": _orders(spark, sf)})


@query(
    "insert_select",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
UNION ALL (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 10)""",
)
def insert_select(spark: SparkSession, sf: str) -> DataFrame:
    name = _new_table("insert_target")
    orders = _orders(spark, sf)
    sqltask.localize_table(orders, name, shared_path(spark, "insert-target"))
    sqltask.sql_task(
        spark,
        "INSERT INTO IDENTIFIER(:target) SELECT * FROM insert_source ORDER BY o_orderkey LIMIT 10",
        {"insert_source": orders},
        {"target": name},
    )
    return spark.table(name)


@query(
    "sql_task",
    """SELECT o_orderstatus AS status, count(*) AS n_orders, min(o_orderkey) AS first_key
FROM orders WHERE o_custkey >= 10 GROUP BY o_orderstatus""",
)
def sql_task(spark: SparkSession, sf: str) -> DataFrame:
    """Script with a templated column and a bound value, its result kept as a partitioned table."""
    sql = """SELECT IDENTIFIER(:col) AS status, count(*) AS n_orders, min(o_orderkey) AS first_key
             FROM task_source WHERE o_custkey >= :low GROUP BY IDENTIFIER(:col)"""
    return sqltask.sql_task(
        spark,
        sql,
        {"task_source": _orders(spark, sf)},
        {"col": "o_orderstatus", "low": 10},
        output=_new_table("task_output"),
        partition_by=["status"],
        path=shared_path(spark, "task-output"),
    )


@query("table_localize", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def table_localize(spark: SparkSession, sf: str) -> DataFrame:
    name = _new_table("localized")
    sqltask.localize_table(_orders(spark, sf), name, shared_path(spark, "localized"))
    return spark.table(name)


@query(
    "partitioned_table",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
)
def partitioned_table(spark: SparkSession, sf: str) -> DataFrame:
    name = _new_table("partitioned")
    spark.sql("CREATE SCHEMA IF NOT EXISTS locusframe")
    sinks.write_partitioned_table(
        _orders(spark, sf), name, ["o_orderstatus", "o_orderpriority"], shared_path(spark, "partitioned")
    )
    return spark.table(name)
