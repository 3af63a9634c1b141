"""Shipment source text derived from the TPC-H-style test tables.

The reference reads a shipments CSV that it does not ship. This module builds
that file's content (16 text columns, as a CSV reader with no type inference
would return them) from lineitem and its dimensions, so every query's work
grows with the given tables. Missing keys, the ``n/a`` and ``not-a-date``
values and repeated shipment ids come from integer rules on the keys.

Join plan (scale notes): plain equi-joins; Catalyst broadcasts a side whose
file statistics are under the session's threshold and adaptive execution one
whose measured shuffle size is, everything else is a sort-merge join with
skew handling. Lineitem takes part in exactly three fact-sized joins
(orderkey, suppkey, partkey); the rows crossing them carry integer region keys
only, the part's strings are attached by the last of them, and region names
come from the 5-row region table at the end. Only the referenced columns are
read from each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.session import table_path

BLOCKS = "ABCDE"


# The columns read from each test table, declared so no read infers a schema
# from file footers.
TABLE_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_type string, p_size int",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"),
}


def _read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return spark.read.schema(TABLE_COLUMNS[table]).parquet(table_path(sf_dir, table)).select(*cols)


def _text(c: Column) -> Column:
    return c.cast("string")


def shipments_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw shipments CSV content: 16 string columns, one row per lineitem."""
    region = _read(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = _read(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    supplier_t = _read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    customer_t = _read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    orders_t = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    part = _read(spark, sf_dir, "part", "p_partkey", "p_type", "p_size")

    supplier = (supplier_t.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .select("s_suppkey", F.col("n_regionkey").alias("s_regionkey")))
    customer = (customer_t.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .select("c_custkey", F.col("n_regionkey").alias("c_regionkey")))
    orders = (orders_t.join(customer, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "o_custkey", "c_regionkey"))
    s_region = region.select(F.col("r_regionkey").alias("sr_key"), F.col("r_name").alias("s_region"))
    c_region = region.select(F.col("r_regionkey").alias("cr_key"), F.col("r_name").alias("c_region"))
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
               "l_linenumber", "l_extendedprice", "l_discount", "l_shipdate")
    joined = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(part, F.col("l_partkey") == F.col("p_partkey"))
              .join(s_region, F.col("s_regionkey") == F.col("sr_key"))
              .join(c_region, F.col("c_regionkey") == F.col("cr_key")))

    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line = F.col("l_linenumber").cast("bigint")
    scheduled = 2 + F.col("p_size") % 7
    late = ((ok * 31 + pk * 17 + line * 7) % 100
            < 8 + 2 * (F.col("s_regionkey") * 5 + F.col("c_regionkey")))

    return joined.select(
        F.when(pk % 97 == 0, F.lit(None)).otherwise(
            F.concat(_text(ok), F.lit("-"), _text(line))).alias("shipment_id"),
        _text(F.col("o_custkey")).alias("customer_id"),
        F.when(pk % 101 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("product_category"),
        F.when(ok % 83 == 0, F.lit(None)).otherwise(
            F.substring(F.lit(BLOCKS), (sk % 5 + 1).cast("int"), F.lit(1))).alias("warehouse_block"),
        F.when(line % 3 == 0, "Ship").when(line % 3 == 1, "Flight").otherwise("Road").alias("mode_of_shipment"),
        F.when(ok % 89 == 0, F.lit(None)).otherwise(
            F.concat(F.col("s_region"), F.lit("->"), F.col("c_region"))).alias("route"),
        F.when(pk % 71 == 0, F.lit("n/a")).otherwise(_text(line)).alias("customer_care_calls"),
        F.when(ok % 53 == 0, F.lit(None)).otherwise(_text(1 + (pk + ok) % 5)).alias("customer_rating"),
        _text(F.floor(F.col("l_extendedprice") * 5).cast("bigint").cast("double") / 100).alias("cost_of_product"),
        _text(F.col("o_custkey") % 10).alias("prior_purchases"),
        _text(F.round(F.col("l_discount") * 100).cast("bigint")).alias("discount_offered"),
        _text(500 + (pk * 37) % 6000).alias("weight_in_gms"),
        _text(scheduled).alias("scheduled_days"),
        F.when(pk % 67 == 0, F.lit(None))
         .when(late, _text(scheduled + 1 + pk % 4))
         .otherwise(_text(scheduled - pk % 3)).alias("actual_days"),
        F.when(late, F.lit("0")).otherwise(F.lit("1")).alias("on_time_delivery"),
        F.when(ok % 211 == 0, F.lit("not-a-date")).otherwise(
            _text(F.col("l_shipdate").cast("date"))).alias("shipment_date"),
    )
