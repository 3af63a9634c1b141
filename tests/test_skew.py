"""Hot keys: a date, a block or a shipment id holding a third of all rows."""

import glob

from pyspark.sql import functions as F

from parcelwise.operators import clean as C
from parcelwise.operators import dedup as D
from parcelwise.operators import kpis as A
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.sinks import writers as W
from parcelwise.sources import readers as SR


def _skewed(spark, sf_small, column, value, tasks=None):
    raw = Rg.raw_shipments(spark, sf_small)
    raw = raw.repartition(tasks) if tasks else raw
    hot = F.abs(F.hash("shipment_id", "customer_id", "route")) % 3 == 0
    return raw.withColumn(column, F.when(hot, F.lit(value)).otherwise(F.col(column)))


def test_hot_date_is_split_across_files(spark, sf_small):
    df = _skewed(spark, sf_small, "shipment_date", F.lit("1995-06-01").cast("date"), tasks=16)  # a split needs several map outputs
    hot_rows = df.filter("shipment_date = DATE'1995-06-01'").count()
    assert hot_rows > df.count() / 4
    path = shared_path(spark, "t_hot_date")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        W.land_partitioned(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = glob.glob(path.replace("file:", "") + "/shipment_date=1995-06-01/*.parquet")
    assert len(files) > 1                      # the hot date was written by several tasks
    assert SR.read_landed(spark, path).filter("shipment_date = DATE'1995-06-01'").count() == hot_rows


def test_hot_block_kpis_are_exact(spark, sf_small):
    df = _skewed(spark, sf_small, "warehouse_block", "A")
    cleaned = C.clean(df)
    got = {r.warehouse_block: r.total_shipments for r in A.warehouse_kpis(cleaned).collect()}
    want = {r.warehouse_block: r.n for r in cleaned.groupBy("warehouse_block").agg(F.count("shipment_id").alias("n")).collect()}
    assert got == want and got["A"] > sum(got.values()) / 3


def test_hot_shipment_id_dedup(spark, sf_small):
    df = _skewed(spark, sf_small, "shipment_id", "HOT")
    out = D.latest_per_key(df)
    assert out.filter("shipment_id = 'HOT'").count() == 1
    assert out.count() == df.select("shipment_id").distinct().count()


def test_hot_join_key_is_split_and_exact(spark, sf_small):
    """A third of all line items reference one part: on the sort-merge path AQE
    splits that join partition, and the source rows still equal the oracle's."""
    import io
    from contextlib import redirect_stdout

    from checks.compare import _rows, duck
    from checks.oracle import INGEST_RAW

    base = shared_path(spark, "t_hot_join")
    tables = ["region", "nation", "supplier", "customer", "orders", "part", "lineitem"]
    for t in tables:
        df = spark.read.parquet(f"{sf_small}/{t}.parquet")
        if t == "lineitem":
            df = df.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint"))
                               .otherwise(F.col("l_partkey")))
            df = df.repartition(8)
        df.write.parquet(f"{base}/{t}.parquet")

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # on so few rows the stages above would become one task
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = Rg.q_ingest_raw(spark, base)
        rows = [tuple(r) for r in df.collect()]
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan

    con = duck(sf_small)
    for t in tables:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{base.replace('file:', '')}/{t}.parquet/*.parquet')")
    res = con.execute(INGEST_RAW)
    assert _rows(df.columns, rows) == _rows([d[0] for d in res.description], res.fetchall())
