"""Literal edge rows: each semantic trap of the reference, on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S
from parcelwise.functions import delay_days, high_value_flag, high_value_flag_from_bool, risk_band, strict_delay_days
from parcelwise.operators import clean as C
from parcelwise.operators import ingest as G
from parcelwise.operators import kpis as A
from parcelwise.operators import reports as R
from parcelwise.streaming import messages as M


def _text_rows(spark, rows):
    """Rows of source text: dicts with any subset of the source columns."""
    full = [tuple(r.get(c) for c in S.SOURCE_COLUMNS) for r in rows]
    return spark.createDataFrame(full, S.SOURCE_TEXT_SCHEMA)


def test_null_delay_pyspark_zero_sql_null(spark):
    df = spark.createDataFrame([(None, 3), (2, 5), (7, 3)], "actual_days bigint, scheduled_days bigint")
    got = df.select(delay_days().alias("d"), strict_delay_days().alias("s")).collect()
    assert [(r.d, r.s) for r in got] == [(0, None), (0, 0), (4, 4)]


def test_high_value_threshold_strict(spark):
    df = spark.createDataFrame([(2500.0,), (2500.01,), (None,)], "cost_of_product double")
    got = df.select(high_value_flag().alias("a"), high_value_flag_from_bool().alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(0, 0), (1, 1), (0, 0)]


def test_risk_band_edges(spark):
    df = spark.createDataFrame([(20.0,), (20.01,), (40.0,), (40.01,), (None,)], "r double")
    assert [r.b for r in df.select(risk_band("r").alias("b")).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "LOW"]


def test_half_up_rounding_of_weight(spark):
    df = spark.createDataFrame([(4145,), (1005,)], "weight_in_gms int")
    got = [r.w for r in df.select(F.round(F.col("weight_in_gms") / 1000, 2).alias("w")).collect()]
    assert got == [4.15, 1.01]


def test_lenient_casts_never_fail(spark):
    text = _text_rows(spark, [
        {"shipment_id": "s1", "customer_care_calls": "n/a", "shipment_date": "not-a-date"},
        {"shipment_id": "s2", "customer_care_calls": "NA", "shipment_date": "2024-02-30"},
        {"shipment_id": "s3", "customer_care_calls": "4", "shipment_date": "2024-02-29", "cost_of_product": "12.5"},
        {"shipment_id": "NULL"},
        {"shipment_id": ""},
    ])
    raw = G.ingest(text, run_ts="2024-01-01 00:00:00").orderBy("shipment_id").collect()
    assert [r.shipment_id for r in raw] == ["s1", "s2", "s3"]
    assert [r.customer_care_calls for r in raw] == [None, None, 4]
    assert [r.shipment_date for r in raw] == [None, None, dt.date(2024, 2, 29)]
    assert raw[2].cost_of_product == 12.5
    assert raw[0].ingested_at == dt.datetime(2024, 1, 1)


def test_ingest_counts_count_tokens_as_missing(spark):
    text = _text_rows(spark, [{"shipment_id": "a"}, {"shipment_id": None}, {"shipment_id": "n/a"}])
    row = G.ingest_counts(text).collect()[0]
    assert (row.source_rows, row.valid_rows, row.rejected_rows) == (3, 1, 2)


def _raw(spark, rows):
    base = {c: None for c in S.SOURCE_COLUMNS}
    text = _text_rows(spark, [{**base, **r} for r in rows])
    return G.ingest(text, run_ts="2024-01-01 00:00:00")


def test_rank_on_rounded_vs_raw(spark):
    # Averages 66.666666 and 66.666611: rounded they tie (rank 1, 1), raw they do not (1, 2).
    from pyspark.sql import Window

    agg = spark.createDataFrame([("X", 0.66666666), ("Y", 0.66666611)], "warehouse_block string, on_time double")
    rounded = agg.select("warehouse_block", F.round(F.col("on_time") * 100, 2).alias("p"))
    r1 = rounded.select("warehouse_block", F.rank().over(Window.orderBy(F.desc("p"))).alias("r")).collect()
    r2 = agg.select("warehouse_block", F.rank().over(Window.orderBy(F.desc("on_time"))).alias("r")).collect()
    assert sorted((r.warehouse_block, r.r) for r in r1) == [("X", 1), ("Y", 1)]
    assert sorted((r.warehouse_block, r.r) for r in r2) == [("X", 1), ("Y", 2)]


def test_kpi_and_report_rank_keys(spark):
    # X = 2/3 and Y = 4/6 on time: equal raw and rounded shares, so both rank forms tie.
    rows = [{"shipment_id": f"x{i}", "warehouse_block": "X", "on_time_delivery": "1" if i < 2 else "0"} for i in range(3)]
    rows += [{"shipment_id": f"y{i}", "warehouse_block": "Y", "on_time_delivery": "1" if i < 4 else "0"} for i in range(6)]
    raw = _raw(spark, rows)
    wk = {r.warehouse_block: r.warehouse_rank for r in A.warehouse_kpis(C.clean(raw)).collect()}
    rep = {r.warehouse_block: r.warehouse_rank for r in R.on_time_by_warehouse(raw).collect()}
    assert wk == {"X": 1, "Y": 1} and rep == {"X": 1, "Y": 1}
    assert dict(A.warehouse_kpis(C.clean(raw)).dtypes)["warehouse_rank"] == "bigint"


def test_high_risk_having_on_rounded_rate(spark):
    # 30.004% rounds to 30.00 (dropped); 30.006% rounds to 30.01 (kept).
    agg = spark.createDataFrame([("a", 30.004), ("b", 30.006)], "route string, rate double")
    kept = (agg.withColumn("delay_rate_pct", F.round("rate", 2))
            .filter(F.col("delay_rate_pct") > S.HIGH_RISK_ROUTE_PCT).collect())
    assert [r.route for r in kept] == ["b"]


def test_null_keys_dropped_by_clean_kept_by_reports(spark):
    raw = _raw(spark, [
        {"shipment_id": "1", "warehouse_block": "A", "on_time_delivery": "1"},
        {"shipment_id": "2", "warehouse_block": None, "on_time_delivery": "0"},
    ])
    assert A.warehouse_kpis(C.clean(raw)).count() == 1
    assert R.on_time_by_warehouse(raw).count() == 2
    assert A.warehouse_kpis_strict(G.conform(_text_rows(spark, [{"shipment_id": "1", "warehouse_block": None}]))).count() == 0


def test_rolling_average_is_rows_not_calendar(spark):
    rows = []
    for day, delay in [("2024-01-01", "1"), ("2024-01-02", "3"), ("2024-01-09", "5")]:
        rows.append({"shipment_id": day, "shipment_date": day, "scheduled_days": "0", "actual_days": delay})
    out = R.rolling_delay(_raw(spark, rows)).collect()
    assert [r.rolling_7d_avg_delay for r in out] == [1.0, 2.0, 3.0]


def test_rolling_null_date_sorts_first(spark):
    rows = [
        {"shipment_id": "a", "shipment_date": "2024-01-01", "scheduled_days": "0", "actual_days": "2"},
        {"shipment_id": "b", "shipment_date": "bad", "scheduled_days": "0", "actual_days": "4"},
    ]
    out = R.rolling_delay(_raw(spark, rows)).collect()
    assert out[0].shipment_date is None and out[0].rolling_7d_avg_delay == 4.0
    assert out[1].rolling_7d_avg_delay == 3.0


def test_clean_types_and_float_cost(spark):
    raw = _raw(spark, [{"shipment_id": "1", "warehouse_block": "A", "cost_of_product": "2500.01", "weight_in_gms": "4145",
                        "actual_days": "5", "scheduled_days": "3"}])
    cl = C.clean(raw)
    types = dict(cl.dtypes)
    assert types["cost_of_product"] == "float" and types["customer_rating"] == "int"
    assert types["prior_purchases"] == "bigint" and types["delay_days"] == "int"
    r = cl.collect()[0]
    assert (r.delay_days, r.weight_kg, r.is_high_value) == (2, 4.15, 1)


def test_json_keeps_microseconds(spark):
    ts = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    df = spark.createDataFrame([("k", ts)], T.StructType([
        T.StructField("shipment_id", T.StringType()), T.StructField("ingested_at", T.TimestampType())]))
    value = M.to_messages(df, key=None).collect()[0].value
    assert "09.123456" in value
    back = M.decode(spark.createDataFrame([(value,)], "value string")).select(
        F.col("ingested_at").try_cast("timestamp").alias("t")).collect()[0].t
    assert back == ts


def test_rating_share_is_double(spark):
    raw = _raw(spark, [{"shipment_id": str(i), "product_category": "c", "customer_rating": str(1 + i % 3)} for i in range(3)])
    out = R.rating_distribution(raw)
    assert dict(out.dtypes)["pct_of_category"] == "double"
    assert sorted(r.pct_of_category for r in out.collect()) == [33.33, 33.33, 33.33]


def test_missing_tokens_by_name_and_by_column_agree(spark):
    from parcelwise.functions import missing_to_null

    values = list(S.MISSING_TOKENS) + ["ok", "n/a ", "NaN!", "it's", "back\\slash", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    by_name = [r.a for r in df.select(missing_to_null("v").alias("a")).collect()]
    by_col = [r.b for r in df.select(missing_to_null(F.col("v")).alias("b")).collect()]
    assert by_name == by_col
    assert by_name[: len(S.MISSING_TOKENS)] == [None] * len(S.MISSING_TOKENS)
    assert by_name[len(S.MISSING_TOKENS):] == ["ok", "n/a ", "NaN!", "it's", "back\\slash", None]


def test_tokens_are_missing_by_name_and_by_column(spark):
    from parcelwise import schema as S
    from parcelwise.functions import missing_to_null

    texts = [*S.MISSING_TOKENS, None, "7", "na", "n/a ", "NaNs", "é", "€", "nul", "Ship", "12345678", "#N/A N/B"]
    df = spark.createDataFrame([(t,) for t in texts], "`a``b` string")
    want = [None if t in S.MISSING_TOKENS else t for t in texts]
    for column in (missing_to_null("a`b"), missing_to_null(df["`a``b`"])):
        assert [r[0] for r in df.select(column).collect()] == want
        assert "octet_length" in df.select(column.alias("x"))._jdf.queryExecution().optimizedPlan().toString()  # most texts are not hashed


def test_run_date_is_the_name_of_the_folder_without_a_pattern(spark, tmp_path):
    from parcelwise.sources import history, readers
    from parcelwise.sinks.writers import write_csv

    row = spark.createDataFrame([("1-1",)], "shipment_id string")
    for day in ("2024-01-01", "a b"):
        write_csv(row, f"{tmp_path}/{day}")
    for rows in (readers.read_landing(spark, str(tmp_path)), history.read_history(spark, str(tmp_path))):
        assert {r.ds.replace("%20", " ") for r in rows.collect()} == {"2024-01-01", "a b"}
        assert "regexp" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_loads_of_a_query_come_from_one_landed_copy(spark, sf_small):
    """The source is joined and typed once, however many loads are taken from it."""
    from parcelwise.plans import registry

    for load in registry._three_loads(spark, sf_small):
        plan = load._jdf.queryExecution().optimizedPlan().toString()
        assert "raw_once" in load.inputFiles()[0] and "Join" not in plan
