"""Range numbers of the clustering and type masks of the profile: worked out once per value, without a sort."""

import datetime as dt

from pyspark.sql import functions as F

from parcelwise.sinks import layout as L
from parcelwise.sources import type_profile as TP


def test_range_numbers_interleave_in_generated_code(spark):
    days = [None, *[dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in range(5)]]
    rows = spark.createDataFrame([(d, w) for d in days for w in (None, float("nan"), 0.0, 1.5, 3.0)], "d date, w double")
    cuts = {"d": [float((dt.date(2024, 1, n) - dt.date(1970, 1, 1)).days) for n in (1, 3, 4)], "w": [0.0, 1.0]}
    got = rows.select("d", "w", L.interleaved(rows, cuts, 2).alias("n"))
    assert "lambda" not in got._jdf.queryExecution().toString()

    def below(v, values):
        return 0 if v is None else len(values) if v != v else sum(c < v for c in values)

    for r in got.collect():
        a, b = below(None if r.d is None else (r.d - dt.date(1970, 1, 1)).days, cuts["d"]), below(r.w, cuts["w"])
        assert r.n == ((a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | (b & 1)), r
    assert {r[0] for r in rows.select(L.interleaved(rows, {"d": [], "w": []})).collect()} == {0}


def test_profile_sorts_no_values(spark):
    rows = spark.createDataFrame([("1", "a")], "n string, t string")
    plan = TP.type_profile(rows)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan


def test_masks_hold_what_every_type_admits(spark):
    texts = ["1", "-7", "+3000000000", "9" * 38, "9" * 39, "1.5", ".5", "1e9", "1e999", "0x1", "1d", "NaN", "2024-02-29", "2023-02-29",
             "0000-01-01", "2024-01-01 10:00:00", "2024-01-01T25:00:00", "2024-01-01 ", "True", "false", "", " 1", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    masks = rows.select("value", TP._mask(F.col("value")).alias("mask"), *[c.alias(t) for t, c in TP._admits(F.col("value")).items()])
    for r in masks.where("value is not null").collect():
        assert [t for i, t in enumerate(TP.TYPES) if r["mask"] >> i & 1] == [t for t in TP.TYPES if r[t]], r
