"""KPIs from day states: equal to a full run after every load, and only touched days are read."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import kpi_state as KS
from parcelwise.operators import kpis as A
from parcelwise.operators.clean import clean
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.sinks import writers as W
from parcelwise.sources import readers as SR


@pytest.fixture(scope="module")
def raw(spark, sf_small):
    path = shared_path(spark, "t_states_raw")
    Rg.raw_shipments(spark, sf_small).where("shipment_date is null or shipment_date between DATE'1995-01-01' and DATE'1995-05-31'").write.parquet(path)
    rows = SR.read_landed(spark, path)
    assert rows.where("shipment_date is not null").count() > 50
    return rows



def _agree(spark, landed, states):
    rows = clean(SR.read_landed(spark, landed))
    full, merged = A.kpis_from_rollup(A.kpi_rollup(rows)), KS.kpis_from_states(spark, states)
    for name in A.PUBLISHED:
        assert sorted(map(str, _rows(full[name]))) == sorted(map(str, _rows(merged[name]))), name
    assert sorted(map(str, _rows(A.category_kpis_monthly(rows)))) == sorted(map(str, _rows(KS.monthly_from_states(spark, states))))


def _rows(df):
    return [tuple(r) for r in df.select(*sorted(df.columns)).collect()]


def _load(spark, rows, landed, states):
    days = KS.touched_days(rows)
    W.land_partitioned(rows, landed, dynamic=True)
    return days, KS.update_states(spark, landed, days, states)


def test_states_equal_a_full_run_after_each_load(spark, raw):
    base = shared_path(spark, "t_states")
    landed, states = f"{base}/raw", f"{base}/states"
    for part in ("shipment_date < DATE'1995-04-01'", "shipment_date >= DATE'1995-04-01'", "shipment_date is null"):
        _load(spark, raw.where(part), landed, states)
        _agree(spark, landed, states)
    # an old week again, with fewer rows and other values; a day whose rows all lose their block; the null day
    week = raw.where("shipment_date between DATE'1995-02-03' and DATE'1995-02-09' and customer_rating > 3").withColumn("route", F.lit("again"))
    gone = raw.where("shipment_date = DATE'1995-03-03'").withColumn("warehouse_block", F.lit(None).cast("string"))
    days, number = _load(spark, week.unionByName(gone).unionByName(raw.where("shipment_date is null").limit(3)), landed, states)
    assert None in days and number == 4
    _agree(spark, landed, states)
    assert KS.read_states(spark, states).where("shipment_date = DATE'1995-03-03'").isEmpty()
    KS.update_states(spark, landed, days, states)                                    # again after a failure: nothing changes
    _agree(spark, landed, states)
    KS.compact(spark, states)
    assert KS._loads(spark, states) == [6]
    _agree(spark, landed, states)


def test_a_load_reads_only_its_days(spark, raw, capsys):
    base = shared_path(spark, "t_states_plan")
    W.land_partitioned(raw, f"{base}/raw")
    days = [dt.date(1995, 2, 3), dt.date(1995, 2, 4)]
    rows = KS.day_states(clean(KS.landed_days(spark, f"{base}/raw", days)))
    capsys.readouterr()
    rows.explain("formatted")
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", capsys.readouterr().out)
    assert filters and all("1995-02-03" in f and "1995-02-04" in f and f.count("1995-") == 2 for f in filters)
    assert {r[0] for r in rows.select("shipment_date").distinct().collect()} <= set(days)
    assert len(KS.landed_days(spark, f"{base}/raw", [None]).inputFiles()) >= 1
    assert KS.landed_days(spark, f"{base}/raw", []).count() == 0


def test_no_states(spark):
    path = shared_path(spark, "t_no_states")
    assert all(df.count() == 0 for df in KS.kpis_from_states(spark, path).values())
    KS.compact(spark, path)
