"""Reject quarantine: bitmask, raw texts, one write, and a second chance for rejected rows."""

import re

import pytest
from pyspark.sql import functions as F

from parcelwise import schema as S
from parcelwise.operators import ingest as G
from parcelwise.operators import quarantine as QU
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path


def _text(spark, *rows):
    full = [{c: None for c in S.SOURCE_COLUMNS} | r for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in S.SOURCE_COLUMNS) for r in full], S.SOURCE_TEXT_SCHEMA)


ROWS = (
    {"shipment_id": "ok", "weight_in_gms": "12", "shipment_date": "2024-01-02", "customer_rating": "4.0"},
    {"shipment_id": "two", "weight_in_gms": "heavy", "shipment_date": "2024-02-30"},
    {"shipment_id": "n/a", "weight_in_gms": "7"},                                      # a missing key and nothing malformed
    {"shipment_id": None, "cost_of_product": "1,5"},
    {"shipment_id": "gaps", "weight_in_gms": "NA", "cost_of_product": "", "actual_days": "null"},   # missing is not malformed
    {"shipment_id": "big", "customer_care_calls": "99999999999999999999", "cost_of_product": "1e999x"},
    {"shipment_id": "us", "shipment_date": "12/31/2024"},
)


@pytest.mark.parametrize(("strict", "kept"), [(False, {"ok", "two", "gaps", "big", "us"}), (True, {"ok", "gaps"})])
def test_rows_are_parted_and_counted_once(spark, strict, kept):
    path = shared_path(spark, "t_quarantine")
    got = QU.land_with_quarantine(_text(spark, *ROWS), path, run_ts=Rg.RUN_TS, strict=strict)
    assert (got.source_rows, got.accepted_rows, got.rejected_rows) == (7, len(kept), 7 - len(kept))
    assert {k: v for k, v in got.failures.items() if v} == {
        "shipment_id": 2, "weight_in_gms": 1, "shipment_date": 2, "cost_of_product": 2, "customer_care_calls": 1}
    assert {r.shipment_id for r in QU.accepted_rows(spark, path).collect()} == kept
    listed = {(r.shipment_id, r.field, r.raw_text) for r in QU.rejects(spark, path).collect()}
    assert listed == {("two", "weight_in_gms", "heavy"), ("two", "shipment_date", "2024-02-30"), (None, "shipment_id", "n/a"), (None, "shipment_id", None),
                      (None, "cost_of_product", "1,5"), ("big", "customer_care_calls", "99999999999999999999"), ("big", "cost_of_product", "1e999x"),
                      ("us", "shipment_date", "12/31/2024")}
    masks = {r.shipment_id: r.failed_fields for r in QU._read(spark, path).where("shipment_id is not null").collect()}
    assert masks["two"] == QU.field_bit("weight_in_gms") | QU.field_bit("shipment_date") and masks["ok"] == masks["gaps"] == 0


def test_lenient_rows_equal_plain_ingestion(spark, sf_small):
    path = shared_path(spark, "t_quarantine_same")
    text = Rg._malformed_source(spark, sf_small)
    QU.land_with_quarantine(text, path, run_ts=Rg.RUN_TS)
    want, got = G.ingest(text, run_ts=Rg.RUN_TS), QU.accepted_rows(spark, path)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_rejected_rows_can_be_typed_again_by_other_rules(spark):
    path = shared_path(spark, "t_quarantine_again")
    QU.land_with_quarantine(_text(spark, *ROWS), path, strict=True)
    again = QU.classified(QU.rejected_text(spark, path), strict=True, date_formats=("MM/dd/yyyy",))
    assert [(r.shipment_id, str(r.shipment_date)) for r in again.where(F.col("status") == QU.ACCEPTED).collect()] == [("us", "2024-12-31")]
    assert again.count() == 5


def test_one_scan_no_python_and_pruned_readers(spark, sf_small, capsys):
    path = shared_path(spark, "t_quarantine_plan")
    QU.land_with_quarantine(Rg._malformed_source(spark, sf_small), path)
    capsys.readouterr()
    QU.accepted_rows(spark, path).explain("formatted")
    assert re.search(r"PartitionFilters: \[.*status#\d+ = accepted", capsys.readouterr().out)
    QU.classified(Rg._malformed_source(spark, sf_small)).explain("extended")
    text = capsys.readouterr().out
    assert text.split("== Physical Plan ==")[1].count("lineitem.parquet") == 1 and "Python" not in text


def test_empty_source_and_missing_path(spark):
    path = shared_path(spark, "t_quarantine_empty")
    got = QU.land_with_quarantine(_text(spark), path)
    assert (got.source_rows, got.accepted_rows, got.rejected_rows) == (0, 0, 0) and QU.rejects(spark, path).isEmpty()
    with pytest.raises(FileNotFoundError):
        QU.rejects(spark, path + "x")
