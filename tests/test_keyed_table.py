"""The incremental target with a key index: what a load rewrites, late rows, broken and concurrent loads."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import dedup as D
from parcelwise.operators import keyed_table as KT
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.streaming import ingest_stream as T2
from parcelwise.streaming import messages as T1


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(path.replace("file:", "") + "/data/*/*/*.parquet")}


def test_a_small_load_leaves_nine_files_of_ten(spark, sf_small):
    raw = D.latest_per_key(Rg.raw_shipments(spark, sf_small))
    path = shared_path(spark, "t_keyed")
    first = KT.load_keyed(raw, path, rows_per_group=100)
    before = _files(path)
    n = raw.count()
    assert first.new_rows == n and first.groups_added == len(before) == -(-n // 100)
    # one percent of the keys, all of one date range, with a newer stamp and another date
    range_ = raw.orderBy("shipment_date", "shipment_id").where("shipment_date is not null").limit(n // 100)
    change = range_.withColumns({"ingested_at": F.lit(Rg.NEXT_RUN_TS).cast("timestamp"), "route": F.lit("moved"),
                                 "shipment_date": F.date_add("shipment_date", 400)})
    done = KT.load_keyed(change, path, rows_per_group=100)
    assert (done.new_rows, done.known_rows) == (0, n // 100) and done.groups_kept >= 0.9 * len(before)
    after = _files(path)
    assert {f: t for f, t in after.items() if f in before} == before              # no file was written again
    current = KT.manifest(spark, path)
    assert current.where(~F.col("load").startswith("00000001")).count() == done.groups_rewritten <= 0.1 * len(before)
    expected = D.latest_per_key(raw.unionByName(change))
    assert _same(KT.read_keyed(spark, path, raw.schema), expected)
    assert _same(KT.read_keyed(spark, path, raw.schema, commit=1), raw)            # the state before is still there
    assert KT.vacuum(spark, path) == done.groups_rewritten
    assert _same(KT.read_keyed(spark, path, raw.schema), expected)


def _rows(spark, *rows):
    return spark.createDataFrame(rows, "shipment_id string, ingested_at string, shipment_date string, route string").withColumns({
        "ingested_at": F.col("ingested_at").cast("timestamp"), "shipment_date": F.col("shipment_date").cast("date")})


def _load(spark, path, *rows, **options):
    return KT.load_keyed(_rows(spark, *rows), path, **options)


def _read(spark, path):
    return {r.shipment_id: r.route for r in KT.read_keyed(spark, path, _rows(spark, ("a", None, None, None)).schema).collect()}


def test_newest_row_wins_across_loads_and_repeats_change_nothing(spark):
    path = shared_path(spark, "t_keyed_rows")
    day1 = [("a", "2024-01-01", "2023-05-01", "old"), ("b", "2024-01-01", None, "b1"), (None, "2024-01-01", None, "no key"), ("a", "2023-12-01", None, "older")]
    assert _load(spark, path, *day1).new_rows == 2
    result = _load(spark, path, ("a", "2024-01-03", None, "new"), ("c", "2024-01-03", None, "c1"), rows_per_group=1)
    assert (result.new_rows, result.known_rows, result.groups_added, result.groups_rewritten) == (1, 1, 1, 1)
    _load(spark, path, ("a", "2024-01-02", "2024-01-02", "late"), ("b", "2024-01-02", None, "b2"))
    assert _read(spark, path) == {"a": "new", "b": "b2", "c": "c1"}
    repeat = _load(spark, path, *day1)
    assert repeat.new_rows == 0 and _read(spark, path) == {"a": "new", "b": "b2", "c": "c1"}
    empty = KT.load_keyed(_rows(spark, *day1).limit(0), path)
    assert empty.commit == repeat.commit and _read(spark, path) == {"a": "new", "b": "b2", "c": "c1"}


def test_empty_target(spark):
    path = shared_path(spark, "t_keyed_empty")
    schema = _rows(spark, ("a", None, None, None)).schema
    assert KT.read_keyed(spark, path, schema).count() == 0 and KT.vacuum(spark, path) == 0
    assert KT.load_keyed(_rows(spark, ("a", None, None, None)).limit(0), path).commit == 0


def test_a_load_that_breaks_before_its_commit_is_not_seen(spark, monkeypatch):
    path = shared_path(spark, "t_keyed_broken")
    _load(spark, path, ("a", "2024-01-01", None, "one"), ("b", "2024-01-01", None, "one"))
    monkeypatch.setattr(KT, "create_exclusively", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        _load(spark, path, ("a", "2024-01-02", None, "two"), ("z", "2024-01-02", None, "two"))
    monkeypatch.undo()
    assert _read(spark, path) == {"a": "one", "b": "one"}
    _load(spark, path, ("z", "2024-01-03", None, "three"))
    assert _read(spark, path) == {"a": "one", "b": "one", "z": "three"}
    assert KT.vacuum(spark, path) > 0 and _read(spark, path) == {"a": "one", "b": "one", "z": "three"}


def test_of_two_loads_from_one_state_the_second_stops(spark, monkeypatch):
    path = shared_path(spark, "t_keyed_race")
    _load(spark, path, ("a", "2024-01-01", None, "one"))
    plain = KT.create_exclusively

    def other_first(spark_, name, line):
        monkeypatch.setattr(KT, "create_exclusively", plain)
        _load(spark, path, ("a", "2024-01-03", None, "other"), ("n", "2024-01-03", None, "other"))
        return plain(spark_, name, line)

    monkeypatch.setattr(KT, "create_exclusively", other_first)
    with pytest.raises(KT.ConcurrentLoad):
        _load(spark, path, ("a", "2024-01-04", None, "mine"))
    assert _read(spark, path) == {"a": "other", "n": "other"}
    _load(spark, path, ("a", "2024-01-04", None, "mine"))
    assert _read(spark, path) == {"a": "mine", "n": "other"}


def test_stream_merges_into_a_keyed_target(spark, sf_small):
    raw = Rg.raw_shipments(spark, sf_small)
    topic, base = shared_path(spark, "t_topic"), shared_path(spark, "t_keyed_stream")
    for _ in range(2):
        T1.publish(raw, topic)
        got = T2.run_to_completion(spark, topic, f"{base}/events", f"{base}/_checkpoint", keyed=True)
    assert _same(got.select(*raw.columns), D.latest_per_key(raw))
