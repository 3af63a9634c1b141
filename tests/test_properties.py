"""Property tests: operators against brute-force Python on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parcelwise import schema as S
from parcelwise.functions import delay_days, strict_delay_days
from parcelwise.operators import dedup as D
from parcelwise.operators import ingest as G
from parcelwise.operators import reports as R

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

small_int = st.one_of(st.none(), st.integers(min_value=-3, max_value=12))


@SETTINGS
@given(st.lists(st.tuples(small_int, small_int), min_size=1, max_size=30))
def test_delay_rules_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "actual_days bigint, scheduled_days bigint")
    got = [(r.d, r.s) for r in df.select(delay_days().alias("d"), strict_delay_days().alias("s")).collect()]
    want = []
    for a, s in pairs:
        lenient = a - s if a is not None and s is not None and a > s else 0
        strict = None if a is None or s is None else max(a - s, 0)
        want.append((lenient, strict))
    assert got == want


row = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.one_of(st.none(), st.integers(min_value=0, max_value=3)),       # recency
    st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),            # payload
)


def _struct_key(v):
    # Spark orders a struct field NULL-first (NULL is the smallest value).
    return (0, 0) if v is None else (1, v)


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "shipment_id string, shipment_date int, route string")
    got = sorted(tuple(r) for r in D.latest_per_key(df, recency=("shipment_date",)).collect())
    best = {}
    for k, rec, payload in rows:
        cand = (_struct_key(rec), _struct_key(payload))
        if k not in best or cand > best[k][0]:
            best[k] = (cand, (k, rec, payload))
    assert got == sorted(v[1] for v in best.values())


day = st.one_of(st.none(), st.integers(min_value=0, max_value=20))


@SETTINGS
@given(st.lists(st.tuples(day, small_int, small_int), min_size=1, max_size=40))
def test_rolling_delay_matches_brute_force(spark, rows):
    base = dt.date(2024, 1, 1)
    text = []
    for i, (d, actual, scheduled) in enumerate(rows):
        rec = {c: None for c in S.SOURCE_COLUMNS}
        rec.update(shipment_id=str(i),
                   shipment_date=None if d is None else (base + dt.timedelta(days=d)).isoformat(),
                   actual_days=None if actual is None else str(actual),
                   scheduled_days=None if scheduled is None else str(scheduled))
        text.append(tuple(rec[c] for c in S.SOURCE_COLUMNS))
    raw = G.ingest(spark.createDataFrame(text, S.SOURCE_TEXT_SCHEMA), run_ts="2024-01-01 00:00:00")
    got = [(r.shipment_date, r.daily_shipments, r.rolling_7d_avg_delay) for r in R.rolling_delay(raw).collect()]

    days = {}
    for d, actual, scheduled in rows:
        key = None if d is None else base + dt.timedelta(days=d)
        strict = None if actual is None or scheduled is None else max(actual - scheduled, 0)
        days.setdefault(key, []).append(strict)
    order = sorted(days, key=lambda k: (k is not None, k or base))       # NULL date first
    daily = []
    for k in order:
        vals = [v for v in days[k] if v is not None]
        daily.append(sum(vals) / len(vals) if vals else None)
    want = []
    for i, k in enumerate(order):
        window = [v for v in daily[max(0, i - 6): i + 1] if v is not None]
        rolling = round(sum(window) / len(window) + 1e-12, 2) if window else None
        want.append((k, len(days[k]), rolling))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    for (_, _, g), (_, _, w) in zip(got, want):
        assert (g is None and w is None) or abs(g - w) < 1e-9
