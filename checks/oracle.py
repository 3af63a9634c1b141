"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

Each text reads the pre-registered base views (lineitem, orders, part,
supplier, customer, nation, region) and rebuilds the shipment source, the
typed raw table and the clean table as CTEs, then states the query in
plain SQL. Spark's ``round`` is HALF_UP on the shortest decimal form of a
double, so the oracle rounds through DECIMAL; ASC sorts say NULLS FIRST and
DESC sorts NULLS LAST, as Spark and the reference's warehouse do; sums and
ranks are cast to BIGINT and months to DATE.
"""

from __future__ import annotations

# Stated here on purpose and not read from the package: a wrong constant there must turn rows red.
DEDUP_CUTOFF = "1997-01-01"   # boundary between the two incremental loads
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null")
COLUMNS = {
    "shipment_id": None, "customer_id": None, "product_category": None, "warehouse_block": None, "mode_of_shipment": None,
    "route": None, "customer_care_calls": "BIGINT", "customer_rating": "BIGINT", "cost_of_product": "DOUBLE",
    "prior_purchases": "BIGINT", "discount_offered": "DOUBLE", "weight_in_gms": "BIGINT", "scheduled_days": "BIGINT",
    "actual_days": "BIGINT", "on_time_delivery": "BIGINT", "shipment_date": "DATE",
}


def r2(expr: str) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,9)), 2) AS DOUBLE)"


def _tokens() -> str:
    return ", ".join("'" + t.replace("'", "''") + "'" for t in MISSING)


def _unmissing(col: str) -> str:
    return f"CASE WHEN {col} IN ({_tokens()}) THEN NULL ELSE {col} END"


SOURCE_TEXT = """
shipment_join AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, CAST(l.l_linenumber AS BIGINT) AS line,
         l.l_extendedprice, l.l_discount, l.l_shipdate, o.o_custkey, p.p_type, p.p_size,
         sr.r_name AS s_region, cr.r_name AS c_region,
         (l.l_orderkey * 31 + l.l_partkey * 17 + CAST(l.l_linenumber AS BIGINT) * 7) % 100
            < 8 + 2 * (sn.n_regionkey * 5 + cn.n_regionkey) AS late
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN region sr ON sn.n_regionkey = sr.r_regionkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN region cr ON cn.n_regionkey = cr.r_regionkey
),
source_text AS (
  SELECT
    CASE WHEN pk % 97 = 0 THEN NULL ELSE CAST(ok AS VARCHAR) || '-' || CAST(line AS VARCHAR) END AS shipment_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN pk % 101 = 0 THEN NULL ELSE p_type END AS product_category,
    CASE WHEN ok % 83 = 0 THEN NULL ELSE substr('ABCDE', CAST(sk % 5 AS INTEGER) + 1, 1) END AS warehouse_block,
    CASE line % 3 WHEN 0 THEN 'Ship' WHEN 1 THEN 'Flight' ELSE 'Road' END AS mode_of_shipment,
    CASE WHEN ok % 89 = 0 THEN NULL ELSE s_region || '->' || c_region END AS route,
    CASE WHEN pk % 71 = 0 THEN 'n/a' ELSE CAST(line AS VARCHAR) END AS customer_care_calls,
    CASE WHEN ok % 53 = 0 THEN NULL ELSE CAST(1 + (pk + ok) % 5 AS VARCHAR) END AS customer_rating,
    CAST(CAST(CAST(floor(l_extendedprice * 5) AS BIGINT) AS DOUBLE) / 100 AS VARCHAR) AS cost_of_product,
    CAST(o_custkey % 10 AS VARCHAR) AS prior_purchases,
    CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) AS discount_offered,
    CAST(500 + (pk * 37) % 6000 AS VARCHAR) AS weight_in_gms,
    CAST(2 + p_size % 7 AS VARCHAR) AS scheduled_days,
    CASE WHEN pk % 67 = 0 THEN NULL
         WHEN late THEN CAST(2 + p_size % 7 + 1 + pk % 4 AS VARCHAR)
         ELSE CAST(2 + p_size % 7 - pk % 3 AS VARCHAR) END AS actual_days,
    CASE WHEN late THEN '0' ELSE '1' END AS on_time_delivery,
    CASE WHEN ok % 211 = 0 THEN 'not-a-date' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS shipment_date
  FROM shipment_join
)"""


def _typed_select() -> str:
    cols = []
    for name, target in COLUMNS.items():
        expr = _unmissing(name)
        cols.append(f"{expr} AS {name}" if target is None else f"TRY_CAST({expr} AS {target}) AS {name}")
    return ",\n    ".join(cols)


TYPED = f"""
typed AS (
  SELECT
    {_typed_select()}
  FROM source_text
),
raw AS (SELECT * FROM typed WHERE shipment_id IS NOT NULL)"""

CLEAN = f"""
clean0 AS (
  SELECT shipment_id, customer_id, product_category, warehouse_block, mode_of_shipment, route,
    TRY_CAST(customer_care_calls AS INTEGER) AS customer_care_calls,
    TRY_CAST(customer_rating AS INTEGER) AS customer_rating,
    TRY_CAST(cost_of_product AS FLOAT) AS cost_of_product,
    prior_purchases, discount_offered,
    TRY_CAST(weight_in_gms AS INTEGER) AS weight_in_gms,
    TRY_CAST(scheduled_days AS INTEGER) AS scheduled_days,
    TRY_CAST(actual_days AS INTEGER) AS actual_days,
    TRY_CAST(on_time_delivery AS INTEGER) AS on_time_delivery,
    shipment_date
  FROM raw WHERE warehouse_block IS NOT NULL
),
clean AS (
  SELECT *,
    CASE WHEN actual_days > scheduled_days THEN actual_days - scheduled_days ELSE 0 END AS delay_days,
    {r2('weight_in_gms / 1000')} AS weight_kg,
    CASE WHEN cost_of_product > 2500 THEN 1 ELSE 0 END AS is_high_value
  FROM clean0
)"""

STRICT = "CASE WHEN actual_days IS NOT NULL AND scheduled_days IS NOT NULL THEN GREATEST(actual_days - scheduled_days, 0) END"


def _risk(rate: str) -> str:
    return (f"CASE WHEN {rate} > 40 THEN 'HIGH' "
            f"WHEN {rate} > 20 THEN 'MEDIUM' ELSE 'LOW' END")


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _src() -> str:
    return _with(SOURCE_TEXT, TYPED)


def _cln() -> str:
    return _with(SOURCE_TEXT, TYPED, CLEAN)


RAW_COLS = ", ".join(COLUMNS)

WAREHOUSE_KPIS = f"""{_cln()}, agg AS (
  SELECT warehouse_block,
    COUNT(shipment_id) AS total_shipments,
    {r2('AVG(on_time_delivery) * 100')} AS on_time_delivery_pct,
    {r2('AVG(delay_days)')} AS avg_delay_days,
    {r2('AVG(customer_rating)')} AS avg_customer_rating,
    {r2('AVG(cost_of_product)')} AS avg_product_cost,
    CAST(SUM(is_high_value) AS BIGINT) AS high_value_shipments
  FROM clean GROUP BY warehouse_block)
SELECT *, CAST(RANK() OVER (ORDER BY on_time_delivery_pct DESC NULLS LAST) AS BIGINT) AS warehouse_rank FROM agg"""

ROUTE_KPIS_CTE = f"""route_kpis AS (
  SELECT route,
    COUNT(shipment_id) AS total_shipments,
    {r2('(1 - AVG(on_time_delivery)) * 100')} AS delay_rate_pct,
    {r2('AVG(delay_days)')} AS avg_delay_days
  FROM clean GROUP BY route)"""

ROUTE_KPIS = f"""{_cln()}, {ROUTE_KPIS_CTE}
SELECT *, {_risk('delay_rate_pct')} AS risk_level FROM route_kpis"""

HIGH_RISK_ROUTES = f"""{_cln()}, {ROUTE_KPIS_CTE}
SELECT *, {_risk('delay_rate_pct')} AS risk_level FROM route_kpis WHERE delay_rate_pct > 30"""

CATEGORY_AGGS = f"""COUNT(shipment_id) AS shipment_count,
    {r2('AVG(on_time_delivery) * 100')} AS on_time_pct,
    {r2('AVG(customer_rating)')} AS avg_rating,
    {r2('AVG(discount_offered)')} AS avg_discount,
    {r2('SUM(cost_of_product)')} AS total_revenue"""

CATEGORY_KPIS = f"""{_cln()}
SELECT product_category, mode_of_shipment, {CATEGORY_AGGS}
FROM clean GROUP BY product_category, mode_of_shipment"""

CATEGORY_KPIS_MONTHLY = f"""{_cln()}
SELECT CAST(DATE_TRUNC('month', shipment_date) AS DATE) AS shipment_month, product_category, mode_of_shipment, {CATEGORY_AGGS}
FROM clean GROUP BY 1, 2, 3"""

WAREHOUSE_PERFORMANCE = f"""WITH wk AS ({WAREHOUSE_KPIS})
SELECT warehouse_block, total_shipments, avg_delay_days, warehouse_rank FROM wk"""

WAREHOUSE_KPIS_STRICT = f"""{_src()}
SELECT warehouse_block,
  COUNT(shipment_id) AS total_shipments,
  {r2('AVG(on_time_delivery) * 100')} AS on_time_delivery_pct,
  {r2(f'AVG({STRICT})')} AS avg_delay_days,
  {r2('AVG(customer_rating)')} AS avg_customer_rating,
  {r2('AVG(cost_of_product)')} AS avg_product_cost
FROM typed WHERE warehouse_block IS NOT NULL GROUP BY warehouse_block"""

ROUTE_KPIS_STRICT = f"""{_src()}
SELECT route,
  COUNT(shipment_id) AS total_shipments,
  {r2('(1 - AVG(on_time_delivery)) * 100')} AS delay_rate_pct,
  {r2(f'AVG({STRICT})')} AS avg_delay_days
FROM typed WHERE route IS NOT NULL GROUP BY route"""

REPORT_ON_TIME = f"""{_src()}
SELECT warehouse_block,
  COUNT(shipment_id) AS total_shipments,
  {r2('AVG(on_time_delivery) * 100')} AS on_time_pct,
  {r2(f'AVG({STRICT})')} AS avg_delay_days,
  CAST(RANK() OVER (ORDER BY AVG(on_time_delivery) DESC NULLS LAST) AS BIGINT) AS warehouse_rank
FROM raw GROUP BY warehouse_block
ORDER BY on_time_pct DESC NULLS LAST"""

REPORT_HIGH_RISK = f"""{_src()}
SELECT route,
  COUNT(shipment_id) AS total_shipments,
  {r2('(1 - AVG(on_time_delivery)) * 100')} AS delay_rate_pct,
  {r2(f'AVG({STRICT})')} AS avg_delay_days,
  {_risk('(1 - AVG(on_time_delivery)) * 100')} AS risk_level
FROM raw GROUP BY route
HAVING {r2('(1 - AVG(on_time_delivery)) * 100')} > 30
ORDER BY delay_rate_pct DESC NULLS LAST"""

REPORT_RATING = f"""{_src()}
SELECT product_category, customer_rating,
  COUNT(*) AS shipment_count,
  {r2('COUNT(*) * CAST(100.0 AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY product_category)')} AS pct_of_category
FROM raw GROUP BY product_category, customer_rating
ORDER BY product_category NULLS FIRST, customer_rating NULLS FIRST"""

REPORT_MONTHLY = f"""{_src()}
SELECT CAST(DATE_TRUNC('month', shipment_date) AS DATE) AS shipment_month, mode_of_shipment,
  COUNT(shipment_id) AS total_shipments,
  {r2('AVG(on_time_delivery) * 100')} AS on_time_pct,
  {r2('SUM(cost_of_product)')} AS total_revenue
FROM raw GROUP BY 1, 2
ORDER BY 1 NULLS FIRST, 2 NULLS FIRST"""

REPORT_ROLLING = f"""{_src()}
SELECT shipment_date,
  COUNT(shipment_id) AS daily_shipments,
  {r2(f'AVG({STRICT})')} AS avg_delay,
  {r2(f'AVG(AVG({STRICT})) OVER (ORDER BY shipment_date ASC NULLS FIRST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS rolling_7d_avg_delay
FROM raw GROUP BY shipment_date
ORDER BY shipment_date NULLS FIRST"""

INGEST_RAW = f"""{_src()}
SELECT {RAW_COLS} FROM raw"""

CONNECTOR_FILTERED = f"""{_src()}
SELECT shipment_id, warehouse_block, shipment_date, cost_of_product, customer_rating FROM raw
WHERE shipment_date >= DATE '1996-10-01' AND shipment_date < DATE '1997-01-01' AND warehouse_block IN ('A', 'B')
  AND customer_rating <> 3 AND cost_of_product > 1000"""

INGEST_COUNTS = f"""WITH {SOURCE_TEXT}
SELECT COUNT(*) AS source_rows,
  COUNT({_unmissing('shipment_id')}) AS valid_rows,
  COUNT(*) - COUNT({_unmissing('shipment_id')}) AS rejected_rows
FROM source_text"""

CLEAN_COLS = RAW_COLS + ", delay_days, weight_kg, is_high_value"

CLEAN_SHIPMENTS = f"""{_cln()}
SELECT {CLEAN_COLS} FROM clean"""

STRICT_DELAY = f"""{_src()}
SELECT shipment_id, actual_days, scheduled_days, cost_of_product,
  CAST(CASE WHEN actual_days > scheduled_days THEN actual_days - scheduled_days ELSE 0 END AS BIGINT) AS delay_days,
  {STRICT} AS strict_delay_days,
  CASE WHEN cost_of_product > 2500 THEN 1 ELSE 0 END AS is_high_value,
  COALESCE(CAST(cost_of_product > 2500 AS INTEGER), 0) AS is_high_value_flag
FROM raw"""

_SAMPLE_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in COLUMNS)

SAMPLE_ROWS = f"""{_src()}
SELECT {RAW_COLS} FROM raw ORDER BY {_SAMPLE_ORDER} LIMIT 5"""

_DEDUP_ORDER = ", ".join(
    f"{c} DESC NULLS LAST" for c in ["shipment_date"] + [c for c in COLUMNS if c not in ("shipment_id", "shipment_date")]
)

_OTHERS = ", ".join(f"{c} DESC NULLS LAST" for c in COLUMNS if c not in ("shipment_id", "shipment_date"))

INCREMENTAL_DEDUP = f"""{_src()},
day1 AS (SELECT *, 1 AS load FROM raw WHERE shipment_date < DATE '{DEDUP_CUTOFF}'),
day2 AS (
  SELECT *, 2 AS load FROM raw WHERE shipment_date IS NULL OR shipment_date >= DATE '{DEDUP_CUTOFF}'
  UNION ALL SELECT * REPLACE ('rerouted' AS route), 2 AS load FROM raw WHERE shipment_date < DATE '{DEDUP_CUTOFF}' AND customer_id LIKE '%7'),
loads AS (SELECT * FROM day1 UNION ALL SELECT * FROM day2)
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY load DESC, shipment_date DESC NULLS LAST, {_OTHERS}) AS rn FROM loads) WHERE rn = 1"""

INCREMENTAL_UPSERT = f"""{_src()},
loads AS (
  SELECT *, 1 AS load FROM raw WHERE shipment_date < DATE '{DEDUP_CUTOFF}'
  UNION ALL SELECT *, 2 AS load FROM raw WHERE shipment_date IS NULL OR shipment_date >= DATE '{DEDUP_CUTOFF}'
  UNION ALL SELECT * REPLACE ('rerouted' AS route), 2 AS load FROM raw WHERE shipment_date < DATE '{DEDUP_CUTOFF}' AND customer_id LIKE '%7'
  UNION ALL SELECT * REPLACE ('corrected' AS route, shipment_date + 1 AS shipment_date), 3 AS load FROM raw
    WHERE shipment_date BETWEEN DATE '1995-06-01' AND DATE '1995-06-30'
  UNION ALL SELECT * REPLACE ('stale' AS route), 0 AS load FROM raw WHERE customer_id LIKE '%3')
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY load DESC, shipment_date DESC NULLS LAST, {_OTHERS}) AS rn FROM loads) WHERE rn = 1"""

STREAM_DEDUP = f"""{_src()},
sent AS (SELECT *, CASE WHEN customer_id LIKE '%3' THEN 1 ELSE 2 END AS age FROM raw)
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY age DESC, shipment_date DESC NULLS LAST, {_OTHERS}) AS rn FROM sent) WHERE rn = 1"""

CSV_FOREIGN = f"""{_src()}
SELECT * REPLACE (route || ', "north"' || chr(10) || 'line 2 ' AS route) FROM (SELECT {RAW_COLS} FROM raw)"""

# Spark reads 3.0 as the whole number 3; no other malformed text of the fixture is a number of the wanted kind.
_MALFORMED = f"""bad_text AS (
  SELECT * REPLACE (
    CASE WHEN customer_id LIKE '%17' THEN 'heavy' ELSE weight_in_gms END AS weight_in_gms,
    CASE WHEN customer_id LIKE '%7' THEN customer_rating || '.5' ELSE customer_rating END AS customer_rating,
    CASE WHEN shipment_id LIKE '%3-1' THEN '12,50' ELSE cost_of_product END AS cost_of_product,
    CASE WHEN customer_id LIKE '%4' THEN '3.0' ELSE scheduled_days END AS scheduled_days) FROM source_text),
faults AS (
  SELECT *, {_unmissing('shipment_id')} IS NULL AS no_key,
    weight_in_gms = 'heavy' AS bad_weight, coalesce(customer_rating LIKE '%.5', false) AS bad_rating,
    cost_of_product = '12,50' AS bad_cost, coalesce(shipment_date = 'not-a-date', false) AS bad_date FROM bad_text)"""
_ANY = "(no_key OR bad_weight OR bad_rating OR bad_cost OR bad_date)"
_FAULTS = {"shipment_id": "no_key", "customer_rating": "bad_rating", "cost_of_product": "bad_cost", "weight_in_gms": "bad_weight", "shipment_date": "bad_date"}

INGEST_REJECTS = _with(SOURCE_TEXT, _MALFORMED) + " UNION ALL ".join(
    f"SELECT shipment_id, '{field}' AS field, {field} AS raw_text, 'rejected' AS status FROM faults WHERE {test}" for field, test in _FAULTS.items())

_TYPED_FAULTLESS = ", ".join(
    f"{_unmissing(c)} AS {c}" if t is None else f"CAST(TRY_CAST({_unmissing(c)} AS DOUBLE) AS BIGINT) AS {c}" if t == "BIGINT" else f"TRY_CAST({_unmissing(c)} AS {t}) AS {c}"
    for c, t in COLUMNS.items())
INGEST_ACCEPTED = f"""{_with(SOURCE_TEXT, _MALFORMED)}
SELECT {_TYPED_FAULTLESS} FROM faults WHERE NOT {_ANY}"""

INGEST_REJECT_COUNTS = _with(SOURCE_TEXT, _MALFORMED) + " UNION ALL ".join(
    f"SELECT '{c}' AS field, COUNT(*) FILTER ({_FAULTS.get(c, 'false')}) AS failures, COUNT(*) AS source_rows, "
    "COUNT(*) FILTER (NOT no_key) AS accepted_rows, COUNT(*) FILTER (no_key) AS rejected_rows FROM faults" for c in COLUMNS)

_DAYS = {"2024-01-01": 0, "2024-01-02": 1, "2024-01-03": 2}
_DELIVERED = " UNION ALL ".join(
    f"SELECT * {'REPLACE (CAST(NULL AS DOUBLE) AS discount_offered)' if n == 2 else ''}, '{ds}' AS ds FROM (SELECT {RAW_COLS} FROM raw WHERE CAST(customer_id AS BIGINT) % 3 = {n})"
    for ds, n in _DAYS.items())
DRIFTING_LANDING = f"{_src()} {_DELIVERED}"
DRIFTING_RANGE = f"{_src()} SELECT * FROM ({_DELIVERED}) WHERE ds >= '2024-01-02'"

_KINDS = {
    "int": "regexp_full_match(v, '[+-]?[0-9]{1,38}') AND TRY_CAST(v AS INTEGER) IS NOT NULL",
    "bigint": "regexp_full_match(v, '[+-]?[0-9]{1,38}') AND TRY_CAST(v AS BIGINT) IS NOT NULL",
    "decimal": "regexp_full_match(v, '[+-]?[0-9]{1,38}')",
    "double": "regexp_full_match(v, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')",
    "date": "regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(v AS DATE) IS NOT NULL",
    "timestamp": "regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+)?') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
    "boolean": "lower(v) IN ('true', 'false')",
}


def _first_kind(least: str) -> str:
    return "CASE WHEN n_values = 0 THEN 'string' " + " ".join(f"WHEN n_{k} >= {least} THEN '{k}'" for k in _KINDS) + " ELSE 'string' END"


def _by_kind(what: str, other: str) -> str:
    return "CASE leading_type " + " ".join(f"WHEN '{k}' THEN {what.format(k)}" for k in _KINDS) + f" ELSE {other} END"


_PROFILE = _with(SOURCE_TEXT, _MALFORMED).rstrip() + ", cells AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_unmissing(c)} AS v FROM bad_text" for c in COLUMNS) + f"""),
counted AS (SELECT column_name, COUNT(v) AS n_values, COUNT(*) - COUNT(v) AS n_missing,
  {", ".join(f"COUNT(*) FILTER ({t}) AS n_{k}, MIN(v) FILTER (NOT ({t})) AS least_{k}" for k, t in _KINDS.items())}
  FROM cells GROUP BY column_name),
led AS (SELECT *, {_first_kind("n_values")} AS exact_type, {_first_kind("n_values * 0.95")} AS leading_type FROM counted)
"""
CSV_TYPE_PROFILE = f"""{_PROFILE}
SELECT column_name, n_values, n_missing, {", ".join(f"n_{k}" for k in _KINDS)}, exact_type, leading_type,
  {_by_kind("n_values - n_{}", "0")} AS n_offenders, {_by_kind("least_{}", "NULL")} AS example FROM led"""
CSV_TYPE_OFFENDERS = _PROFILE + " UNION ALL ".join(
    f"SELECT column_name, leading_type, v AS value, COUNT(*) AS n_rows FROM cells JOIN led USING (column_name) "
    f"WHERE v IS NOT NULL AND leading_type = '{k}' AND NOT ({t}) GROUP BY ALL" for k, t in _KINDS.items())

STREAM_RUN_SUMMARY = f"""{_src()}
SELECT 'shipments' AS query, CAST(3 AS BIGINT) AS batches, COUNT(*) AS source_rows, COUNT(shipment_id) AS landed_rows,
  COUNT(*) FILTER (shipment_id IS NOT NULL AND shipment_date IS NULL) AS undated_rows,
  {r2("SUM(CAST(cost_of_product AS DECIMAL(18,2))) FILTER (shipment_id IS NOT NULL)")} AS total_cost,
  MIN(shipment_date) FILTER (shipment_id IS NOT NULL) AS first_date, MAX(shipment_date) FILTER (shipment_id IS NOT NULL) AS last_date FROM typed"""

INGEST_STAMP = f"""{_src()}
SELECT shipment_id, '2024-01-01 06:00:00' AS ingested_at FROM raw"""

CLEAN_COUNTS = f"""{_cln()}
SELECT COUNT(*) AS clean_rows, CAST(20 AS BIGINT) AS clean_columns FROM clean"""

DEDUP_LATEST = f"""{_src()}
SELECT {RAW_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY {_DEDUP_ORDER}) AS rn FROM raw) WHERE rn = 1"""


def _group_count(table: str, keys: str) -> str:
    return f"(SELECT COUNT(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys}))"


QUALITY_REPORT = f"""{_cln()}
SELECT 'source_rows' AS check_name, COUNT(*) AS observed, CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM source_text
UNION ALL SELECT 'valid_rows', COUNT(*), CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM raw
UNION ALL SELECT 'landed_rows', COUNT(*), 'PASS' FROM raw
UNION ALL SELECT 'warehouse_kpis_rows', {_group_count('clean', 'warehouse_block')}, 'PASS'
UNION ALL SELECT 'route_kpis_rows', {_group_count('clean', 'route')}, 'PASS'
UNION ALL SELECT 'category_kpis_rows', {_group_count('clean', 'product_category, mode_of_shipment')}, 'PASS'"""

RUN_SUMMARY = f"""{_src()}
SELECT 'ecommerce_shipment_pipeline' AS pipeline, DATE '2024-01-01' AS run_date,
  (SELECT COUNT(*) FROM source_text) AS source_rows,
  (SELECT COUNT(*) FROM raw) AS landed_rows,
  CAST(3 AS BIGINT) AS kpi_outputs,
  'SUCCESS' AS status"""

RECONCILED_DAYS = f"""{_src()}, d AS (
  SELECT shipment_date, COUNT(*) AS n, COALESCE(SUM(CAST(cost_of_product AS DECIMAL(20,4))), 0) AS cost, COALESCE(SUM(weight_in_gms), 0) AS grams
  FROM raw GROUP BY shipment_date)
SELECT shipment_date, n AS source_rows, n AS landed_rows, CAST(cost AS DOUBLE) AS source_cost, CAST(cost AS DOUBLE) AS landed_cost,
  CAST(grams AS BIGINT) AS source_grams, CAST(grams AS BIGINT) AS landed_grams, 'OK' AS status FROM d"""

RECONCILED_KPIS = f"""{_cln()}
SELECT name AS output, n AS observed, n AS expected, 'OK' AS status
FROM (SELECT COUNT(shipment_id) AS n FROM clean), (VALUES ('warehouse_kpis'), ('route_kpis'), ('category_kpis')) v(name)"""

ROUNDTRIPS = ("csv_roundtrip", "csv_inferred_read", "parquet_roundtrip", "source_preference", "dated_landing",
              "partitioned_overwrite", "connector_roundtrip", "json_publish", "stream_publish", "stream_ingest", "layout_compacted", "layout_clustered")

REPORTS = {
    "on_time_by_warehouse": REPORT_ON_TIME,
    "high_risk_routes": REPORT_HIGH_RISK,
    "rating_distribution": REPORT_RATING,
    "monthly_volume": REPORT_MONTHLY,
    "rolling_delay": REPORT_ROLLING,
}
KPIS = {"warehouse_kpis": WAREHOUSE_KPIS, "route_kpis": ROUTE_KPIS, "category_kpis": CATEGORY_KPIS}


def _corrected(sql: str) -> str:
    """The same KPI over the rows after June 1995 has been delivered again: rated rows only, two days late, on another route."""
    again = TYPED.replace("raw AS (SELECT * FROM typed WHERE shipment_id IS NOT NULL)", """raw AS (
  SELECT * FROM typed WHERE shipment_id IS NOT NULL AND (shipment_date IS NULL OR NOT shipment_date BETWEEN DATE '1995-06-01' AND DATE '1995-06-30')
  UNION ALL SELECT * REPLACE (scheduled_days + 2 AS actual_days, 'corrected' AS route) FROM typed
    WHERE shipment_id IS NOT NULL AND customer_rating >= 2 AND shipment_date BETWEEN DATE '1995-06-01' AND DATE '1995-06-30')""")
    return sql.replace(TYPED, again)


def oracle_sql() -> dict[str, str]:
    return {
        "ingest_raw": INGEST_RAW,
        "ingest_counts": INGEST_COUNTS,
        "clean_shipments": CLEAN_SHIPMENTS,
        "strict_delay": STRICT_DELAY,
        "warehouse_kpis": WAREHOUSE_KPIS,
        "warehouse_performance": WAREHOUSE_PERFORMANCE,
        "route_kpis": ROUTE_KPIS,
        "high_risk_routes": HIGH_RISK_ROUTES,
        "category_kpis": CATEGORY_KPIS,
        "category_kpis_monthly": CATEGORY_KPIS_MONTHLY,
        "warehouse_kpis_strict": WAREHOUSE_KPIS_STRICT,
        "route_kpis_strict": ROUTE_KPIS_STRICT,
        "report_on_time_by_warehouse": REPORT_ON_TIME,
        "report_high_risk_routes": REPORT_HIGH_RISK,
        "report_rating_distribution": REPORT_RATING,
        "report_monthly_volume": REPORT_MONTHLY,
        "report_rolling_delay": REPORT_ROLLING,
        "sample_rows": SAMPLE_ROWS,
        "dedup_latest": DEDUP_LATEST,
        "incremental_dedup": INCREMENTAL_DEDUP,
        "incremental_upsert": INCREMENTAL_UPSERT,
        **{k: INGEST_RAW for k in ROUNDTRIPS},
        "table_read_query": WAREHOUSE_KPIS,
        "connector_kpis": WAREHOUSE_KPIS,
        "connector_filtered": CONNECTOR_FILTERED,
        "stream_ingest_dedup": STREAM_DEDUP,
        "stream_dedup_bounded": DEDUP_LATEST,
        "csv_foreign": CSV_FOREIGN,
        "stream_run_summary": STREAM_RUN_SUMMARY,
        "csv_type_profile": CSV_TYPE_PROFILE,
        "csv_type_offenders": CSV_TYPE_OFFENDERS,
        "drifting_landing": DRIFTING_LANDING,
        "drifting_landing_range": DRIFTING_RANGE,
        "ingest_stamp": INGEST_STAMP,
        "ingest_rejects": INGEST_REJECTS,
        "ingest_accepted": INGEST_ACCEPTED,
        "ingest_reject_counts": INGEST_REJECT_COUNTS,
        "clean_counts": CLEAN_COUNTS,
        **{f"daily_{k}": sql for k, sql in KPIS.items()},
        **{f"incremental_{k}": _corrected(sql) for k, sql in (KPIS | {"category_kpis_monthly": CATEGORY_KPIS_MONTHLY}).items()},
        **{f"published_{k}": f"SELECT *, '2024-01-01 06:00:00' AS computed_at FROM ({sql})" for k, sql in KPIS.items()},
        **{f"daily_report_{k}": sql for k, sql in REPORTS.items()},
        "quality_report": QUALITY_REPORT,
        "reconciled_days": RECONCILED_DAYS,
        "reconciled_kpis": RECONCILED_KPIS,
        "run_summary": RUN_SUMMARY,
    }
