"""Column expressions shared by the batch and streaming paths.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise import schema as S


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def missing_to_null(col: str | Column, tokens=S.MISSING_TOKENS) -> Column:
    """Map the missing-value tokens of a CSV loader to NULL (text columns).

    The test is one SQL expression (one call to the JVM instead of one per
    token), a hashed IN set. A text is hashed only if it has the length in
    bytes of some token: most fields, single digits above all, have not.
    """
    lengths = sorted({len(t.encode()) for t in tokens})
    if isinstance(col, str):
        name = "`" + col.replace("`", "``") + "`"
        in_list = ", ".join(_sql_text(t) for t in tokens)
        return F.expr(f"CASE WHEN octet_length({name}) IN ({', '.join(map(str, lengths))}) AND {name} IN ({in_list}) THEN CAST(NULL AS STRING) ELSE {name} END")
    return F.when(F.octet_length(col).isin(*lengths) & col.isin(*tokens), F.lit(None).cast(T.StringType())).otherwise(col)


def lenient_cast(col: str | Column, data_type: T.DataType) -> Column:
    """Cast that yields NULL for malformed text instead of failing the job.

    Spark 4 runs with ANSI mode on, where a plain ``cast('n/a' as int)``
    raises; the reference was written for the NULL-on-failure behaviour.
    """
    c = _c(col)
    if not isinstance(data_type, T.IntegralType):
        return c.try_cast(data_type)
    # an integer column with gaps is often written as decimals: 4.0 is 4, 4.5 is malformed
    number = c.try_cast(T.DoubleType())
    return F.coalesce(c.try_cast(data_type), F.when(number % 1 == 0, number.try_cast(data_type)))


def lenient_date(col: str | Column, formats: tuple[str, ...] = ()) -> Column:
    """Parse a date; unparseable text (``not-a-date``, ``2024-02-30``) is NULL.

    ISO text is parsed by cast; optional extra ``formats`` are tried in order.
    """
    c = _c(col)
    parsed = [c.try_cast(T.DateType())]
    parsed += [F.try_to_date(c, fmt) for fmt in formats]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def delay_days(actual: str | Column = "actual_days", scheduled: str | Column = "scheduled_days") -> Column:
    """Days late; early, on time and unknown all count as 0 (PySpark path)."""
    a, s = _c(actual), _c(scheduled)
    return F.when(a > s, a - s).otherwise(F.lit(0))


def strict_delay_days(actual: str | Column = "actual_days", scheduled: str | Column = "scheduled_days") -> Column:
    """max(actual - scheduled, 0), NULL when either side is NULL (SQL path).

    Spark's ``greatest`` skips NULLs, so the guard is explicit.
    """
    a, s = _c(actual), _c(scheduled)
    return F.when(a.isNotNull() & s.isNotNull(), F.greatest(a - s, F.lit(0)))


def weight_kg(grams: str | Column = "weight_in_gms") -> Column:
    return F.round(_c(grams) / 1000, 2)


def high_value_flag(cost: str | Column = "cost_of_product") -> Column:
    """1 when cost is strictly above the threshold, else 0 (NULL cost gives 0)."""
    return F.when(_c(cost) > S.HIGH_VALUE_COST, F.lit(1)).otherwise(F.lit(0))


def high_value_flag_from_bool(cost: str | Column = "cost_of_product") -> Column:
    """The boolean-to-int form of the same flag; equal to ``high_value_flag``."""
    return F.coalesce((_c(cost) > S.HIGH_VALUE_COST).cast(T.IntegerType()), F.lit(0))


def pct(avg_col: Column) -> Column:
    """avg of a 0/1 flag as a percentage, 2 places."""
    return F.round(avg_col * 100, 2)


def miss_pct(avg_col: Column) -> Column:
    """share of 0s of a 0/1 flag as a percentage, 2 places."""
    return F.round((1 - avg_col) * 100, 2)


def risk_band(rate: str | Column) -> Column:
    """HIGH above 40, MEDIUM above 20, else LOW (NULL rate is LOW)."""
    r = _c(rate)
    high, medium, low = S.RISK_LABELS
    return (F.when(r > S.RISK_HIGH_PCT, F.lit(high))
            .when(r > S.RISK_MEDIUM_PCT, F.lit(medium))
            .otherwise(F.lit(low)))


def month_start(date_col: str | Column = "shipment_date") -> Column:
    """First day of the month, as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(_c(date_col), "MM")


def second_precision_now() -> Column:
    """Current UTC time truncated to whole seconds."""
    return F.date_trunc("second", F.current_timestamp())


def utc_now_text() -> Column:
    """Current UTC time as ``yyyy-MM-dd HH:mm:ss`` text (the loader's stamp format)."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
