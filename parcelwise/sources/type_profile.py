"""Type inference that reports offenders: which types a text column admits, and which values stand in the way.

Spark's own inference turns a whole column to text for one bad value and does
not say which. Here one aggregation over the text counts, per column, the
values that each type admits; ``type_offenders`` lists the values that a
column's leading type does not admit.

Types, narrowest first: int, bigint, decimal (a whole number of up to 38
digits), double, date, timestamp, boolean, string. ``exact_type`` admits every
value (what inference would find), ``leading_type`` at least ``share`` of
them. Missing-value tokens count as missing, not as values; a column without
values is a string column. A number is digits with an optional sign, fraction
and exponent; hexadecimal forms, type suffixes, NaN and infinity are text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.scalar import missing_to_null

TYPES = ("int", "bigint", "decimal", "double", "date", "timestamp", "boolean")
_WHOLE = r"^[+-]?[0-9]{1,38}\z"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?\z"


def _admits(value: Column) -> dict[str, Column]:
    """Per type: whether it admits a value (never NULL for a value that is not)."""
    def cast(to: str) -> Column:
        return value.try_cast(to).isNotNull()

    return {
        "int": value.rlike(_WHOLE) & cast("int"), "bigint": value.rlike(_WHOLE) & cast("bigint"), "decimal": value.rlike(_WHOLE),
        "double": value.rlike(_NUMBER) & cast("double"), "date": value.rlike(_DATE) & cast("date"),
        "timestamp": value.rlike(_TIME) & cast("timestamp"), "boolean": F.lower(value).isin("true", "false"),
    }


def _values(rows: DataFrame) -> DataFrame:
    """One row per column and value; what is not a value is NULL."""
    text = rows.select(*[missing_to_null(c).alias(c) for c in rows.columns])
    return text.unpivot([], rows.columns, "column_name", "value")


def _mask(value: Column) -> Column:
    """The types that admit a value as bits (bit i: type i of TYPES), worked out once.

    Most values are settled by one pattern: a whole number is no date, a date no number, and so on.
    """
    def bit(name: str, test: Column | None = None) -> Column:
        set_ = F.lit(1 << TYPES.index(name))
        return set_ if test is None else F.when(test, set_).otherwise(F.lit(0))

    admits = {t: value.try_cast(t).isNotNull() for t in ("int", "bigint", "double", "date", "timestamp")}
    whole = bit("int", admits["int"]) + bit("bigint", admits["bigint"]) + bit("decimal") + bit("double", admits["double"])
    return (F.when(value.rlike(_WHOLE), whole).when(value.rlike(_NUMBER), bit("double", admits["double"]))
            .when(value.rlike(_DATE), bit("date", admits["date"]) + bit("timestamp", admits["timestamp"]))
            .when(value.rlike(_TIME), bit("timestamp", admits["timestamp"])).when(F.lower(value).isin("true", "false"), bit("boolean")).otherwise(F.lit(0)))


def _narrowest(least: Column) -> Column:
    found = F.coalesce(*[F.when(F.col(f"n_{t}") >= least, t) for t in TYPES], F.lit("string"))
    return F.when(F.col("n_values") == 0, "string").otherwise(found)


def type_profile(rows: DataFrame, share: float = 0.95) -> DataFrame:
    """One row per text column of ``rows``: counts by type, exact and leading type, and the leading type's offenders.

    One scan; partial sums per task leave one row per column to the shuffle. The set of masks is one of few numbers; as a
    collected value it also lets Spark aggregate by hashing, where text minima alone would have it sort every value.
    """
    masked = _values(rows).withColumn("mask", F.when(F.col("value").isNotNull(), _mask(F.col("value"))))
    admits = {t: F.col("mask").bitwiseAND(F.lit(1 << i)) != 0 for i, t in enumerate(TYPES)}
    counted = masked.groupBy("column_name").agg(
        F.count("value").alias("n_values"), (F.count("*") - F.count("value")).alias("n_missing"), F.collect_set("mask").alias("masks"),
        *[F.count_if(a).alias(f"n_{t}") for t, a in admits.items()],
        *[F.min(F.when(~a, F.col("value"))).alias(f"least_{t}") for t, a in admits.items()])
    counted = counted.where(F.size("masks") >= 0)  # keeps the set in the plan
    typed = counted.withColumns({"exact_type": _narrowest(F.col("n_values")), "leading_type": _narrowest(F.col("n_values") * F.lit(share))})
    offenders = F.coalesce(*[F.when(F.col("leading_type") == t, F.col("n_values") - F.col(f"n_{t}")) for t in TYPES], F.lit(0))
    example = F.coalesce(*[F.when(F.col("leading_type") == t, F.col(f"least_{t}")) for t in TYPES])
    return typed.select("column_name", "n_values", "n_missing", *[f"n_{t}" for t in TYPES], "exact_type", "leading_type",
                        offenders.alias("n_offenders"), example.alias("example"))


def type_offenders(rows: DataFrame, profile: DataFrame) -> DataFrame:
    """The distinct values that their column's leading type does not admit, with the rows of each.

    The profile has a row per column and is broadcast.
    """
    leading = F.broadcast(profile.where("n_offenders > 0").select("column_name", "leading_type"))
    values = _values(rows).where("value IS NOT NULL").join(leading, "column_name")
    refused = F.coalesce(*[F.when(F.col("leading_type") == t, ~a) for t, a in _admits(F.col("value")).items()])
    return values.where(refused).groupBy("column_name", "leading_type", "value").agg(F.count("*").alias("n_rows"))
