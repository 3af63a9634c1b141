"""First-n sample of an output, deterministic.

``orderBy(..).limit(n)`` plans as a top-k (TakeOrderedAndProject): each task
keeps its n best rows and only those reach the final merge, so the sample
never gathers a whole table anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise import schema as S


def first_rows(df: DataFrame, n: int = S.SAMPLE_ROWS, order: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows under a total order (all columns, nulls first, by default)."""
    keys = list(order) if order is not None else df.columns
    return df.orderBy(*[F.asc_nulls_first(c) for c in keys]).limit(n)
