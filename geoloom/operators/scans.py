"""Ranks and running aggregates that do not gather a partition in one task.

A window with few (or no) partition keys sorts each key's rows in one task.
Here rows are range partitioned on (keys, order), so one key spreads over many
slices; each slice is scanned by itself and the totals of the slices before it,
a table of slices rather than rows, are added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.runtime import cut, slices


def _sliced(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows with the number of the range slice they fall in.

    The sample behind a range partitioning may differ between two runs of a plan,
    so the slice numbers are materialised before anything is computed from them.
    """
    n = slices(df.sparkSession)
    ranged = df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
    return cut(ranged.withColumn("_slice", F.spark_partition_id()))


def _combine(fn: str, a: Column, b: Column) -> Column:
    if fn == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return F.greatest(a, b)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    scans: dict[str, tuple[str, Column]],
    inclusive: bool = True,
) -> DataFrame:
    """Add running ``sum`` or ``max`` columns along ``order`` within ``keys``.

    ``scans`` maps a new column to ``(fn, value)``; ``inclusive=False`` leaves the
    current row out.  To scan from the last row back, pass the opposite order: a frame
    that ends at the last row would be summed up anew for every row.
    """
    agg: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "max": F.max}
    base = _sliced(df, keys, order)
    for name, (_, value) in scans.items():
        base = base.withColumn(f"_v_{name}", value)

    before = (Window.unboundedPreceding, -1)
    until = (Window.unboundedPreceding, 0)

    totals = base.groupBy(*keys, "_slice").agg(
        *[agg[fn](f"_v_{n}").alias(f"_t_{n}") for n, (fn, _) in scans.items()]
    )
    over_slices = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*before)
    carry = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_slice").alias("_k_slice"),
        *[agg[fn](f"_t_{n}").over(over_slices).alias(f"_c_{n}") for n, (fn, _) in scans.items()],
    )
    on = F.col("_slice") == F.col("_k_slice")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))

    inside = Window.partitionBy("_slice", *keys).orderBy(*order)
    inside = inside.rowsBetween(*(until if inclusive else before))
    local = base.select(
        "*", *[agg[fn](f"_v_{n}").over(inside).alias(f"_l_{n}") for n, (fn, _) in scans.items()]
    )
    joined = local.join(carry, on, "left")
    return joined.select(
        *df.columns,
        *[_combine(fn, F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n) for n, (fn, _) in scans.items()],
    )


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn") -> DataFrame:
    """``row_number`` within ``keys`` along ``order``, spread over range slices."""
    return running(df, keys, order, {name: ("sum", F.lit(1).cast("bigint"))})
