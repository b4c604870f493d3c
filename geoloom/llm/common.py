"""Shared helpers: stored intermediate tables, Arrow batches, folds, prefix sums."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.runtime import shared_path, stored  # noqa: F401  (operators take them from here)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(df: DataFrame, name: str) -> Column:
    """A column of ``df`` by exact name, also where the name holds dots."""
    return df[f"`{name}`"]


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` has not, in any case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[..., Iterable[tuple]]],
    schema: str,
    rows_per_step: int = 256,
) -> DataFrame:
    """Apply a batch function to lists of column values inside Arrow batches.

    ``make`` runs once per task and returns ``fn(*columns) -> rows``; each call gets at
    most ``rows_per_step`` rows, so memory follows a few texts and not the batch.
    """
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    arrow = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in T.StructType.fromDDL(schema).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_per_step):
                part = batch.slice(at, rows_per_step)
                rows = list(fn(*[part.column(i).to_pylist() for i in range(part.num_columns)]))
                cols = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow
                )

    return df.mapInArrow(run, schema)


def _arrow(t: T.DataType) -> pa.DataType:
    plain = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32(),
    }
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in t.fields])
    return plain[t.simpleString()]


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def prefix_sums(df: DataFrame, at: str, values: dict[str, str], block: int = 1024) -> DataFrame:
    """Add exclusive running sums along the integer column ``at`` (one row for each).

    ``values`` maps a new column to the summed one.  Rows are summed within blocks of
    ``block`` consecutive numbers and the blocks' totals, a thousandth as many rows,
    once more, so no task sorts the whole table.
    """
    rows = df.withColumn("_block", F.expr(f"`{at}` div {block}"))
    totals = rows.groupBy("_block").agg(*[F.sum(v).alias(f"_t_{n}") for n, v in values.items()])
    over = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("_block", *[F.coalesce(F.sum(f"_t_{n}").over(over), F.lit(0)).alias(f"_c_{n}") for n in values])
    inside = Window.partitionBy("_block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_l_{n}") for n, v in values.items()])
    return local.join(carry, "_block").select(
        *df.columns, *[(F.col(f"_c_{n}") + F.col(f"_l_{n}")).cast("bigint").alias(n) for n in values]
    )
