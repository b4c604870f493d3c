"""Training histories: best value so far, early stop, latest state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.operators.inventory import latest_by
from geoloom.operators.scans import ranked, running


def numbered_epochs(df: DataFrame, run: str, order: list[Column]) -> DataFrame:
    return ranked(df, [run], order, "epoch")


def progress(epochs: DataFrame, run: str, metric: str, start: float = 0.0) -> DataFrame:
    """Add ``improved`` (strictly above everything before and ``start``) and ``streak``,
    the number of epochs since the last improvement."""
    order = [F.col("epoch")]
    seen = running(epochs, [run], order, {"_best": ("max", F.col(metric))}, inclusive=False)
    seen = seen.withColumn(
        "improved", F.col(metric) > F.greatest(F.coalesce("_best", F.lit(start)), F.lit(start))
    ).drop("_best")
    last = {"_last": ("max", F.when(F.col("improved"), F.col("epoch")).otherwise(F.lit(0)))}
    out = running(seen, [run], order, last)
    return out.withColumn("streak", F.col("epoch") - F.col("_last")).drop("_last")


def early_stops(epochs: DataFrame, run: str, metric: str, patience: int, start: float = 0.0) -> DataFrame:
    """(run, stop_epoch, best_epoch, best): where training ends and what it keeps.

    ``stop_epoch`` is null when patience is never used up.
    """
    p = progress(epochs, run, metric, start)
    # The best epoch kept at the stop is the last improvement, patience epochs earlier.
    first = p.groupBy(run).agg(
        F.min(F.when(F.col("streak") >= patience, F.col("epoch"))).alias("stop_epoch"),
    )
    improved = p.filter("improved").select(run, "epoch", F.col(metric).alias("_m"))
    kept = first.join(improved, run, "left").filter(
        F.col("epoch").isNull() | F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch"))
    )
    return kept.groupBy(run, "stop_epoch").agg(
        F.max("epoch").alias("best_epoch"), F.max("_m").alias("best")
    )


def resume_state(epochs: DataFrame, run: str) -> DataFrame:
    """The last recorded epoch of every run."""
    return latest_by(epochs, [run], "epoch")
