"""Session-level helpers: cutting lineage, reproducible draws."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; make one up only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="geoloom-ckpt-")
    sc.setCheckpointDir(folder)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's checkpoint folder, which all executors see."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it from there.

    Later stages then start from files, whichever executors have been lost since.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that loops do not grow the plan.

    What is read back is planned by the size of its files.  A checkpointed frame would keep
    the size estimate of the plan it came from, which every self-join of a loop squares.
    """
    return stored(df, "round")


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join of which neither side is broadcast, both being shuffled by the key.

    Estimates come from compressed files and know nothing of an explode, so a table of pixels
    may look small enough for the driver.  For joins of tables that grow with the pixels.
    """
    return df.hint("merge")


def slices(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def any_rows(df: DataFrame) -> bool:
    return len(df.take(1)) > 0


def by_size(df: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups with up to ``most`` rows, which a task can hold, and those of larger ones.

    The second is None if there are none.  There are fewer large groups than rows / ``most``,
    so their keys are broadcast.
    """
    crowded = cut(df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(*keys))
    if not any_rows(crowded):
        return df, None
    crowded = F.broadcast(crowded)
    return df.join(crowded, keys, "left_anti"), df.join(crowded, keys, "left_semi")


def seeded(key: Column, seed: int) -> Column:
    """Reproducible random order key that any SQL engine can recompute."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def seeded_int(key: Column, seed: int, below: Column) -> Column:
    """Reproducible integer in ``[0, below)``."""
    word = F.conv(F.substring(seeded(key, seed), 1, 8), 16, 10).cast("bigint")
    return word % below
