"""Incremental batch work over files arriving in a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def process_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    work: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    pattern: str = "*.parquet",
    files_per_batch: int = 100,
) -> None:
    """Run ``work`` on the files not seen before and append its rows below ``out``.

    The stream lists arriving files by path and length only and remembers them in
    ``checkpoint``; ``availableNow`` takes what is there and stops.  A batch's files are
    read together; if one of them is broken, each is read by itself.  A file is taken whole
    or not at all: what cannot be read goes to ``<out>_failed`` with its reason and work
    continues.  Rows carry their file in ``source_file``.  A batch that is repeated after a
    failure replaces its own folders, so results are written once.
    """
    arriving = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch).load(source).select("path")
    )

    def read(paths: list[str]) -> DataFrame:
        rows = spark.read.schema(schema).option("ignoreCorruptFiles", "false").parquet(*paths)
        return work(rows.withColumn("source_file", F.col("_metadata.file_path")))

    def write(batch: DataFrame, batch_id: int) -> None:
        # At most ``files_per_batch`` paths.
        paths = sorted(r["path"] for r in batch.collect())
        to = f"{out}/batch_id={batch_id}"
        try:
            read(paths).write.mode("overwrite").parquet(to)
            return
        except Exception:  # noqa: BLE001 - which file it was is found out below
            pass
        good, failed = [], []
        for path in paths:
            try:
                read([path]).write.mode("overwrite").format("noop").save()
                good.append(path)
            except Exception as e:  # noqa: BLE001
                failed.append((path, str(e).splitlines()[0][:500]))
        if good:
            read(good).write.mode("overwrite").parquet(to)
        bad = spark.createDataFrame(failed, "path string, reason string")
        bad.write.mode("overwrite").parquet(f"{out}_failed/batch_id={batch_id}")

    query = (
        arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def file_status(files: DataFrame, results: DataFrame) -> DataFrame:
    """(path, status): ``ok`` for files with results, ``failed`` for the rest."""
    done = results.select(F.col("source_file").alias("path")).distinct().withColumn("ok", F.lit(True))
    return files.join(done, "path", "left").select("path", F.when(F.col("ok"), "ok").otherwise("failed").alias("status"))
