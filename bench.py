"""Headline queries timed on one machine; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query runs twice to a no-op sink: ``queries`` has the first (cold) run, ``warm`` the
second.  The first query also pays for starting Spark, so one small query runs before the
clock.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from geoloom.plans.queries import QUERIES

HEADLINE = [
    "seg_class_metrics", "tri_loss", "file_inventory", "roof_labels", "fg_tiles", "reflect_pad", "rescale_u8",
    "area_resize", "blend_overlap", "predict_tiles", "clean_mask", "region_vectors", "burn_coverage",
    "spatial_join_blocks", "box_iou_join", "soft_nms", "ap50", "map_coco", "centred_tiles", "negative_tiles", "preprocess_totals",
    "split_holdout", "early_stop", "cutmix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["batch_status"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    cold, warm = {}, {}
    for name in names:
        for seconds in (cold, warm):
            t = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - t, 3)
        print(f"{name} {cold[name]} {warm[name]}", file=sys.stderr, flush=True)
    total = round(sum(cold.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": cold, "warm": warm,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
