"""Nearest neighbours by several shifted Hilbert orderings.

Equal vectors are one point with its smallest ids.  Points are projected to a few
dimensions, differently for each curve, shifted, and ordered along a Hilbert curve; Spark
range-partitions each ordering and gives every point its rank.  A query looks at the blocks
of ranks around its own on every curve; each block's task computes the distances to the
queries that look at it and keeps the nearest, exact distances being taken from the
original vectors.  The curves' answers are merged.

How far a query looks, as a share of all ranks, is fitted: the least of ``SHARES`` at which
the union of the windows holds ``RECALL`` of the true neighbours within a sample of
``SAMPLE`` points.  Data with few real dimensions needs narrow windows.  For data spread
evenly over many dimensions no ordering is selective and the windows come out wide; should
nothing less than all ranks do, one curve is scanned whole.

Vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, neither do rows without an id.  Ties in distance go to the smaller
id.  Repeated ids with equal vectors count once.  Fewer candidates than asked for give all
of them, an empty table none; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.common import column, stored
from geoloom.operators.scans import ranked

CURVES, DIMENSIONS, DEPTH = 4, 8, 7
SAMPLE, SAMPLE_QUERIES, RECALL = 4096, 128, 0.95
SHARES = (1 / 64, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4, 1.0)
BLOCK, QUERY_SPAN = 2048, 65_536
SALTS = 64


def hilbert(cells: np.ndarray, depth: int) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (n, d) with ``depth`` bits each (Skilling, 2004)."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (depth - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[i] ^= np.where(high, 0, swap)
            x[0] ^= np.where(high, p, swap)
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (depth - 1)
    while q > 1:
        t ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(depth - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


@dataclass
class Index:
    """Per curve: a projection, and the lowest cell edge and width in each projected dimension."""

    axes: list[np.ndarray]
    low: list[np.ndarray]
    width: list[np.ndarray]
    share: float

    def keys(self, x: np.ndarray, curve: int) -> np.ndarray:
        cells = np.floor((x @ self.axes[curve] - self.low[curve]) / self.width[curve])
        return hilbert(cells.clip(0, (1 << DEPTH) - 1), DEPTH)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances by the product form, good enough to pick candidates."""
    return np.maximum(0, (queries**2).sum(1)[:, None] + (points**2).sum(1) - 2 * queries @ points.T)


def fit(sample: np.ndarray, k: int, curves: int = CURVES, recall: float = RECALL, seed: int = 42) -> Index:
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    index = Index([], [], [], 1.0)
    for _ in range(curves):
        axes, _ = np.linalg.qr(rng.normal(size=(d, min(d, DIMENSIONS))))
        y = sample @ axes
        low, high = y.min(0), y.max(0)
        width = np.maximum((high - low) * 1.25 / (1 << DEPTH), 1e-12)
        index.axes.append(axes)
        index.width.append(width)
        index.low.append(low - rng.random(axes.shape[1]) * width * (1 << DEPTH) * 0.2)
    n = len(sample)
    asked = rng.permutation(n)[:SAMPLE_QUERIES]
    near = np.argsort(distances(sample[asked], sample), axis=1, kind="stable")[:, : k + 1]
    gap = np.full(near.shape, n)
    for c in range(curves):
        rank = np.empty(n, dtype=np.int64)
        rank[np.argsort(index.keys(sample, c), kind="stable")] = np.arange(n)
        gap = np.minimum(gap, np.abs(rank[near] - rank[asked][:, None]))
    index.share = next((s for s in SHARES if (gap <= s * n / 2).mean() >= recall), 1.0)
    if index.share == 1.0:
        index = Index(index.axes[:1], index.low[:1], index.width[:1], 1.0)
    return index


def points(vectors: DataFrame, keep: int) -> DataFrame:
    """(gid, vec, ids): distinct usable vectors, their smallest id and ``keep`` smallest ids."""
    rows = vectors.select(column(vectors, "vec_id").cast("bigint").alias("vec_id"), column(vectors, "embedding").alias("vec"))
    finite = "vec_id is not null and vec is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vec, x -> x != 0)"
    usable = rows.filter(finite).distinct()
    usual = usable.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    usable = usable.filter(F.size("vec") == (usual["d"] if usual else 0))
    # A vector that very many rows share is ranked in parts, each of which sends few ids on.
    part = Window.partitionBy("vec", "salt").orderBy("vec_id")
    whole = Window.partitionBy("vec").orderBy("vec_id")
    few = usable.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).withColumn("rn", F.row_number().over(part)).filter(F.col("rn") <= keep)
    few = few.select("vec", "vec_id").withColumn("rn", F.row_number().over(whole)).filter(F.col("rn") <= keep)
    return few.groupBy("vec").agg(F.min("vec_id").alias("gid"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def search(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` that satisfy the column ``is_query``."""
    spark = vectors.sparkSession
    pts = stored(points(vectors, k + 1), "points")
    asked = vectors.filter(is_query).select(column(vectors, "vec_id").cast("bigint").alias("query_id"), column(vectors, "embedding").alias("vec")).distinct()
    asked = stored(asked.join(pts.select("vec", "gid"), "vec").select("query_id", "gid"), "queries")
    sample = pts.orderBy(F.xxhash64("gid"), "gid").limit(SAMPLE).select("vec").toPandas()["vec"]
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index = fit(_matrix(sample), k)
    n, curves = pts.count(), len(index.axes)
    reach = int(np.ceil(index.share * n / 2)) if index.share < 1 else n

    @F.pandas_udf("array<bigint>")
    def keys(vecs: pd.Series) -> pd.Series:
        x = _matrix(vecs)
        return pd.Series(list(np.stack([index.keys(x, c) for c in range(curves)], axis=1)))

    laid = pts.select("gid", "vec", F.posexplode(keys("vec")).alias("curve", "key"))
    laid = ranked(laid, ["curve"], [F.col("key"), F.col("gid")]).withColumn("rn", F.col("rn") - 1)
    laid = stored(laid.select("curve", "gid", "vec", "rn"), "orderings")
    last = (n - 1) // BLOCK
    wanted = (
        laid.join(asked.select("gid").distinct(), "gid", "left_semi")
        .withColumn("span", F.expr(f"rn div {QUERY_SPAN}"))
        .withColumn("block", F.explode(F.expr(f"sequence(greatest(0L, rn - {reach}L) div {BLOCK}, least({last}L, (rn + {reach}L) div {BLOCK}))")))
        .select("curve", "block", "span", "gid", "vec")
    )
    # Each block is sent once to every span of queries that looks at it; a task holds one block and one span.
    spans = wanted.select("curve", "block", "span").distinct()
    blocks = laid.withColumn("block", F.expr(f"rn div {BLOCK}")).join(spans, ["curve", "block"])
    blocks = blocks.select(*[F.col(c).alias(f"p_{c}") for c in ("curve", "block", "span", "gid", "vec")])

    def nearest(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"qid": [], "gid": [], "d": []}).astype({"qid": "int64", "gid": "int64", "d": "float64"})
        qx, px, gids, qids = _matrix(q["vec"]), _matrix(p["p_vec"]), p["p_gid"].to_numpy(), q["gid"].to_numpy()
        m = min(len(px), 3 * (k + 1))
        out = []
        for i in range(0, len(qx), 256):
            block = qx[i : i + 256]
            pick = np.argpartition(distances(block, px), m - 1, axis=1)[:, :m]
            exact = np.sqrt(((px[pick] - block[:, None, :]) ** 2).sum(2))
            order = np.lexsort((gids[pick], exact), axis=1)[:, : k + 1]
            out.append(pd.DataFrame({
                "qid": np.repeat(qids[i : i + 256], order.shape[1]),
                "gid": np.take_along_axis(gids[pick], order, 1).ravel(), "d": np.take_along_axis(exact, order, 1).ravel(),
            }))
        return pd.concat(out)

    key = ["curve", "block", "span"]
    found = wanted.groupBy(*key).cogroup(blocks.groupBy(*[f"p_{c}" for c in key])).applyInPandas(nearest, "qid bigint, gid bigint, d double")
    found = found.groupBy("qid", "gid").agg(F.min("d").alias("d"))
    by_query = Window.partitionBy("qid").orderBy("d", "gid")
    found = found.withColumn("rn", F.row_number().over(by_query)).filter(F.col("rn") <= k + 1)
    ids = found.join(pts.select("gid", "ids"), "gid").select("qid", "d", F.explode("ids").alias("vec_id"))
    ids = ids.withColumn("rn", F.row_number().over(Window.partitionBy("qid").orderBy("d", "vec_id"))).filter(F.col("rn") <= k + 1)
    lists = ids.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("d", "vec_id"))).alias("near"))
    own = asked.join(lists, asked["gid"] == lists["qid"])
    top = own.select("query_id", F.posexplode(F.expr(f"slice(filter(near, e -> e.vec_id != query_id), 1, {k})")).alias("pos", "e"))
    return top.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.d").alias("score"))
