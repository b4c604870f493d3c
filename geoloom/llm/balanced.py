"""Mixing sources to target sizes by cube-method balanced sampling.

A source's target is its weight's share of ``share`` times all words, at most ``most`` times
its own size, the excess going to the others by weight.  Target over size is a rate: every
document of the source is taken floor(rate) times, and once more with the probability that
is left.  Which documents are taken once more is drawn by the cube method under two
constraints a source, words and documents: of three fractional probabilities two equations
leave one direction along which both totals stand still; they move along it, at random to
one of its two ends, until one of them is 0 or 1.

The flight runs in blocks of ``BLOCK`` documents by a hash of the row, each of which leaves
two fractional probabilities at most; what the blocks of a source leave is the next round's
population, a thousandth of the last, until one block is left.  Its last two are the landing
problem: of their four roundings the one that misses the words least is taken, and where a
document more or less or one exchanged for another comes nearer, up to ``EXCHANGES`` times,
that is done: a source of few long documents could miss its target by half a document else.

All draws are hashes of (seed, source, id, size, number among equal rows), so reruns agree
on any cluster.  Null texts have size 0; rows of size 0 take nothing and do not take part.  A
null source is one of its own, the last; null and repeated ids are rows of their own.  Equal
rows are interchangeable and are counted before they are spread.  Extra columns are ignored
and an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import column, stored
from geoloom.operators.scans import ranked, running
from geoloom.runtime import any_rows

# Fixed values.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0

BLOCK = 2048
SEED = 12
COPIES_PER_ROW = 4096
EXCHANGES = 3
_EPS = 1e-9


def sized(docs: DataFrame) -> DataFrame:
    """(source, doc_id, size, copies): equal rows counted."""
    words = F.coalesce(F.regexp_count(column(docs, "text"), F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(
        column(docs, "source").cast("string").alias("source"), column(docs, "doc_id").cast("bigint").alias("doc_id"), words.alias("size")
    )
    return rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies"))


def targets(sized_rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, src, source_size, documents, target): ``src`` numbers the sources by code point, null last."""
    per = sized_rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("copies")).otherwise(0)).alias("documents"),
    )
    numbered = ranked(per, [], [F.col("source").isNull(), F.col("source")], "src")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("src") - 1) % len(weights) + 1).cast("int"))
    numbered = stored(numbered.withColumn("w", weight).withColumn("cap", most * F.col("source_size")), "sources")
    whole = numbered.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s"), F.coalesce(F.sum("w"), F.lit(0.0)).alias("w")).first()
    # By rising cap per weight, the sources that stop at their cap come first: one does if the
    # level that those before it leave to all others is above its own cap per weight.
    filled = running(numbered, [], [F.col("cap") / F.col("w"), F.col("src")], {"c0": ("sum", F.col("cap")), "w0": ("sum", F.col("w"))}, inclusive=False)
    left = F.lit(share * whole["s"]) - F.col("c0")
    filled = stored(filled.withColumn("full", F.col("cap") * (F.lit(whole["w"]) - F.col("w0")) <= left * F.col("w")), "filled-sources")
    rest = filled.agg(
        F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0.0)).alias("c"),
        F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))), F.lit(0.0)).alias("w"),
    ).first()
    level = (share * whole["s"] - rest["c"]) / rest["w"] if rest["w"] else 0.0
    return filled.select("source", "src", "source_size", "documents", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * level).alias("target"))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> list[int]:
    """Move ``p`` (in place) until two fractional entries are left at most; returns those.

    Both sum(p) and sum(p * size) stay as they are, and every entry keeps its expectation.
    """
    live: list[int] = []
    chance = rng.random(len(p))
    for k in range(len(p)):
        if p[k] < _EPS or p[k] > 1 - _EPS:
            p[k] = round(p[k])
            continue
        live.append(k)
        if len(live) < 3:
            continue
        i, j, m = live
        u = (size[j] - size[m], size[m] - size[i], size[i] - size[j])
        if u[0] == 0 and u[1] == 0 and u[2] == 0:
            u = (1.0, -1.0, 0.0)
        up = min(((1 - p[x]) / d if d > 0 else p[x] / -d) for x, d in zip(live, u) if d)
        down = min((p[x] / d if d > 0 else (1 - p[x]) / -d) for x, d in zip(live, u) if d)
        step = up if chance[k] * (up + down) < down else -down
        rest = []
        for x, d in zip(live, u):
            p[x] += step * d
            if p[x] < _EPS or p[x] > 1 - _EPS:
                p[x] = round(p[x])
            else:
                rest.append(x)
        live = rest
    return live


def land(p: np.ndarray, size: np.ndarray, live: list[int], words: float, number: float) -> None:
    """Round the last entries so that ``words``, then ``number``, are missed least; then exchange."""
    fixed = np.ones(len(p), bool)
    fixed[live] = False
    lack, few = words - (p * size)[fixed].sum(), number - p[fixed].sum()
    best = min(
        range(1 << len(live)),
        key=lambda c: (abs(sum(size[x] for b, x in enumerate(live) if c >> b & 1) - lack), abs(c.bit_count() - few), c),
    )
    for b, x in enumerate(live):
        p[x] = best >> b & 1
    for _ in range(EXCHANGES):
        lack = words - (p * size).sum()
        out, into = np.flatnonzero(p < 0.5), np.flatnonzero(p > 0.5)
        out = out[np.argsort(size[out], kind="stable")]
        # Nobody leaves or enters: index -1 and size 0.
        leave, enter = np.append(into, -1), np.append(-1, out)
        left, entered = np.append(size[into], 0.0), np.append(0.0, size[out])
        at = np.searchsorted(entered, left + lack)
        near = np.stack([np.maximum(at - 1, 0), np.minimum(at, len(entered) - 1)])
        miss = np.abs(entered[near] - left - lack)
        side, i = np.unravel_index(np.argmin(miss), miss.shape)
        if miss[side, i] >= abs(lack) - _EPS:
            break
        for x, value in ((leave[i], 0.0), (enter[near[side, i]], 1.0)):
            if x >= 0:
                p[x] = value


def _moved(population: DataFrame, block: int, seed: int, step: int) -> DataFrame:
    """One round of flights; the only block of a source lands."""
    per = population.groupBy("src").agg(F.ceil(F.count("*") / block).cast("bigint").alias("blocks"))
    blocked = population.join(per, "src").withColumn("block", F.pmod(F.xxhash64("draw", F.lit(step)), "blocks"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["draw", "doc_id", "size", "copy"], kind="stable")
        p, size = g["p"].to_numpy().copy(), g["size"].to_numpy().astype(float)
        rng = np.random.default_rng([seed, step, int(g["src"].iat[0]), int(g["block"].iat[0])])
        words, number = (p * size).sum(), p.sum()
        live = flight(p, size, rng)
        if g["blocks"].iat[0] == 1:
            land(p, size, live, words, number)
        return g.assign(p=p)[["src", "doc_id", "size", "copy", "draw", "base", "p"]]

    schema = "src bigint, doc_id bigint, size bigint, copy bigint, draw bigint, base bigint, p double"
    return blocked.groupBy("src", "block").applyInPandas(run, schema)


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, block: int = BLOCK
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, times): a row per document and how often it is taken."""
    rows = stored(sized(docs), "sizes")
    goals = stored(targets(rows, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Equal rows are spread by number, a few thousand at a time.
    spread = (
        rows.join(goals.select(F.col("source").alias("of"), "src", rate.alias("rate")), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("_from", F.explode(F.expr(f"sequence(0L, copies - 1, {COPIES_PER_ROW}L)")))
        .withColumn("copy", F.explode(F.expr(f"sequence(_from, least(copies, _from + {COPIES_PER_ROW}) - 1)")))
    )
    whole = F.floor(F.col("rate") + _EPS)
    drawn = spread.select(
        "src", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "size", "copy",
        whole.cast("bigint").alias("base"), F.greatest(F.lit(0.0), F.col("rate") - whole).alias("p"),
    ).withColumn("draw", F.xxhash64(F.lit(seed), "src", "doc_id", "no_id", "size", "copy"))
    drawn = stored(drawn.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id"), "probabilities")
    open_ = (F.col("p") > _EPS) & (F.col("size") > 0)
    settled = [drawn.filter(~open_).withColumn("p", F.lit(0.0))]
    population, step = drawn.filter(open_), 0
    while any_rows(population):
        moved = stored(_moved(population, block, seed, step), "flight")
        fractional = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(moved.filter(~fractional))
        population, step = moved.filter(fractional), step + 1
    done = settled[0]
    for part in settled[1:]:
        done = done.unionByName(part)
    times = (F.col("base") + F.round("p")).cast("bigint")
    return done.join(goals.select("src", "source", "source_size", "target"), "src").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), "source", times.alias("times"),
    )
