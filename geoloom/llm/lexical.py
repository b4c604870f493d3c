"""Ranked lexical search with per-term geometric blocking.

Every document gets a code of ``depth`` bits: on which sides of random hyperplanes its vector
of term weights lies, seen from the mean document.  Documents with a common prefix of codes
are alike, so prefixes are nested clusters.  A term's posting list is cut into blocks by the
prefix length at which a block holds about ``POSTINGS`` of *its* postings: rare terms have few
wide blocks, frequent ones many narrow ones.  The summary of a block is the coordinatewise
maximum over the documents of its cluster: a term's greatest contribution to any score.

A search of an item runs in three steps.  (1) The clusters of the greatest bounds, the bound
of a cluster being the sum of its summary over the item's terms, are scored, at most
``SEEDS`` documents each: the k-th score found is a floor that the k-th best cannot be below.
(2) Terms whose greatest contributions together stay below the floor cannot lift a document
to it on their own, so their lists are not opened.  Blocks of the other lists are skipped
only if their bound is below the floor.  (3) The documents of the remaining blocks are scored
with all their terms.  Bounds and scores are the same whole numbers, so nothing that belongs
to the result is ever skipped; the number of seeds changes the work and not the result.

A cluster's summary is one row, so its bounds for all items are sums over one array.  A block
that is kept is opened by the narrowest clusters in it that hold the term, and those whose own
bound is below the floor are skipped as well.  Documents meet them by their code; codes that
hold more than a ``CROWD``-th of all documents are dealt by row as well.

Postings are kept for the terms of the items; lengths, totals and frequencies count all
terms of all documents.  Items are searched in batches of ``MOST_TERMS`` terms (or one item),
which bounds what a task holds of the vocabulary.

Null and empty texts have no terms: such documents are in no result and such items have
none.  Repeated rows are documents of their own, also in one result, in no stated order if
they share score and id; null ids come last among equal scores.  Repeated items are searched
each by itself.  Extra columns are ignored, empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.common import column, map_rows, stored
from geoloom.operators.scans import running

# Fixed values.
TOP = 50
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A term's bytes in UTF-8: capitals of ASCII as small letters, what stands in no term as a blank.
_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()

BLOCK = 64  # documents of a narrowest cluster, on average
POSTINGS = 32  # of a list's block, on average
DEEPEST = 24
LEVELS = 3  # bits between the prefix lengths that have summaries
SEEDS, SEED_CLUSTERS = 1024, 4
MOST_TERMS = 200_000
CROWD = 256


def split(text: str | None) -> list[bytes]:
    return text.encode().translate(_BYTES).split() if text else []


def terms(text: str | None) -> list[str]:
    return [t.decode() for t in split(text)]


# -- items and counts ---------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """(q, item_id, terms): items with terms, their distinct terms, and a number for each row."""

    def make():
        return lambda ids, texts: [(i, t) for i, t in zip(ids, (sorted(set(terms(x))) for x in texts)) if t]

    found = map_rows(
        items.select(column(items, "item_id").alias("item_id"), column(items, "text").alias("text")), make,
        f"item_id {dict(items.dtypes)['item_id']}, terms array<string>",
    )
    return stored(found.withColumn("q", F.monotonically_increasing_id()), "items")


def counted(docs: DataFrame, number: dict[str, int]) -> DataFrame:
    """(row, doc_id, n, ids, tfs): documents with terms, how many, and the numbered terms among them."""

    def make():
        get = {t.encode(): i for t, i in number.items()}.get

        def rows(doc_ids, texts):
            for d, text in zip(doc_ids, texts):
                found = split(text)
                if found:
                    tf = Counter(map(get, found))
                    tf.pop(None, None)
                    yield d, len(found), list(tf), list(tf.values())

        return rows

    found = map_rows(
        docs.select(column(docs, "doc_id").cast("bigint").alias("doc_id"), column(docs, "text").alias("text")), make,
        "doc_id bigint, n bigint, ids array<int>, tfs array<bigint>",
    )
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "term-counts")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def placed(counts: DataFrame, weights: np.ndarray, shares: np.ndarray, shifts: np.ndarray, documents: int, length: int, depth: int, seed: int = 11) -> DataFrame:
    """(row, doc_id, code, ids, parts, nodes, gains): contributions of the terms, the code, each term's block.

    A part is the term's weight times the gain, which is a million at most.
    """

    def make():
        planes = np.random.default_rng(seed).standard_normal((len(weights), max(depth, 1)), dtype=np.float32)
        mean = (shares * weights) @ planes
        usual = float(shares @ weights) or 1.0
        bits = 1 << np.arange(max(depth, 1))[::-1]

        def rows(row, doc_id, n, ids, tfs):
            for r, d, m, i, tf in zip(row, doc_id, n, ids, tfs):
                i, tf = np.array(i, dtype=np.int64), np.array(tf, dtype=np.int64)
                w = weights[i]
                norm = 50 + (50 * m * documents) // length
                gains = (1_000_000_000 * tf) // (1000 * tf + 20 * norm)
                parts = w * gains
                code = 0
                if depth:
                    code = int((w @ planes[i] > mean * (float(w.sum()) / usual)) @ bits)
                yield r, d, code, i.tolist(), parts.tolist(), (code >> shifts[i]).tolist(), gains.tolist()

        return rows

    return map_rows(
        counts.select("row", "doc_id", "n", "ids", "tfs"), make,
        "row bigint, doc_id bigint, code int, ids array<int>, parts array<bigint>, nodes array<int>, gains array<int>",
    )


def summaries(postings: DataFrame, levels: list[int]) -> DataFrame:
    """(shift, node, id, top): the greatest contribution of a term in each cluster that has it.

    Each level is rolled up from the one below, which has fewer rows than postings already.
    """
    each = postings.select("code", F.explode(F.arrays_zip("ids", "parts")).alias("p"))
    now = each.groupBy(F.col("code").alias("node"), F.col("p.ids").alias("id")).agg(F.max("p.parts").alias("top"))
    out = [stored(now.withColumn("shift", F.lit(levels[0])), "summaries")]
    for low, high in zip(levels, levels[1:]):
        now = out[-1].groupBy(F.shiftright("node", high - low).alias("node"), "id").agg(F.max("top").alias("top"))
        out.append(stored(now.withColumn("shift", F.lit(high)), "summaries"))
    return reduce(DataFrame.unionByName, out)


class Items:
    """The items of a batch by position: terms end to end, weights of the terms, floors, open lists."""

    def __init__(self, numbers: list[int], wants: list[list[int]], weights: np.ndarray):
        self.numbers = np.array(numbers, dtype=np.int64)
        self.wants = [np.array(w, dtype=np.int64) for w in wants]
        self.floors = np.ones(len(wants), dtype=np.int64)
        self.weights, self.known = weights, len(weights)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # shift: positions, term numbers

    def laid(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers of the items at these positions end to end, and where each item begins."""
        wants = [self.wants[i] for i in at]
        return np.concatenate(wants), np.cumsum([0, *map(len, wants[:-1])])

    def open(self, greatest: np.ndarray, shifts: np.ndarray) -> None:
        """Lists that a result must appear in one of: the least ones, together below the floor, stay shut."""
        found: dict[int, list[tuple[int, int]]] = {}
        for at, want in enumerate(self.wants):
            order = want[np.lexsort((want, greatest[want]))]
            for i in order[np.cumsum(greatest[order]) >= self.floors[at]]:
                found.setdefault(int(shifts[i]), []).append((at, int(i)))
        self.lists = {s: tuple(np.array(x, dtype=np.int64) for x in zip(*pairs)) for s, pairs in found.items()}


def packed(positions: np.ndarray) -> bytes:
    return np.asarray(positions, dtype="<i4").tobytes()


def scored(asked: DataFrame, items: Items) -> DataFrame:
    """(q, row, doc_id, score) of the documents' items ``qs`` where the score reaches the item's floor.

    ``asked`` has row, doc_id, ids, parts (gains) and qs, packed positions.  A document's contributions
    are laid out by term number once and summed over all its items' numbers at a time.
    """

    def make():
        # Longs on Python's side: one item's score stays far below 2 ** 63.
        line = np.zeros(items.known, dtype=np.int64)
        seen: dict[bytes, tuple] = {}

        def layout(qs):
            if qs not in seen:
                at = np.frombuffer(qs, dtype="<i4")
                flat, starts = items.laid(at)
                # Some 32 MB of layouts stay at hand.
                if len(seen) * max(len(flat), 1) > 4_000_000:
                    seen.clear()
                seen[qs] = at, flat, starts, items.floors[at]
            return seen[qs]

        def rows(row, doc_id, ids, parts, qs):
            for r, d, i, p, asked_items in zip(row, doc_id, ids, parts, qs):
                at, flat, starts, floors = layout(asked_items)
                i = np.array(i, dtype=np.int64)
                line[i] = items.weights[i] * p
                scores = np.add.reduceat(line[flat], starts)
                line[i] = 0
                for j in np.flatnonzero(scores >= floors):
                    yield int(items.numbers[at[j]]), r, d, int(scores[j])

        return rows

    return map_rows(asked.select("row", "doc_id", "ids", "parts", "qs"), make, "q bigint, row bigint, doc_id bigint, score bigint")


# -- search ------------------------------------------------------------------------------------


def _floors(postings: DataFrame, clusters: DataFrame, items: Items, shift: int, k: int) -> dict[int, int]:
    """Item number to a score that ``k`` documents reach at least; items with too few seeds have none."""

    def make():
        line = np.zeros(items.known, dtype=np.int64)
        flat, starts = items.laid(np.arange(len(items.wants)))

        def rows(nodes, ids, tops):
            # Of some clusters at a time only the best of each part goes on.
            best: dict[int, tuple] = {}
            for node, i, t in zip(nodes, ids, tops):
                line[i] = items.weights[i] * t
                bound = np.add.reduceat(line[flat], starts)
                line[i] = 0
                g = node % SEED_CLUSTERS
                top, where = best.setdefault(g, (np.zeros(len(starts), dtype=np.int64), np.full(len(starts), -1)))
                better = bound > top
                top[better], where[better] = bound[better], node
            for g, (top, where) in best.items():
                for at in np.flatnonzero(where >= 0):
                    yield int(at), g, int(where[at]), int(top[at])

        return rows

    bounds = map_rows(clusters.filter(F.col("shift") == shift).select("node", "ids", "tops"), make, "at int, g int, node int, bound bigint")
    best = bounds.groupBy("at", "g").agg(F.max_by("node", F.struct("bound", "node")).alias("node"))
    seeds: dict[int, list[int]] = {}
    for r in best.toLocalIterator():  # SEED_CLUSTERS rows an item at most
        seeds.setdefault(r["node"], []).append(r["at"])
    spark = postings.sparkSession
    seed = spark.createDataFrame([(n, packed(sorted(at))) for n, at in seeds.items()], "node int, qs binary")
    cluster = F.shiftright("code", shift)
    sizes = postings.groupBy(cluster.alias("node")).agg(F.ceil(F.count("*") / SEEDS).alias("shares"))
    # Bounded like the items: a node for each seed.  Of an overfull cluster a share of the documents will do: any k scores give a floor.
    chosen = F.broadcast(stored(seed.join(sizes, "node"), "seeds"))
    some = postings.withColumn("node", cluster).join(chosen, "node").filter("pmod(xxhash64(row), shares) = 0")
    kth = F.get(F.sort_array(F.collect_list("score"), asc=False), k - 1)
    found = scored(some, items).groupBy("q").agg(kth.alias("floor")).filter("floor is not null")
    return dict(tuple(r) for r in found.toLocalIterator())


def _listed(items: Items) -> dict[int, tuple]:
    """By shift: positions with open lists, their terms laid out, floors, and the owner and term of each list."""
    plan = {}
    for s, (owner, listed) in items.lists.items():
        at, own = np.unique(owner, return_inverse=True)
        plan[s] = at, *items.laid(at), items.floors[at], own, listed
    return plan


def kept_blocks(clusters: DataFrame, items: Items) -> DataFrame:
    """(shift, node, qs): the items with an open list whose block there has a bound that reaches the floor."""

    def make():
        line = np.zeros(items.known, dtype=np.int64)
        plan = _listed(items)

        def rows(shift, nodes, ids, tops):
            for s, node, i, t in zip(shift, nodes, ids, tops):
                at, flat, starts, floors, own, listed = plan[s]
                line[i] = items.weights[i] * t
                reached = np.add.reduceat(line[flat], starts) >= floors
                hit = (line[listed] > 0) & reached[own]
                line[i] = 0
                if hit.any():
                    yield s, node, packed(at[np.unique(own[hit])])

        return rows

    some = clusters.filter(F.col("shift").isin(sorted(items.lists))).select("shift", "node", "ids", "tops")
    return stored(map_rows(some, make, "shift int, node int, qs binary"), "kept-blocks")


def opened(clusters: DataFrame, kept: DataFrame, items: Items) -> DataFrame:
    """(code, qs): the narrowest clusters that kept blocks lead to, with the items whose floor they can reach."""
    narrow = clusters.filter("shift = 0").select(F.col("node").alias("code"), "ids", "tops")
    shifts = F.array(*[F.lit(s).cast("int") for s in sorted(items.lists)]).cast("array<int>")
    above = narrow.select("code", F.explode(shifts).alias("shift")).withColumn("node", F.expr("shiftright(code, shift)"))
    blocks = above.join(kept, ["shift", "node"]).groupBy("code").agg(F.collect_list("shift").alias("at"), F.collect_list("qs").alias("qs"))

    def make():
        line = np.zeros(items.known, dtype=np.int64)
        plan = _listed(items)
        everyone, starts = items.laid(np.arange(len(items.wants)))

        def rows(codes, ids, tops, at, qs):
            for code, i, t, levels, kept_qs in zip(codes, ids, tops, at, qs):
                line[i] = items.weights[i] * t
                reached = np.add.reduceat(line[everyone], starts) >= items.floors
                found = np.zeros(len(reached), dtype=bool)
                for s, packed_qs in zip(levels, kept_qs):
                    known = np.zeros(len(reached), dtype=bool)
                    known[np.frombuffer(packed_qs, dtype="<i4")] = True
                    who, _, _, _, own, listed = plan[s]
                    owner = who[own]
                    found[owner[(line[listed] > 0) & known[owner] & reached[owner]]] = True
                line[i] = 0
                if found.any():
                    yield code, packed(np.flatnonzero(found))

        return rows

    return stored(map_rows(narrow.join(blocks, "code").select("code", "ids", "tops", "at", "qs"), make, "code int, qs binary"), "opened")


def _none(items: DataFrame) -> DataFrame:
    return items.filter("false").selectExpr("item_id", "0 as rank", "0L as doc_id", "0L as score")


def _search(docs: DataFrame, items: DataFrame, k: int, block: int) -> DataFrame:
    """Results of one batch of items, whose terms and floors the driver and the tasks hold."""
    vocabulary = [r[0] for r in items.select(F.explode("terms").alias("t")).distinct().orderBy("t").toLocalIterator()]
    number = {t: i for i, t in enumerate(vocabulary)}
    counts = counted(docs, number)
    documents, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for i, c in counts.select(F.explode("ids").alias("i")).groupBy("i").count().toLocalIterator():
        df[i] = c
    weights = np.array([weight(documents, int(x)) for x in df], dtype=np.int64)
    depth = min(DEEPEST, max(0, math.ceil(math.log2(max(documents, 1) / block))))
    levels = list(range(0, depth + LEVELS, LEVELS))
    # The prefix that leaves a term's blocks about ``POSTINGS`` postings each.
    wide = [depth - max(0, math.ceil(math.log2(max(int(x), 1) / POSTINGS))) for x in df]
    shifts = np.array([min(levels[-1], -(-max(s, 0) // LEVELS) * LEVELS) for s in wide], dtype=np.int64)
    index = placed(counts, weights, df / max(documents, 1), shifts, documents, max(length, 1), depth)
    # Gains are half as wide as parts, and their maxima are those of the parts.
    postings = stored(index.select("row", "doc_id", "code", "ids", F.col("gains").alias("parts")), "postings")
    tops = summaries(postings, levels)
    both = F.collect_list(F.struct("id", "top"))
    clusters = tops.groupBy("shift", "node").agg(both.alias("b")).select("shift", "node", F.col("b.id").alias("ids"), F.col("b.top").alias("tops"))
    clusters = stored(clusters, "clusters")

    wants = {r["q"]: [number[t] for t in r["terms"]] for r in items.select("q", "terms").toLocalIterator()}
    batch = Items(list(wants), list(wants.values()), weights)
    if not wants:
        return _none(items)
    seed_shift = next((s for s in levels if block << s >= 2 * k), levels[-1])
    floors = _floors(postings, clusters, batch, seed_shift, k)
    batch.floors = np.array([floors.get(q, 1) for q in wants], dtype=np.int64)
    greatest = np.zeros(len(vocabulary), dtype=np.int64)
    for i, top in tops.filter(F.col("shift") == levels[-1]).groupBy("id").agg(F.max("top")).toLocalIterator():
        greatest[i] = top * weights[i]
    batch.open(greatest, shifts)
    if not batch.lists:  # No document has a score above 0.
        return _none(items)
    chosen = opened(clusters, kept_blocks(clusters, batch), batch)

    # Fewer than ``CROWD`` codes hold more than such a share of the rows.
    crowds = [r[0] for r in postings.groupBy("code").count().filter(F.col("count") * CROWD > documents).select("code").collect()]
    crowded = F.col("code").isin(crowds) if crowds else F.lit(False)
    parts = F.when(crowded, F.sequence(F.lit(0), F.lit(CROWD // 4 - 1))).otherwise(F.array(F.lit(0)))
    dealt = F.when(crowded, F.pmod(F.xxhash64("row"), F.lit(CROWD // 4)).cast("int")).otherwise(0)
    asked = postings.select("row", "doc_id", "code", "ids", "parts", dealt.alias("deal"))
    found = scored(asked.join(chosen.withColumn("deal", F.explode(parts)), ["code", "deal"]), batch)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(items.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block: int = BLOCK, most_terms: int = MOST_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents."""
    numbered = item_terms(items)
    before = running(numbered, [], [F.col("q")], {"before": ("sum", F.size("terms").cast("bigint"))}, inclusive=False)
    batched = stored(before.withColumn("batch", F.expr(f"before div {most_terms}")), "item-batches")
    batches = sorted(r[0] for r in batched.select("batch").distinct().toLocalIterator())
    results = [stored(_search(docs, batched.filter(F.col("batch") == b), k, block), "ranked") for b in batches]
    if not results:
        return _search(docs, batched, k, block)
    return reduce(DataFrame.unionByName, results)


_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{_RE}')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
dn AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
tot AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM dn),
q AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS t FROM benchmark WHERE text IS NOT NULL),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM dn) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, tot GROUP BY t, nn),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * n * nn) // ll) AS m FROM dn, tot),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM o WHERE rank <= {TOP}
"""
