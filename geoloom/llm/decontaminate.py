"""Benchmark items inside documents: size-partitioned MinHash containment search.

A document contains an item if it holds at least ``share`` of the item's distinct runs of
five words.  Words are maximal runs of letters, marks and digits in lower case.  An item of
one to four words is one run of that many, for which documents show their runs of the same
length too; an item or document without words matches nothing.

MinHash order ranks an item's runs by hash.  An item of q runs may miss at most
q - ceil(share * q) of them, so one of its q - ceil(share * q) + 1 smallest hashes must
occur in the document: that many minima are its sketch, and no match is lost.  Items are
partitioned by the power of two in q.  Each partition's largest sketch hash is its cut; a
document sends on only hashes up to the largest cut among the partitions it is long enough
to contain, and meets the sketches by hash.  What meets is verified with the runs
themselves.

Built-in functions only.  Null texts are empty; of documents with the same id the one that
shares most runs counts; ``clean`` decides every row by its own text; items of equal text are searched once and
reported under each id, null ids included.  An empty table on either side gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import column, fresh, stored

WORDS, SHARE = 5, 0.8
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def _runs(words: str, n: int, short: list[int], value: str) -> str:
    """Values of all runs of ``n`` words (fewer words: of them all), and of the lengths ``short``."""
    one = f"transform(sequence(1, greatest(1, size({words}) - {n - 1})), i -> {value.format(f'slice({words}, i, {n})')})"
    more = [
        f"if(size({words}) < {k}, array(), transform(sequence(1, greatest(1, size({words}) - {k - 1})), i -> {value.format(f'slice({words}, i, {k})')}))"
        for k in short
    ]
    return f"if(size({words}) = 0, array(), {one})" if not more else f"if(size({words}) = 0, array(), concat({', '.join([one, *more])}))"


def _hashes(df: DataFrame, n: int, short: list[int]) -> DataFrame:
    """Replace ``words`` by the 64-bit hashes of its runs, column ``hs``."""
    hashed = df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.withColumn("hs", F.expr(_runs("h", n, short, "xxhash64({})"))).drop("words", "h")


def _need(q: str, share: float) -> Column:
    """ceil(share * q) without the error of the product: share is read to four decimals."""
    return F.expr(f"({round(share * 10_000)}L * {q} + 9999) div 10000")


def contained(docs: DataFrame, items: DataFrame, words: int = WORDS, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, item_runs, shared_runs, containment)."""
    texts = items.select(column(items, "item_id").alias("item_id"), column(items, "text").alias("item")).filter("item is not null").distinct()
    # Stored, so that the numbers given to the distinct texts stay the same.
    one = stored(texts.select("item").distinct().withColumn("item_no", F.monotonically_increasing_id()), "items")
    one = one.withColumn("words", words_of(F.col("item"))).filter("size(words) > 0")
    # An item of fewer words than ``words`` is one run of its own length, so documents send such runs too.
    short = sorted(r[0] for r in one.filter(F.size("words") < words).select(F.size("words")).distinct().collect())
    sketch = (
        _hashes(one.select("item_no", "words"), words, [])
        .withColumn("hs", F.array_sort(F.array_distinct("hs")))
        .withColumn("q", F.size("hs").cast("bigint"))
        .withColumn("need", _need("q", share))
        .select("item_no", "q", "need", F.expr("slice(hs, 1, cast(q - need + 1 as int))").alias("hs"))
        .select("item_no", "need", F.expr("cast(floor(log2(q)) as int)").alias("size_class"), F.explode("hs").alias("h"))
    )
    sketch = stored(sketch, "sketches")
    cuts = sketch.groupBy("size_class").agg(F.max("h").alias("cut"), F.min("need").alias("need")).collect()

    pieces = _hashes(docs.select(column(docs, "doc_id").alias("doc_id"), words_of(column(docs, "text")).alias("words")), words, short)
    lowest = -(1 << 63)
    fits = [F.when(F.size("hs") >= c["need"], F.lit(c["cut"])).otherwise(F.lit(lowest)) for c in cuts]
    cut = F.greatest(*fits, F.lit(lowest)) if fits else F.lit(lowest)
    sent = (
        pieces.withColumn("cut", cut).withColumn("runs", F.size("hs"))
        .select("doc_id", "runs", F.explode(F.filter("hs", lambda x: x <= F.col("cut"))).alias("h"))
    )
    met = sent.join(sketch, "h").filter("runs >= need").select("doc_id", "item_no").distinct()
    met = stored(met, "candidates")

    known = met.select(F.col("doc_id").alias("_id")).distinct()
    run = lambda more: f"array_distinct({_runs('words', words, more, 'array_join({}, \" \")')})"
    full = (
        docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text").alias("text"))
        .join(known, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        .select("doc_id", words_of(F.col("text")).alias("words")).filter("size(words) > 0")
        .select(F.col("doc_id").alias("_id"), F.expr(run(short)).alias("doc_runs"))
    )
    wanted = one.select("item_no", F.expr(run([])).alias("item_runs_of"))
    held = (
        met.join(wanted, "item_no").join(full, F.col("doc_id").eqNullSafe(F.col("_id")))
        .select(
            "doc_id", "item_no", F.size("item_runs_of").cast("bigint").alias("item_runs"),
            F.size(F.array_intersect("item_runs_of", "doc_runs")).cast("bigint").alias("shared_runs"),
        )
        .filter(F.col("shared_runs") >= _need("item_runs", share))
        .groupBy("doc_id", "item_no", "item_runs").agg(F.max("shared_runs").alias("shared_runs"))
    )
    return held.join(one.select("item_no", "item"), "item_no").join(texts, "item").select(
        "doc_id", "item_id", "item_runs", "shared_runs", (F.col("shared_runs") / F.col("item_runs")).alias("containment")
    )


def clean(docs: DataFrame, items: DataFrame, words: int = WORDS, share: float = SHARE) -> DataFrame:
    """The documents that contain no item, each row decided by its own text."""
    text = F.md5(column(docs, "text").cast("binary"))
    hit = contained(docs.select(text.alias("doc_id"), column(docs, "text").alias("text")), items, words, share)
    name = fresh(docs, "text_md5")
    hit = hit.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(hit, text == hit[name], "left_anti")


ORACLE = r"""WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
lens AS (SELECT DISTINCT least(len(w), 5) AS n FROM i WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lens WHERE len(w) >= n)),
si AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS k FROM i WHERE len(w) > 0)),
q AS (SELECT item_id, count(*) AS item_runs FROM si GROUP BY 1),
m AS (SELECT doc_id, item_id, count(*) AS shared_runs FROM ds JOIN si USING (s) GROUP BY ALL)
SELECT doc_id, item_id, item_runs, shared_runs, CAST(shared_runs AS DOUBLE) / item_runs AS containment
FROM m JOIN q USING (item_id) WHERE shared_runs * 10000 >= 8000 * item_runs"""
