"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens.  In every round, which fills one window
of ``window`` tokens, a source is credited ``window * target share`` tokens and sends what
its credit allows; the fraction of a token that remains is carried into the next round.
After w rounds a source has therefore sent exactly floor(w * num / den) tokens, with
num / den its credit per round.  That closed form makes the rounds independent of each
other: a token's place in its queue gives its round, prefix sums give the place, and the
deficits carry over from one partition to the next without anything running in sequence.
The rounds are laid end to end and cut every ``length`` tokens, so only the last sequence
of all can need padding.

Null and empty texts are a document of the end id alone; a null source is the queue ''.
Null and repeated ids stay rows of their own, extra columns are ignored, and an empty
table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.common import column, map_rows, prefix_sums, stored
from geoloom.llm.tokens import BYTE_BPE, encoder, vocabulary_size

CELLS_PER_ROW = 4096


def encoded(docs: DataFrame, tokenizer: str, end_id: int, octets: int) -> DataFrame:
    """(doc_id, source, part, place, n, ids): ``place`` counts the source's tokens before it in its partition.

    ``ids`` are little-endian numbers of ``octets`` bytes.
    """

    def make():
        from pyspark import TaskContext

        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        end, sent = end_id.to_bytes(4, "little"), {}

        def rows(doc_ids, texts, sources):
            for d, t, s in zip(doc_ids, texts, sources):
                ids = encode(t) + end
                n = len(ids) // 4
                if octets != 4:
                    ids = np.frombuffer(ids, dtype="<u4").astype(f"<u{octets}").tobytes()
                at = sent.get(s, 0)
                sent[s] = at + n
                yield d, s, part, at, n, ids

        return rows

    return map_rows(
        docs.select(
            column(docs, "doc_id").cast("bigint").alias("doc_id"), column(docs, "text").alias("text"),
            F.coalesce(column(docs, "source").cast("string"), F.lit("")).alias("source"),
        ),
        make, "doc_id bigint, source string, part int, place bigint, n bigint, ids binary",
    )


def _sent(w: Column | str) -> Column:
    """Tokens that a source has sent after ``w`` rounds: floor(w * num / den) without overflow."""
    return F.expr(f"{w} * (num div den) + ({w} * (num % den)) div den")


def _round_of(x: str) -> Column:
    """The round that sends the queue's token number ``x``: the last w with sent(w) <= x."""
    return F.expr(
        f"(cast({x} + 1 as decimal(20,0)) * cast(den as decimal(18,0)) - 1) div cast(num as decimal(18,0))"
    )


def pack(
    docs: DataFrame,
    length: int = 1024,
    window: int = 65_536,
    targets: dict[str, int] | None = None,
    tokenizer: str = BYTE_BPE,
    end_id: int = 0,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, round, ids).

    ``targets`` gives sources integer weights; those it leaves out weigh 1.  Without it a
    source's target is its share of all tokens, which all queues reach together, so that
    every window holds the corpus mixture.  A queue that ends early leaves its place in
    later windows to the others.
    """
    # Ids travel in two bytes where the vocabulary allows.
    octets = 2 if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else 4
    tok = stored(encoded(docs, tokenizer, end_id, octets), "tokens")
    per = tok.groupBy("source", "part").agg(F.sum("n").alias("t"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("base", F.coalesce(F.sum("t").over(before), F.lit(0)))
    queues = per.groupBy("source").agg(F.sum("t").alias("total"))
    if targets is None:
        tokens = queues.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
        rounds = max(1, -(-tokens // window))
        queues = queues.withColumns({"num": F.col("total"), "den": F.lit(rounds).cast("bigint")})
    else:
        weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in targets.items() for x in kv]), F.col("source")), F.lit(1)) if targets else F.lit(1)
        queues = queues.withColumn("weight", weight.cast("bigint"))
        whole = queues.agg(F.coalesce(F.sum("weight"), F.lit(1))).first()[0]
        queues = queues.withColumns({"num": F.col("weight") * window, "den": F.lit(whole).cast("bigint")})
    queues = stored(queues.select("source", "total", "num", "den"), "queues")

    cells = _cells(queues)
    # The queue's figures ride along with its partitions' bases: a join on the source alone
    # would bring all rows of the largest source together.
    bases = stored(per.select("source", "part", "base").join(queues, "source"), "bases")
    frags = (
        tok.join(bases, ["source", "part"])
        .withColumn("x0", F.col("base") + F.col("place"))
        .withColumn("x1", F.col("x0") + F.col("n"))
        .withColumn("round", F.explode(F.sequence(_round_of("x0"), _round_of("x1 - 1"))))
        .withColumn("a", F.greatest("x0", _sent("round")))
        .withColumn("b", F.least("x1", _sent("(round + 1)")))
        .filter("b > a")
        .select(
            "source", "round", "doc_id", F.col("n").alias("doc_tokens"), "a", (F.col("a") - F.col("x0")).alias("at"),
            (F.col("b") - F.col("a")).alias("m"),
            F.expr(f"substring(ids, cast({octets} * (a - x0) + 1 as int), cast({octets} * (b - a) as int))").alias("ids"),
        )
    )
    placed = frags.join(cells, ["source", "round"]).withColumn("g", F.col("cell_at") + F.col("a") - F.col("lo"))
    cut = (
        placed.withColumn("sequence_id", F.explode(F.expr(f"sequence(g div {length}, (g + m - 1) div {length})")))
        .withColumn("p", F.greatest("g", F.col("sequence_id") * length))
        .withColumn("e", F.least(F.col("g") + F.col("m"), (F.col("sequence_id") + 1) * length))
        .select(
            "doc_id", (F.col("at") + F.col("p") - F.col("g")).alias("start"), (F.col("e") - F.col("p")).alias("length"),
            F.expr(f"substring(ids, cast({octets} * (p - g) + 1 as int), cast({octets} * (e - p) as int))").alias("ids"),
            "doc_tokens", "sequence_id", (F.col("p") - F.col("sequence_id") * length).alias("offset"), "source", "round",
        )
    )

    def make():
        def rows(doc_id, start, n, ids, doc_tokens, sequence_id, offset, source, rnd):
            wide = [np.frombuffer(x, dtype=f"<u{octets}").astype("<u4").tobytes() for x in ids]
            return zip(doc_id, start, n, map(zlib.crc32, wide), doc_tokens, sequence_id, offset, source, rnd, wide)

        return rows

    return map_rows(
        cut, make,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint,"
        " source string, round bigint, ids binary",
    )


def _cells(queues: DataFrame) -> DataFrame:
    """(source, round, lo, cell_at): where a source's tokens of a round begin in its queue and in the whole."""
    # A queue of fewer tokens than rounds has a cell per token, others one per round.
    last = F.expr("if(num >= den, cast((cast(total as decimal(20,0)) * den - 1) div num as bigint), total - 1)")
    spans = queues.filter("total > 0").withColumn("last", last).withColumn("k0", F.explode(F.expr(f"sequence(0L, last, {CELLS_PER_ROW}L)")))
    cells = (
        spans.repartition("source", "k0")
        .withColumn("k", F.explode(F.expr(f"sequence(k0, least(last, k0 + {CELLS_PER_ROW - 1}))")))
        .withColumn("round", F.when(F.expr("num >= den"), F.col("k")).otherwise(_round_of("k")))
        .withColumn("lo", _sent("round"))
        .withColumn("hi", F.least("total", _sent("(round + 1)")))
        .filter("hi > lo")
        .select("source", "round", "lo", (F.col("hi") - F.col("lo")).alias("m"))
    )
    inside = Window.partitionBy("round").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("in_round", F.coalesce(F.sum("m").over(inside), F.lit(0)))
    rounds = prefix_sums(cells.groupBy("round").agg(F.sum("m").alias("m")), "round", {"round_at": "m"})
    return cells.join(rounds.select("round", "round_at"), "round").select(
        "source", "round", "lo", (F.col("round_at") + F.col("in_round")).alias("cell_at")
    )
