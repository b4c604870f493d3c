"""The registered query of every operator over its whole table, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import (
    balanced,
    decontaminate,
    infill,
    lexical,
    neighbours,
    packing,
    pii,
    quality,
    secrets,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from geoloom.llm.common import fold, shared_path, table

Query = Callable[[SparkSession, str], DataFrame]


def _classified(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op1_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return _classified(toxicity.scored(docs, toxicity.fit(docs, table(spark, sf, "labels"))), 0.5)


def op2_simhash(spark, sf):
    grouped = simhash.groups(table(spark, sf, "documents"))
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_secrets(spark, sf):
    docs = table(spark, sf, "documents")
    return secrets.found(docs, secrets.fit(docs))


def op4_quality(spark, sf):
    docs = table(spark, sf, "documents")
    return _classified(quality.scored(docs, quality.fit(docs, table(spark, sf, "labels"))), 0.3)


def op5_pii(spark, sf):
    docs = table(spark, sf, "documents")
    return pii.found(docs, pii.fit(docs))


def op6_warc(spark, sf):
    path = shared_path(spark, "warc")
    warc.write(table(spark, sf, "pages"), path)
    recs = warc.resolve_revisits(warc.read(spark, path))
    return recs.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_neighbours(spark, sf):
    return neighbours.search(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents")).drop("source", "round", "ids")


def op9_token_counts(spark, sf):
    return token_counts.curve(token_counts.histogram(table(spark, sf, "documents")))


def op10_decontamination(spark, sf):
    return decontaminate.contained(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op11_lexical(spark, sf):
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_balanced(spark, sf):
    return balanced.mix(table(spark, sf, "documents"))


def op13_infill(spark, sf):
    made = infill.transformed(table(spark, sf, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_toxicity, op2_simhash, op3_secrets, op4_quality, op5_pii, op6_warc, op7_neighbours, op8_packing,
        op9_token_counts, op10_decontamination, op11_lexical, op12_balanced, op13_infill,
    )
}


def pipeline(spark, sf):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES["pipeline"] = pipeline
ORACLES: dict[str, str] = {"op6_warc": warc.ORACLE, "op10_decontamination": decontaminate.ORACLE}
ORACLES |= {"op11_lexical": lexical.ORACLE, "op13_infill": infill.ORACLE}
