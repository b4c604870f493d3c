"""Bounded labelled samples, and logistic regression on a few features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import column, fold

LONGEST_TO_FIT = 200_000


def _labelled(labels: DataFrame, label: str) -> DataFrame:
    """(id, y, fold) of the labelled ids whose fold is not 0; an id labelled twice has its larger label."""
    return (
        labels.select(column(labels, "doc_id").alias("id"), column(labels, label).cast("int").alias("y"))
        .dropna().groupBy("id").agg(F.max("y").alias("y"))
        .withColumn("fold", fold(F.col("id"))).filter("fold <> 0")
    )


def class_counts(labels: DataFrame, label: str) -> dict[int, int]:
    """How many ids of each label there are outside fold 0."""
    return {r["y"]: r["n"] for r in _labelled(labels, label).groupBy("y").agg(F.count("*").alias("n")).collect()}


def row_weights(counts: dict[int, int], per_class: dict[int, int]) -> dict[int, float]:
    """By label, the rows that one row of ``sample`` stands for."""
    return {y: max(1.0, counts.get(y, 0) / n) for y, n in per_class.items()}


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]) -> pd.DataFrame:
    """(doc_id, y, fold, text) on the driver, at most ``per_class`` rows of each label.

    Only rows whose fold is not 0 are read.  Ids are taken in the order of their hash, so
    the same rows come back whatever the partitioning; an id labelled twice counts with its
    larger label, a repeated document once.  Texts over ``LONGEST_TO_FIT`` characters do
    not take part in fitting.
    """
    ids = _labelled(labels, label)
    picks = [ids.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in per_class.items()]
    chosen = picks[0]
    for p in picks[1:]:
        chosen = chosen.unionByName(p)
    texts = docs.select(column(docs, "doc_id").alias("id"), F.coalesce(column(docs, "text"), F.lit("")).alias("text"))
    # At most sum(per_class) narrow rows, so sending them to every task is bounded.
    found = texts.filter(F.length("text") <= LONGEST_TO_FIT).join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    rows = found.select(F.col("id").alias("doc_id"), "y", "fold", "text").toPandas()
    return rows.sort_values("doc_id", ignore_index=True)


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> Logistic:
    """Newton steps on the ridge-penalised likelihood."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = z.T @ (z * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w -= np.linalg.solve(h, z.T @ (p - y) + ridge * w)
    return Logistic(mean, scale, w)


def score_column(make):
    """A column function from text to score; ``make`` runs once per task and gives ``list of texts -> scores``."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = make()
        for texts in batches:
            parts = [fn(texts.iloc[i : i + 256].tolist()) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return score
