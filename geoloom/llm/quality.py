"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its hashed byte trigrams, damped by the logarithm and weighted by
inverse document frequency; the singular vectors of the labelled sample's term matrix map
them to ``RANK`` latent dimensions.  Shares that trigrams cannot show (words that repeat
the word before, repeated lines, characters other than letters, capitals) are appended to
the unit vector.  The labelled vectors, at most ``LOW_ROWS + HIGH_ROWS`` of them, go to
every task; each document's cosines with all of them are computed block by block, and the
``NEIGHBOURS`` nearest vote with weight cosine ** ``SHARPNESS``, the earlier labelled row
first among equally near ones.  A vote counts for as many labelled rows as its row of the
bounded sample stands for, so scores do not depend on the bounds.

Null and empty texts have the zero vector, no neighbours, and score the share of good
labels among all labels.  Without labels every score is 0.  Equal texts get equal scores, extra columns are
kept, an empty table stays empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from geoloom.llm.common import column
from geoloom.llm.labelled import class_counts, row_weights, sample, score_column

LOW_ROWS, HIGH_ROWS = 2000, 4000
TERMS, RANK = 2048, 24
NEIGHBOURS, SHARPNESS = 15, 8
STEP = 1 << 20

_OCTETS = np.arange(256)
_LETTER = ((_OCTETS >= 65) & (_OCTETS <= 90)) | ((_OCTETS >= 97) & (_OCTETS <= 122)) | (_OCTETS > 127)
_CAPITAL = (_OCTETS >= 65) & (_OCTETS <= 90)


def _counts(raw: bytes) -> np.ndarray:
    """Occurrences of each hashed trigram."""
    total = np.zeros(TERMS, dtype=np.int64)
    for at in range(0, max(1, len(raw) - 2), STEP):
        b = np.frombuffer(raw[at : at + STEP + 2], dtype=np.uint8).astype(np.uint32)
        if len(b) < 3:
            b = np.concatenate([b, np.zeros(3 - len(b), dtype=np.uint32)])
        h = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        total += np.bincount((h % np.uint32(TERMS)).astype(np.int64), minlength=TERMS)
    return total


def _shares(text: str, raw: bytes) -> list[float]:
    words, lines = text.split(), [x for x in text.split("\n") if x]
    same = sum(map(str.__eq__, words, words[1:])) / max(1, len(words))
    octets = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = len(raw)
    return [
        same**0.5, (1 - len(set(lines)) / max(1, len(lines))) ** 0.5,
        2 * (1 - octets[_LETTER].sum() / n), octets[_CAPITAL].sum() / n,
    ]


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Damped term counts and shares, one row per text; zero rows for empty texts."""
    counts, shares = np.zeros((len(texts), TERMS)), np.zeros((len(texts), 4))
    for i, t in enumerate(texts):
        if t:
            raw = t.encode("utf-8", "surrogatepass")
            counts[i] = np.log1p(_counts(raw))
            shares[i] = _shares(t, raw)
    return counts, shares


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(1e-12, np.linalg.norm(x, axis=1, keepdims=True))


def nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest values of each row; the first columns among equal ones."""
    least = np.partition(cosines, -k, axis=1)[:, -k][:, None]
    above, level = cosines > least, cosines == least
    room = k - above.sum(1, keepdims=True)
    taken = above | (level & (np.cumsum(level, axis=1) <= room))
    return np.nonzero(taken)[1].reshape(len(cosines), k)


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    stands_for: np.ndarray
    share: float

    def latent(self, texts: list[str | None]) -> np.ndarray:
        counts, shares = terms(texts)
        empty = counts.sum(1) == 0
        out = _unit(np.c_[_unit(_unit(counts * self.idf) @ self.axes), shares])
        out[empty] = 0
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.votes):
            return np.full(len(texts), self.share)
        cosines = self.latent(texts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.votes))
        near = nearest(cosines, k)
        weight = np.take_along_axis(cosines, near, 1).clip(0) ** SHARPNESS * self.stands_for[near]
        total = weight.sum(1)
        voted = (weight * self.votes[near]).sum(1) / np.maximum(total, 1e-300)
        return np.where(total > 0, voted, self.share).clip(0, 1)

    def column(self):
        return score_column(lambda: self.score)


def fit(docs: DataFrame, labels: DataFrame, low_rows: int = LOW_ROWS, high_rows: int = HIGH_ROWS) -> Model:
    per_class = {0: low_rows, 1: high_rows}
    rows = sample(docs, labels, "quality", per_class)
    rows = rows[rows["text"] != ""]
    y = rows["y"].to_numpy(dtype=np.float64)
    if not len(y):
        return Model(np.ones(TERMS), np.zeros((TERMS, 0)), np.zeros((0, 4)), y, y, 0.0)
    texts = rows["text"].tolist()
    blocks = [texts[i : i + 256] for i in range(0, len(texts), 256)]
    x = np.concatenate([terms(b)[0].astype(np.float32) for b in blocks])
    idf = np.log((1 + len(y)) / (1 + (x > 0).sum(0))) + 0.05
    x *= idf.astype(np.float32)
    x /= np.maximum(1e-12, np.linalg.norm(x, axis=1, keepdims=True))
    _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))
    counts = class_counts(labels, "quality")
    weight = row_weights(counts, per_class)
    stands_for = np.where(y == 1, weight[1], weight[0])
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    model = Model(idf, np.ascontiguousarray(axes[:, ::-1][:, :RANK]), np.zeros((0, RANK + 4)), y, stands_for, share)
    model.vectors = np.concatenate([model.latent(b) for b in blocks])
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The documents and ``score``, the weighted share of good labels among the nearest."""
    return docs.withColumn("score", model.column()(column(docs, "text")))
