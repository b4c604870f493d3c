"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary labelled text, one on toxic text,
which continues the ordinary one with what marks toxic documents.  A text is cut into
windows, its words between two blanks, and each window is compressed with both.  What the
toxic dictionary saves over the ordinary one is the window's distance; a document's
largest distances and the numbers of windows beyond several thresholds go through a
logistic calibration.

Dictionaries are trained on folds 1 to 3, thresholds calibrated on fold 4, fold 0 stays
unseen.  The sample is bounded per class; the calibration is moved to the proportions of
all labels outside fold 0, so scores do not depend on the bounds.  A match in zstandard costs about four bytes whatever its length, more than a
short word is worth, so windows and dictionaries repeat every byte ``STRETCH`` times.

A window longer than ``LONGEST_WINDOW`` bytes (text without blanks, as in Chinese or Thai) is
scored in overlapping pieces that cover all of it, and its inner runs of two to four
characters may enter the dictionaries, as words stand anywhere in it.

Null and empty texts have no windows and get the calibrated score of that.  Letters A to
Z are compared in lower case.  Without labels of both kinds every score is 0.  Equal texts
get equal scores, extra columns are kept, an empty table stays empty.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from geoloom.llm.common import column
from geoloom.llm.labelled import Logistic, class_counts, fit_logistic, row_weights, sample, score_column

TOXIC_ROWS, ORDINARY_ROWS = 3000, 4500
STRETCH = 3
THRESHOLDS = (2, 4, 6, 8, 10, 14)
DICTIONARY_BYTES = 8000
LONGEST_WINDOW, PIECE_STEP = 40, 20
CACHED_WINDOWS = 400_000
_SPLIT = re.compile(rb"[^a-z\x80-\xff]+")
_SPREAD = [bytes([b]) * STRETCH for b in range(256)]


def windows(text: str | None) -> list[bytes]:
    return [w for w in _SPLIT.split((text or "").encode("utf-8", "surrogatepass").lower()) if len(w) > 2]


def pieces(window: bytes) -> list[bytes]:
    """The window, or if it is long, overlapping pieces that cover it."""
    last = len(window) - LONGEST_WINDOW
    if last <= 0:
        return [window]
    return [window[at : at + LONGEST_WINDOW] for at in (*range(0, last, PIECE_STEP), last)]


def _stretched(raw: bytes) -> bytes:
    return b"".join([_SPREAD[b] for b in raw])


@dataclass
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    def distance(self):
        """A function from piece to the bytes saved by the toxic dictionary, with a cache."""
        import zstandard

        def compressor(content: bytes):
            params = zstandard.ZstdCompressionParameters(
                window_log=18, chain_log=18, hash_log=17, search_log=8, min_match=6, target_length=16,
                strategy=zstandard.STRATEGY_GREEDY, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
                write_content_size=0, write_checksum=0, write_dict_id=0,
            )
            raw = zstandard.ZstdCompressionDict(_stretched(content), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(dict_data=raw, compression_params=params).compress

        plain, toxic, seen = compressor(self.ordinary), compressor(self.toxic), {}

        def saved(window: bytes) -> int:
            d = seen.get(window)
            if d is None:
                x = _stretched(b" " + window + b" ")
                d = len(plain(x)) - len(toxic(x))
                if len(seen) >= CACHED_WINDOWS:
                    seen.clear()
                seen[window] = d
            return d

        return saved


def _segments(text: str) -> set[bytes]:
    """What a dictionary may be made of: words and their first letters, after a blank; runs inside long windows."""
    out = set()
    for w in set(windows(text)):
        if len(w) > LONGEST_WINDOW:
            # Where characters start; the end closes the last one.
            at = [i for i, b in enumerate(w) if b & 0xC0 != 0x80] + [len(w)]
            for n in (2, 3, 4):
                out.update(w[i:j] for i, j in zip(at, at[n:]) if j - i > 5)
        elif len(w) > 3:
            out.update(b" " + w[:n] for n in range(4, min(len(w), 9) + 1))
            out.add(b" " + w + b" ")
    return out


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> Dictionaries:
    """Ordinary: the most common segments of ordinary texts by what they save.  Toxic: these, then the
    segments that surely occur in a larger share of the toxic texts, the most telling ones last."""
    plain, marked = Counter(), Counter()
    for t in ordinary:
        plain.update(_segments(t))
    for t in toxic:
        marked.update(_segments(t))
    common = sorted(plain.items(), key=lambda kv: (-kv[1] * (len(kv[0]) - 2), kv[0]))
    # Shares of all segments, not of documents: long texts hold more of everything.
    in_toxic, in_ordinary = marked.total(), plain.total()
    telling = []
    for s, k in marked.items():
        if k >= 7:
            # Tens of thousands of segments are compared, hence the wide margins.
            least = (k - 2.5 * math.sqrt(k)) / in_toxic
            most = (plain[s] + 2.5 * math.sqrt(plain[s]) + 1) / in_ordinary
            if least > 3 * most:
                telling.append((s, k * math.log(least / most)))
    telling.sort(key=lambda kv: (-kv[1], -len(kv[0]), kv[0]))

    def joined(ranked) -> bytes:
        content = b""
        for s, _ in ranked:
            if s not in content and len(content) + len(s) <= DICTIONARY_BYTES:
                content = s + content
            if len(content) > DICTIONARY_BYTES - 8:
                break
        return content

    base = joined(common[:20_000])
    return Dictionaries(base, base + joined(telling))


def features(text: str | None, saved) -> list[float]:
    d = np.array([saved(p) for w in windows(text) for p in pieces(w)], dtype=np.int64)
    top = np.sort(d)[::-1][:2].clip(0, 20).tolist() + [0, 0]
    return [*top[:2], *[math.log1p(int((d >= t).sum())) for t in THRESHOLDS], math.log1p(len(d))]


@dataclass
class Model:
    dictionaries: Dictionaries | None
    calibration: Logistic | None

    def column(self):
        dictionaries, calibration = self.dictionaries, self.calibration

        def make():
            if dictionaries is None or calibration is None:
                return lambda texts: np.zeros(len(texts))
            saved = dictionaries.distance()
            return lambda texts: calibration(np.array([features(t, saved) for t in texts]).reshape(len(texts), -1))

        return score_column(make)


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> Model:
    per_class = {1: toxic_rows, 0: ordinary_rows}
    rows = sample(docs, labels, "toxic", per_class)
    held = rows["fold"] == 4
    y = rows["y"].to_numpy()
    texts = rows["text"].to_numpy()
    if min(((y == k) & part).sum() for k in (0, 1) for part in (held, ~held)) == 0:
        return Model(None, None)
    dictionaries = train_dictionaries(list(texts[~held & (y == 1)]), list(texts[~held & (y == 0)]))
    saved = dictionaries.distance()
    x = np.array([features(t, saved) for t in texts[held]])
    calibration = fit_logistic(x, y[held])
    weight = row_weights(class_counts(labels, "toxic"), per_class)
    calibration.weights[-1] += math.log(weight[1] / weight[0])
    return Model(dictionaries, calibration)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The documents and ``score``, the calibrated probability of being toxic."""
    return docs.withColumn("score", model.column()(column(docs, "text")))


def keep_ordinary(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold."""
    return docs.filter(model.column()(column(docs, "text")) < threshold)
