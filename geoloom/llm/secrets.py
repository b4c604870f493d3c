"""Secrets in texts: fixed formats, and character Markov models for the rest.

Fixed formats are assignments to secret-sounding names, access keys and long hexadecimal
runs.  Any other token of 20 or more key characters that mixes letters with digits or
both cases is compared under two first-order Markov models of its characters, one of
random strings and one of ordinary identifiers; the log-likelihood ratio decides.

The models are trained from labelled samples: random are the values that the fixed
formats find in the sampled documents, with strings drawn uniformly from the usual key
alphabets; ordinary are the other tokens of these documents, alone and joined to long
identifiers.  Every fourth sample stays out of training and sets the threshold: the least
at which no more than one in ``FALSE_ALARMS`` ordinary identifiers would pass, and never
below ``LEAST_RATIO``.

Null texts are empty and hold nothing.  Repeated rows stay, ties cannot arise (spans of a
kind never overlap), extra columns are kept, an empty table stays empty.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import column, map_rows
from geoloom.llm.spans import Span, digest, joined, overlaps, redacted

# Kinds and patterns of the base formats, in this order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

SAMPLE_DOCUMENTS, SAMPLE_TOKENS = 2000, 40_000
LONGEST_TO_FIT = 200_000
LEAST_TOKEN = 20
FALSE_ALARMS, LEAST_RATIO = 2000, 12.0
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{3,}")
_SPARSE_HEX = re.compile(r"[0-9a-f]{8}")
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_CODE = {c: i + 1 for i, c in enumerate(_ALPHABET)}
KEY_ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", _ALPHABET[:62], _ALPHABET[:64])


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed formats, by start, then in the order of ``KINDS``."""
    out: list[Span] = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # 24 characters in a row show as 8 in a row in every third character.
    if _SPARSE_HEX.search(text[::3]):
        out += [("hex", *m.span()) for m in HEX.finditer(text)]
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def _mixed(token: str) -> bool:
    kinds = sum((any(c.islower() for c in token), any(c.isupper() for c in token), any(c.isdigit() for c in token)))
    return kinds > 1


def _transitions(tokens: list[str]) -> np.ndarray:
    """Log-probabilities of each character after each, 0 standing for the token's ends; add-half smoothing."""
    n = len(_ALPHABET) + 1
    counts = np.full((n, n), 0.5)
    for t in tokens:
        codes = np.array([0, *[_CODE[c] for c in t], 0])
        np.add.at(counts, (codes[:-1], codes[1:]), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


@dataclass
class Model:
    ratio: np.ndarray
    threshold: float

    def llr(self, token: str) -> float:
        codes = np.array([0, *[_CODE[c] for c in token], 0])
        return float(self.ratio[codes[:-1], codes[1:]].sum())

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """The base spans, and all spans by start, then kind."""
        if not text:
            return [], []
        base = base_spans(text)
        if not any(len(w) >= LEAST_TOKEN for w in text.split()):
            return base, base
        found = []
        at = 0
        for m in _TOKEN.finditer(text):
            while at < len(base) and base[at][2] <= m.start():
                at += 1
            # Base spans of different kinds may nest, so the few around the token are looked at.
            near = base[max(0, at - 3) : at + 3]
            if not overlaps(*m.span(), near) and _mixed(m[0]) and self.llr(m[0]) >= self.threshold:
                found.append(("random", *m.span()))
        return base, sorted(base + found, key=lambda s: (s[1], KINDS.index(s[0])))


def train(texts: list[str], seed: int = 42) -> Model:
    """Models and threshold from labelled tokens of sampled texts and drawn keys."""
    draw = random.Random(seed)
    keys, words = [], []
    for t in texts:
        spans = base_spans(t)
        keys += [_WORD.search(t[a:b])[0] for k, a, b in spans if k != "assign" and _WORD.search(t[a:b])]
        keys += [w for m in ASSIGN.finditer(t) for w in _WORD.findall(m[2]) if len(w) >= LEAST_TOKEN]
        if len(words) < SAMPLE_TOKENS:
            words += [m[0] for m in _WORD.finditer(t) if not overlaps(*m.span(), spans) and not m[0].isdigit()]
    words = words[:SAMPLE_TOKENS] + ["the", "value", "index", "file", "name", "config", "test", "data", "url", "user"]
    keys = keys[: SAMPLE_TOKENS // 4]
    keys += ["".join(draw.choices(a, k=draw.randint(20, 64))) for a in KEY_ALPHABETS for _ in range(1500)]

    def identifier() -> str:
        parts = draw.choices(words, k=draw.randint(3, 6))
        style = draw.choice(("_", "-", "/", "", "camel"))
        name = "".join(p.capitalize() for p in parts) if style == "camel" else style.join(parts)
        return name + draw.choice(("", "", str(draw.randint(0, 2030)), "=" + str(draw.randint(0, 99))))

    names = [identifier() for _ in range(12_000)]
    fit = lambda xs: [x for i, x in enumerate(xs) if i % 4]
    ratio = _transitions(fit(keys)) - _transitions(fit(words) + fit(names))
    model = Model(ratio, 0.0)
    ordinary = sorted(model.llr(x) for x in names[::4] + words[::4] if len(x) >= LEAST_TOKEN)
    allowed = len(ordinary) // FALSE_ALARMS
    model.threshold = max(LEAST_RATIO, ordinary[-1 - allowed] + 1e-9) if ordinary else LEAST_RATIO
    return model


def fit(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Train on the whole texts of at most ``documents`` documents, chosen by the hash of their id."""
    ids = docs.select(column(docs, "doc_id").alias("id")).dropna().distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(documents)
    texts = docs.select(column(docs, "doc_id").alias("id"), column(docs, "text").alias("text"))
    # At most ``documents`` ids, so sending them to every task is bounded.
    found = texts.filter(F.length("text").between(1, LONGEST_TO_FIT)).join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    return train(found.toPandas().sort_values("id")["text"].tolist())


REDACTED = {"assign": "[SECRET]", "access": "[ACCESS-KEY]", "hex": "[HEX]", "random": "[SECRET]"}


def found(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random)."""

    def make():
        def rows(ids, texts):
            for d, t in zip(ids, texts):
                base, every = model.spans(t)
                n = [sum(s[0] == k for s in every) for k in KINDS]
                yield d, *n[:-1], digest(base), joined(every), n[-1]

        return rows

    return map_rows(
        docs.select(column(docs, "doc_id").cast("bigint").alias("doc_id"), column(docs, "text").alias("text")), make,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_random bigint",
    )


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with every span of their text replaced by its kind's name."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redacted(t, model.spans(t)[1], REDACTED))

    return docs.withColumn("text", clean(column(docs, "text")))
