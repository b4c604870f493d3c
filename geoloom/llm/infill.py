"""Fill-in-middle transformation over content-defined chunks.

A text is cut into chunks where a rolling hash over its last ``WINDOW`` bytes has
``CHUNK_BITS`` zero bits, so equal passages of different documents give equal chunks.  What
the transformation needs of a chunk is its boundary summary: characters, the word ends
strictly inside, and whether it begins and ends in a word.  Each task keeps the summaries
of the chunks it has met in a content cache: the chunk's bytes are the key, so a hit is an
equality of contents and never one of hashes alone.  Summaries combine along the document:
a word ends at a chunk's border if the chunk ends in a word and the next one begins with a
blank; running counts of ends then find the chunk of any token, and its summary the place.

A token is a word with the blanks before it, or the blanks that end the text.  Null texts
are empty and, like texts that hold a marker, stay plain; a null id draws as an empty text.
Texts of any length are handled whole, repeated rows stay rows of their own and draw alike,
extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from hashlib import sha256
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.common import column, map_rows

# Fixed values.
BLANKS = "\x20\x09-\x0d"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80

WINDOW, CHUNK_BITS, LONGEST_CHUNK = 16, 8, 8192
CACHE_BYTES = 32 << 20
_GEAR = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = re.compile(f"[^{BLANKS}]+")


def chunk_starts(data: bytes) -> list[int]:
    """Where the chunks of ``data`` (UTF-8) begin, and its length; no character is split."""
    n = len(data)
    if n == 0:
        return [0]
    b = np.frombuffer(data, dtype=np.uint8)
    h = _GEAR[b]
    # The sum of the last 1, 2, 4 .. WINDOW bytes' values, each shifted by its distance.
    span = 1
    while span < WINDOW and span < n:
        h[span:] = h[span:] + (h[:-span] << np.uint64(span))
        span *= 2
    at = np.flatnonzero((h >> np.uint64(64 - CHUNK_BITS)) == 0) + 1
    at = at[at >= WINDOW]
    if n > LONGEST_CHUNK:
        edges = np.concatenate(([0], at, [n]))
        wide = np.flatnonzero(np.diff(edges) > LONGEST_CHUNK)
        more = [np.arange(edges[i] + LONGEST_CHUNK, edges[i + 1], LONGEST_CHUNK) for i in wide]
        at = np.unique(np.concatenate([at, *more]))
    at = at[at < n]
    for _ in range(3):
        at = at + ((b[np.minimum(at, n - 1)] & 0xC0) == 0x80)
    return [0, *np.unique(at[at < n]).tolist(), n]


def summary(chunk: str) -> tuple[int, bool, bool, list[int]]:
    """(characters, begins in a word, ends in a word, word ends strictly inside)."""
    ends = [m.end() for m in _WORD.finditer(chunk)]
    last = bool(ends) and ends[-1] == len(chunk)
    return len(chunk), _WORD.match(chunk) is not None, last, ends[:-1] if last else ends


class Chunks:
    """Summaries by content, forgotten together when they outgrow ``CACHE_BYTES``."""

    def __init__(self) -> None:
        self.known: dict[bytes, tuple] = {}
        self.held = self.hits = self.misses = 0

    def of(self, chunk: bytes) -> tuple[int, bool, bool, list[int]]:
        found = self.known.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        found = summary(chunk.decode())
        self.held += len(chunk) + 8 * len(found[3]) + 200
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = len(chunk) + 8 * len(found[3]) + 200
        self.known[chunk] = found
        return found


class Places:
    """Where the tokens of one text end, from the summaries of its chunks."""

    def __init__(self, data: bytes, chunks: Chunks) -> None:
        starts = chunk_starts(data)
        self.parts = [chunks.of(data[a:b]) for a, b in zip(starts, starts[1:])]
        follows = [p[1] for p in self.parts[1:]] + [False]
        # The border of a chunk is a word's end if the word does not go on behind it.
        self.counts = list(accumulate(len(p[3]) + (p[2] and not f) for p, f in zip(self.parts, follows)))
        self.chars = list(accumulate((p[0] for p in self.parts), initial=0))
        words = self.counts[-1] if self.counts else 0
        self.tokens = words + bool(self.parts and not self.parts[-1][2])

    def end(self, k: int) -> int:
        """Characters before the end of token number ``k`` (from 1); 0 for ``k`` = 0."""
        if k <= 0:
            return 0
        i = bisect_left(self.counts, k)
        if i == len(self.counts):
            return self.chars[-1]
        inside = k - 1 - (self.counts[i - 1] if i else 0)
        length, _, _, ends = self.parts[i]
        return self.chars[i] + (ends[inside] if inside < len(ends) else length)


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def transformer(seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> Callable:
    """``fn(doc_id, text) -> (n, form, prefix_chars, middle_chars, output)``."""
    chunks = Chunks()

    def one(doc_id: int | None, text: str | None) -> tuple:
        text = text or ""
        places = Places(text.encode(), chunks)
        n = places.tokens
        h1, h2, h3, h4 = draws(doc_id, seed)
        if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= fim_percent:
            return n, "plain", None, None, text
        a, b = sorted((places.end(h1 % (n + 1)), places.end(h2 % (n + 1))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_percent:
            return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
        return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle

    return one


def transformed(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row."""

    def make():
        one = transformer(seed, fim_percent, spm_percent)
        return lambda ids, texts: [(d, *one(d, t)) for d, t in zip(ids, texts)]

    return map_rows(
        docs.select(column(docs, "doc_id").cast("bigint").alias("doc_id"), column(docs, "text").alias("text")), make,
        "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    psm = F.split(F.substr(output, F.lit(4)), f"{SUFFIX}|{MIDDLE}", -1)
    spm = F.split(F.substr(output, F.lit(4)), f"{PREFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(F.get(psm, 0), F.get(psm, 2), F.get(psm, 1)))
        .when(form == "spm", F.concat(F.get(spm, 1), F.get(spm, 2), F.get(spm, 0)))
        .otherwise(output)
    )


_TEXT = "coalesce(text, '')"
ORACLE = rf"""
WITH d AS (SELECT doc_id, {_TEXT} AS text, regexp_extract_all({_TEXT}, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
    sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (SELECT *, CAST(len(tokens) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {FIM_PERCENT} THEN 'plain'
      WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (SELECT *, array_to_string(tokens[1:a], '') AS pre, array_to_string(tokens[a + 1:b], '') AS mid, array_to_string(tokens[b + 1:n], '') AS suf FROM f),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
    ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END AS output FROM g)
SELECT doc_id, n, form, CASE WHEN form = 'plain' THEN NULL ELSE length(pre) END AS prefix_chars,
    CASE WHEN form = 'plain' THEN NULL ELSE length(mid) END AS middle_chars, sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""
