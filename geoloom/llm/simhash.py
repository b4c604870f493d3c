"""Near copies by SimHash fingerprints, found through Golay-code keys.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  If two
fingerprints differ in at most 2 bits, one segment is equal in both and any other differs
in at most 2 bits, so it shares a nearby codeword of the Golay code.  Each fingerprint
therefore gets keys (segment, its bits, index of a codeword near the next segment), about
16 in all; equal keys give the candidates, and counting bits decides.

Only distinct fingerprints take part: copies, however many, are one.  Where more than
``bucket`` distinct fingerprints share a key, their pairs are not formed.  They are
listed under each of the 65 words within one bit of them instead: two fingerprints differ
in at most 2 bits exactly if they meet under such a word, and at most 65 can meet there.
Both ways are exact; every link is kept or replaced by a chain of links.

A null or empty text has fingerprint zero and links like any other.  Rows without an id
keep their fingerprint and take the smallest id of their group, null if it has none.
Repeated rows stay, extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import golay
from geoloom.llm.common import column, fresh, map_rows, stored
from geoloom.operators.graph import star_components

SEGMENTS = ((0, 22), (22, 21), (43, 21))
BUCKET = 24
SEED = 42
STEP = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_runs(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about a megabyte at a time."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + STEP)
        end = space.start() if space else len(text)
        yield text[at:end].split()
        at = end


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``words`` lower-cased words, repeats included, in pieces."""
    from xxhash import xxh64_intdigest

    carry: list[bytes] = []
    short = True
    for run in _word_runs((text or "").encode("utf-8", "surrogatepass").lower()):
        w = carry + run
        if len(w) >= words:
            short = False
            joined = b" ".join(w)
            length = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
            end = np.cumsum(length + 1) - 1
            start = (end - length)[: len(w) - words + 1].tolist()
            end = end[words - 1 :].tolist()
            yield np.array([xxh64_intdigest(joined[i:j], SEED) for i, j in zip(start, end)], dtype=np.uint64)
        carry = w[-(words - 1) :] if words > 1 else []
    if short and carry:
        yield np.array([xxh64_intdigest(b" ".join(carry), SEED)], dtype=np.uint64)


def simhash(text: str | None, words: int) -> int:
    """A bit is set if it is set in over half of the hashes; the fingerprint as a signed 64-bit number."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    total, counts = 0, np.zeros(64, dtype=np.int64)
    for hashes in shingle_hashes(text, words):
        total += len(hashes)
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts[8 * k : 8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ bits
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp)."""

    def make():
        return lambda ids, hashes, texts: [(d, h, simhash(t, words)) for d, h, t in zip(ids, hashes, texts)]

    text = column(docs, "text")
    return map_rows(
        docs.select(column(docs, "doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text")),
        make, "doc_id bigint, text_hash bigint, fp bigint",
    )


def golay_keys(distinct: DataFrame) -> DataFrame:
    """(key, fp): about 16 keys per fingerprint."""

    def make():
        def rows(fps):
            f = np.array(fps, dtype=np.int64).view(np.uint64)
            part = [((f >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
            for i in range(3):
                row, index = golay.nearby(part[(i + 1) % 3])
                key = (i << 40) | (part[i][row] << 12) | index
                yield from zip(key.tolist(), f.view(np.int64)[row].tolist())

        return rows

    return map_rows(distinct.select("fp"), make, "key bigint, fp bigint", rows_per_step=4096)


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(u, v), u > v: fingerprints at most 2 bits apart, enough of them to connect all that are."""
    keys = stored(golay_keys(distinct), "golay-keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = stored(keys.join(shared, "key"), "golay-shared")

    few = rows.filter(F.col("n") <= bucket).select("key", "fp")
    other = few.select("key", F.col("fp").alias("v"))
    pairs = few.join(other, "key").filter("fp > v and bit_count(fp ^ v) <= 2").select(F.col("fp").alias("u"), "v")

    many = rows.filter(F.col("n") > bucket).select("fp").distinct()
    word = F.expr("explode(concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))))")
    met = many.select("fp", word.alias("word")).groupBy("word").agg(F.collect_list("fp").alias("fps"))
    stars = (
        met.filter("size(fps) > 1")
        .select(F.array_min("fps").alias("v"), F.explode("fps").alias("u")).filter("u > v").select("u", "v")
    )
    return pairs.unionByName(stars).distinct()


def groups(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, root): the smallest id that links lead to, itself included.

    ``root`` is a fingerprint that names the component, also where no member has an id.
    """
    fps = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    return linked_groups(fps, distinct, links(distinct))


def linked_groups(fps: DataFrame, distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """The columns of ``groups`` from rows, their distinct fingerprints with ``first_id``, and links."""
    roots = star_components(edges, [])
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = rooted.join(least, "root").select("fp", "component_id", "root")
    ids = distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    return fps.join(ids, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, words: int = 3) -> DataFrame:
    """One document of each group, that with the smallest id; all columns kept.

    Where rows of a group repeat that id, one of them stays.  Rows without an id stay: no
    other row can stand for them.
    """
    return keep_first(docs, groups(docs, words))


def keep_first(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """What ``keep_one`` keeps, for rows grouped as ``groups`` does."""
    own = grouped.filter("doc_id = component_id")
    by_id, by_text = fresh(docs, "id"), fresh(docs, "hash")
    kept = own.groupBy("doc_id", "root").agg(F.min("text_hash").alias("text_hash")).select(
        F.col("doc_id").alias(by_id), F.col("text_hash").alias(by_text)
    ).distinct()
    doc_id, text_hash = column(docs, "doc_id"), F.xxhash64(column(docs, "text"))
    named = docs.join(kept, (doc_id == kept[by_id]) & (text_hash == kept[by_text]), "left_semi")
    named = named.withColumn(by_text, text_hash).dropDuplicates(["doc_id", by_text]).drop(by_text)
    return named.unionByName(docs.filter(doc_id.isNull()))
