"""Ranked search, balanced mixing and fill-in-middle."""

import math
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import balanced, infill, lexical
from tests.llm.helpers import awkward, docs, empty, rows

# -- ranked search -------------------------------------------------------------------------


def brute_ranking(texts, items, k):
    """[(item, [(score, doc), ...])] with plain loops; the documents' ids are their positions."""
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    found = [split(t) for t in texts]
    n_docs, length = sum(bool(f) for f in found), sum(map(len, found))
    df = Counter(t for f in found for t in set(f))
    out = {}
    for i, item in enumerate(items):
        scored = []
        for d, f in enumerate(found):
            tf = Counter(f)
            score = 0
            for t in set(split(item)):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 50 + (50 * len(f) * n_docs) // length
                    score += w * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m))
            if score > 0:
                scored.append((-score, d))
        out[i] = [(d, -s) for s, d in sorted(scored)[:k]]
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "of", "and"] * 30 + [f"w{i}" for i in range(60)] * 3 + [f"rare{i}" for i in range(300)] + ["Ärger", "naïve", "日本"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 20, 80]))) for _ in range(n)]
    # A third of the rows are copies, some texts are empty or have no terms.
    texts += [texts[0]] * (n // 2) + ["", None, "... --", "THE The the"]
    items = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 12]))) for _ in range(25)] + [texts[0], "", None, "absent", "the of and"]
    return texts, items


@pytest.mark.parametrize("block, most_terms, k", [(4, 200_000, 5), (64, 60, 50), (2, 200_000, 1)])
def test_ranking_against_brute_force(spark, block, most_terms, k):
    texts, items = corpus(block, 240)
    table = docs(spark, texts, extra=True).repartition(5)
    asked = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").withColumn("score", F.lit("x"))
    want = brute_ranking(texts, items, k)
    got = {}
    for r in lexical.search(table, asked, k, block, most_terms).orderBy("item_id", "rank").collect():
        got.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
        assert r["rank"] == len(got[r["item_id"]])
    assert got == {i: v for i, v in want.items() if v}


def test_blocks_are_skipped_and_bounds_hold(spark):
    texts, items = corpus(9, 240)
    number = {t: i for i, t in enumerate(sorted({t for x in items for t in lexical.terms(x)}))}
    counts = lexical.counted(docs(spark, texts), number)
    weights = np.full(len(number), 7, dtype=np.int64)
    shifts = np.arange(len(number)) % 2 * 3
    posted = lexical.placed(counts, weights, np.full(len(number), 0.1), shifts, 100, 1000, 6)
    tops = {(r["shift"], r["node"], r["id"]): r["top"] for r in lexical.summaries(posted, [0, 3, 6]).collect()}
    want = {}
    for r in posted.collect():
        for i, part, node in zip(r["ids"], r["parts"], r["nodes"]):
            assert node == r["code"] >> shifts[i]
            for s in (0, 3, 6):
                key = (s, r["code"] >> s, i)
                want[key] = max(want.get(key, 0), part)
    assert tops == want


def test_ranking_with_crowded_and_other_codes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CROWD", 8)
    texts, items = corpus(4, 120)
    texts = texts + 60 * [texts[0] + " " + items[0]]  # a third of all rows has one code
    asked = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {}
    for r in lexical.search(docs(spark, texts), asked, 5, 4).orderBy("item_id", "rank").collect():
        got.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
    best = brute_ranking(texts, items, 5)
    assert got == {i: v for i, v in best.items() if v}


def test_ranking_of_awkward_rows(spark):
    table = awkward(spark)
    asked = spark.createDataFrame([(1, "word7 a b"), (1, "word7 a b"), (None, "one"), (3, None), (4, "")], "item_id bigint, text string")
    got = rows(lexical.search(table, asked, 50), "item_id", "doc_id", "score")
    # Repeated items are searched each by itself, repeated rows are found each by itself.
    texts = [(r["doc_id"], r["text"]) for r in table.collect()]
    best = brute_ranking([t for _, t in texts], ["word7 a b", "one"], 50)
    want = 2 * [(1, texts[d][0], s) for d, s in best[0]] + [(None, texts[d][0], s) for d, s in best[1]]
    assert got == sorted(want, key=str)
    assert lexical.search(empty(table), asked).count() == 0
    assert lexical.search(table, asked.limit(0)).count() == 0


# -- balanced mixing -------------------------------------------------------------------------


def brute_targets(sizes):
    """Targets by sharing the excess again and again; ``sizes``: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole >= 2 * sizes[s]}
        if not over:
            out.update({s: left * weight[s] / whole for s in open_})
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(4)
    data = []
    for i in range(5000):
        source = rng.choice(["a"] * 6 + ["b", "b", "c", "é", "Z", None])
        data.append((i, None if i % 97 == 0 else " ".join("w" for _ in range(rng.choice([0, 1, 30, 300]))), source, "x"))
    data += [(7777, "one two three", "a", "x")] * 2500
    table = spark.createDataFrame(data, "doc_id bigint, text string, source string, p string")
    out = balanced.mix(table, block=256).collect()
    assert len(out) == len(data)
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    want = brute_targets(sizes)
    number = Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        number[r["source"]] += r["times"] * (r["size"] > 0)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1 + 0.002 * t
        documents = sum(1 for r in out if r["source"] == s and r["size"] > 0)
        assert abs(number[s] - t / sizes[s] * documents) <= 5
    again = balanced.mix(table.repartition(13), block=256)
    assert rows(again, "doc_id", "size", "source", "taken") == sorted(((r["doc_id"], r["size"], r["source"], r["taken"]) for r in out), key=str)


def test_flight_keeps_totals_and_expectations():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 500, 60).astype(float)
    start = rng.random(60)
    hits = np.zeros(60)
    for _ in range(3000):
        p = start.copy()
        live = balanced.flight(p, size, rng)
        assert len(live) <= 2 and p.sum() == pytest.approx(start.sum()) and (p * size).sum() == pytest.approx((start * size).sum())
        hits += p
    assert np.abs(hits / 3000 - start).max() < 0.06


def test_mix_of_awkward_rows(spark):
    out = balanced.mix(awkward(spark))
    assert out.count() == awkward(spark).count()
    assert rows(out.filter("size = 0").select("taken").distinct(), "taken") == [(0,)]
    assert balanced.mix(empty(awkward(spark))).count() == 0
    hollow = balanced.mix(docs(spark, ["", None, " "]))
    assert rows(hollow.select("size", "target", "taken").distinct(), "size", "target", "taken") == [(0, 0.0, 0)]


# -- fill-in-middle -----------------------------------------------------------------------------

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def brute_infill(doc_id, text):
    text = text or ""
    tokens = UNIT.findall(text)
    n = len(tokens)
    digest = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def messy(rng, n):
    return "".join(rng.choice(["a", "bc", "é", "日本", "😀", " ", "  ", "\n", "\t ", " ", "<", "<S", "P>", "word"]) for _ in range(n))


def test_infill_against_brute_force(spark):
    rng = random.Random(2)
    shared = messy(rng, 900)
    texts = ["", None, " ", "x", " x ", "x\n", "a<P>b", "<S>", "a <M> b", "  a  b  "] + [messy(rng, rng.randint(1, 60)) for _ in range(200)]
    texts += [messy(rng, rng.randint(0, 300)) + shared + messy(rng, rng.randint(0, 300)) for _ in range(60)] + ["x" * 40_000 + " y", " " * 30_000]
    out = infill.transformed(docs(spark, texts, extra=True)).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(texts)
    forms = Counter()
    for r in out:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute_infill(r["doc_id"], texts[r["doc_id"]])
        assert r["back"] == (texts[r["doc_id"]] or "")
        forms[r["form"]] += 1
    assert min(forms[f] for f in ("plain", "spm", "psm")) > 5


def test_chunks_follow_the_content_and_are_shared():
    rng = random.Random(3)
    shared = messy(rng, 4000)
    chunks = infill.Chunks()
    for _ in range(20):
        text = messy(rng, rng.randint(0, 200)) + shared + messy(rng, 50)
        data = text.encode()
        starts = infill.chunk_starts(data)
        assert starts == sorted(set(starts)) and starts[0] == 0 and starts[-1] == len(data)
        assert "".join(data[a:b].decode() for a, b in zip(starts, starts[1:])) == text
        places = infill.Places(data, chunks)
        ends = np.cumsum([0] + [len(u) for u in UNIT.findall(text)]).tolist()
        assert places.tokens == len(ends) - 1 and [places.end(k) for k in range(len(ends))] == ends
    assert chunks.hits > 10 * chunks.misses / 20


def test_a_full_cache_is_forgotten_and_changes_nothing(monkeypatch):
    monkeypatch.setattr(infill, "CACHE_BYTES", 2_000)
    rng = random.Random(6)
    one = infill.transformer()
    for i in range(50):
        text = messy(rng, 500)
        assert one(i, text) == brute_infill(i, text)


def test_infill_of_awkward_rows(spark):
    table = awkward(spark)
    out = infill.transformed(table)
    want = [(r["doc_id"], *brute_infill(r["doc_id"], r["text"])) for r in table.collect()]
    assert rows(out, *out.columns) == sorted(want, key=str)
    assert infill.transformed(empty(table)).count() == 0


def test_quality_ties_and_weights(spark):
    """The first columns win ties, and a sample's bounds do not move the share of good labels."""
    from geoloom.llm import quality

    c = np.random.default_rng(0).integers(0, 6, (50, 40)).astype(float)
    for k in (1, 5, 40):
        assert (quality.nearest(c, k) == np.sort(np.argsort(-c, axis=1, kind="stable")[:, :k], axis=1)).all()
    texts = [f"words of document {i % 7} and more {'good' if i % 4 else 'bad'}" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)], "doc_id long, quality int")
    whole, part = quality.fit(docs, labels), quality.fit(docs, labels, low_rows=20, high_rows=20)
    assert abs(whole.share - part.share) < 1e-12 and abs(whole.share - 0.75) < 0.05
    # Equal votes in the bounded sample stand for more good rows than bad ones.
    assert set(np.round(part.stands_for[part.votes == 1] / part.stands_for[part.votes == 0][0], 6)).pop() > 2
