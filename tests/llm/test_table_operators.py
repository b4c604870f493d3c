"""Archives, neighbours, packing, token counts and the pipeline."""

import gzip
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from geoloom.llm import neighbours, packing, queries, secrets, token_counts, toxicity, warc
from geoloom.llm.common import shared_path
from geoloom.llm.tokens import BYTE_BPE, encoder
from tests.compare import compare
from tests.llm.helpers import awkward, docs, empty, rows
from tests.llm.test_text_operators import brute_contained, prose, similar_components

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def exact_ids(text):
    return EXACT.encode(text or "", add_special_tokens=False).ids


# -- registered SQL ------------------------------------------------------------------


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, sf, con, name):
    assert compare(queries.QUERIES[name](spark, sf), con, queries.ORACLES[name]) == []


# -- tokens ----------------------------------------------------------------------------


def test_word_cache_gives_the_tokenizers_ids(spark, sf):
    encode = encoder(BYTE_BPE)
    odd = ["", " ", "  a", "a  b", "a \n b", "a\n\nb c", " a b ", "don't  it's", "é à b", "日本 語", "x<|endoftext|>y z", "1 22  333", "a\t b", "…  — b", " a b"]
    texts = odd + [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for t in texts:
        assert np.frombuffer(encode(t), dtype="<u4").tolist() == exact_ids(t), t[:50]
    assert encode(None) == b""


def test_length_curve_against_brute_force(spark):
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(0, 60)) for _ in range(150)] + [None, "", "a", "a"]
    lens = [len(exact_ids(t)) for t in texts]
    curve = token_counts.curve(token_counts.histogram(docs(spark, texts, extra=True)))
    got = {r["length"]: r for r in curve.collect()}
    assert set(got) == set(lens)
    for n, r in got.items():
        assert r["documents"] == lens.count(n) and r["tokens"] == n * lens.count(n)
        assert r["documents_at_most"] == sum(x <= n for x in lens) and r["documents_longer"] == sum(x > n for x in lens)
        assert r["tokens_longer"] == sum(x for x in lens if x > n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lens) and r["lost_tokens"] == sum(max(0, x - n) for x in lens)
        assert r["quantile"] == pytest.approx(sum(x <= n for x in lens) / len(lens))
    for limit in (0, 1, 17, 64, 10_000):
        assert token_counts.truncated_total(curve, limit).first()[0] == sum(min(x, limit) for x in lens)
    quantiles = dict(rows(token_counts.length_quantiles(curve, [0.5, 0.9, 1.0]), "share", "length"))
    for share, n in quantiles.items():
        assert n == next(x for x in sorted(lens) if sum(y <= x for y in lens) >= share * len(lens) - 1e-9)
    assert token_counts.curve(token_counts.histogram(empty(docs(spark, ["a"])))).count() == 0
    assert token_counts.histogram(awkward(spark)).agg({"documents": "sum"}).first()[0] == awkward(spark).count()


# -- packing ---------------------------------------------------------------------------


def check_packing(pieces, wanted, length):
    """Every document's ids in order and once, sequences gapless, only the last one short."""
    spans = {}
    for p in pieces:
        spans.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for s, parts in spans.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or s == max(spans) and at <= length
    assert set(spans) == set(range(len(spans)))
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert set(by_doc) == set(wanted)
    for d, parts in by_doc.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            ids = np.array(wanted[d][p["start"] : p["start"] + p["length"]], dtype="<u4").tobytes()
            assert p["start"] == at and p["doc_tokens"] == len(wanted[d]) and p["ids_crc32"] == zlib.crc32(ids) and bytes(p["ids"]) == ids
            at += p["length"]
        assert at == len(wanted[d])


@pytest.mark.parametrize("targets", [None, {"src0": 5, "src1": 2, "src2": 1}])
def test_packing_round_trip_and_mixture(spark, targets):
    rng = random.Random(2)
    texts = [prose(rng, rng.choice((1, 5, 80, 900))) for _ in range(120)] + [None, ""]
    d = docs(spark, texts, extra=True).repartition(4)
    pieces = packing.pack(d, length=64, window=512, targets=targets).collect()
    check_packing(pieces, {i: [*exact_ids(t), 0] for i, t in enumerate(texts)}, 64)
    sizes = {}
    for p in pieces:
        sizes[p["round"], p["source"]] = sizes.get((p["round"], p["source"]), 0) + p["length"]
    total = {s: sum(n for (_, x), n in sizes.items() if x == s) for s in ("src0", "src1", "src2")}
    rounds = max(r for r, _ in sizes) + 1
    for (r, s), n in sizes.items():
        if targets is None:
            assert abs(n - total[s] / rounds) <= 1
        elif sum(m for (q, x), m in sizes.items() if x == s and q > r):
            assert abs(n - 512 * targets[s] / 8) <= 1


def test_small_queues_are_spread(spark):
    tiny = [(i, "a b c", "en", f"rare{i}", 5) for i in range(20)]
    big = [(100 + i, prose(random.Random(i), 400), "en", "big", 1) for i in range(10)]
    d = spark.createDataFrame(tiny + big, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    pieces = packing.pack(d, length=32, window=64).collect()
    check_packing(pieces, {r[0]: [*exact_ids(r[1]), 0] for r in tiny + big}, 32)


def test_packing_of_awkward_rows(spark):
    odd = awkward(spark)
    pieces = packing.pack(odd, length=128).collect()
    assert sum(p["length"] for p in pieces) == sum(len(exact_ids(r["text"])) + 1 for r in odd.select("text").collect())
    assert packing.pack(empty(odd)).count() == 0


# -- archives --------------------------------------------------------------------------


def pages(spark):
    same, small = "<p>é " + "x" * 120, "<p>short"
    data = [
        (5, "http://a/1", same), (3, "http://a/\r\n2", same), (9, None, same), (3, "http://a/3", same), (None, "http://a/4", same),
        (1, "http://b/1", small), (2, "http://b/2", small), (4, "http://c/1", None), (6, "http://c/2", ""),
        (7, "http://d/1", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9), (8, "http://e", "y" * 3_000_000),
    ]
    return data, spark.createDataFrame([(*r, "z", "z") for r in data], "page_id bigint, url string, html string, n bigint, original string".replace("n bigint", "n string"))


def test_archives_round_trip(spark):
    data, df = pages(spark)
    path = shared_path(spark, "warc")
    warc.write(df, path, per_archive=3)
    recs = warc.read(spark, path)
    got = warc.resolve_revisits(recs).collect()
    assert len(got) == len(data) and all(r["ok"] for r in got)
    ids = [r[0] for r in data]
    want = []
    for i, _, html in data:
        raw = (html or "").encode()
        first = min(j for j, _, h in data if j is not None and (h or "") == (html or ""))
        again = len(raw) >= 100 and i is not None and i > first
        want.append((i, len(raw), "revisit" if again else "response", first if again else None))
    assert sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got), key=str) == sorted(want, key=str)
    assert sorted(i for i in ids if i) == sorted(r["page_id"] for r in got if r["page_id"])
    raw = b"".join(gzip.decompress(r[0]) for r in spark.read.format("binaryFile").load(path).filter("path like '%.gz'").select("content").collect())
    assert raw.count(b"y" * 3_000_000) == 1 and raw.count("<p>é ".encode()) == 3
    members = gzip.compress(b"WARC/1.0\r\nWARC-Type: x\r\nContent-Length: 2\r\n\r\nab\r\n\r\n") * 2
    assert [b for _, b in warc.parsed(warc._inflated(members))] == [b"ab", b"ab"]
    with pytest.raises(ValueError):
        list(warc.parsed(iter([b"WARC/1.0\r\nContent-Length: 9\r\n\r\nab"])))


def test_no_pages_no_records(spark):
    _, df = pages(spark)
    assert warc.resolved(empty(df)).count() == 0


# -- neighbours ------------------------------------------------------------------------


def brute_neighbours(vectors, ids, query, k):
    x = np.array(vectors, dtype=np.float64)
    d = np.sqrt(((x - x[ids.index(query)]) ** 2).sum(1))
    order = sorted((dist, i) for dist, i in zip(d, ids) if i != query)
    return [(i, dist) for dist, i in order[:k]]


def test_hilbert_neighbours_are_adjacent_cells():
    cells = np.array(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1).T
    keys = neighbours.hilbert(cells, 3)
    order = cells[np.argsort(keys)]
    assert sorted(keys) == list(range(512)) and (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(3)
    # Three real dimensions in sixteen, so that windows are narrow.
    x = (rng.normal(size=(9000, 3)) @ rng.normal(size=(3, 16))).astype(np.float32)
    x[100:400] = x[99]
    ids = list(range(1, 9001))
    data = [(i, v.tolist(), "z") for i, v in zip(ids, x)]
    bad = [(9101, None, "z"), (9200, [0.0] * 16, "z"), (9300, [float("nan")] * 16, "z"), (9400, [1.0, None] * 8, "z"), (9500, [1.0], "z"), (None, [1.0] * 16, "z"), (200, x[199].tolist(), "z")]
    df = spark.createDataFrame(data + bad, "vec_id bigint, embedding array<float>, key string")
    index = neighbours.fit(x[:4000].astype(float), 10)
    assert index.share < 0.5 and len(index.axes) == neighbours.CURVES
    got = {}
    for q, r, v, s in rows(neighbours.search(df, df["vec_id"] % 100 == 0), "query_id", "rank", "vec_id", "score"):
        got.setdefault(q, {})[r] = (v, s)
    assert set(got) == set(range(100, 9001, 100))
    hits = 0
    for q, found in got.items():
        want = brute_neighbours(x, ids, q, 10)
        assert sorted(found) == list(range(1, 11))
        hits += len({v for v, _ in found.values()} & {v for v, _ in want})
        for v, s in found.values():
            assert s == pytest.approx(np.sqrt(((x[v - 1].astype(float) - x[q - 1]) ** 2).sum()), abs=1e-12)
    assert hits >= 0.9 * 10 * len(got)
    same = [v for _, (v, _) in sorted(got[200].items())]
    assert same == list(range(100, 110))


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(100, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None)], "vec_id bigint, embedding array<float>")
    assert [r[:3] for r in rows(neighbours.search(df, df["vec_id"] % 100 == 0), "query_id", "rank", "vec_id")] == [(100, 1, 2)]
    assert neighbours.search(empty(df), df["vec_id"] % 100 == 0).count() == 0


# -- pipeline ----------------------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark, sf):
    tables = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels", "benchmark")}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontaminate", "secrets", "packing"]
    d = tables["documents"]
    model = toxicity.fit(d, tables["labels"])
    low = {r[0] for r in rows(toxicity.scored(d, model).filter("score < 0.5"), "doc_id")}
    one = stages["toxicity"](spark, d, sf)
    assert {r[0] for r in rows(one, "doc_id")} == low and one.columns == d.columns
    two = stages["near_duplicates"](spark, one, sf)
    given = rows(one, "doc_id", "text")
    least = {}
    for (i, _), group in zip(given, similar_components([t for _, t in given])):
        least[group] = min(i, least.get(group, i))
    assert {r[0] for r in rows(two, "doc_id")} == set(least.values())
    texts = rows(two, "doc_id", "text")
    items = [r[0] for r in tables["benchmark"].orderBy("item_id").select("text").collect()]
    three = stages["decontaminate"](spark, two, sf)
    hit = {texts[i][0] for i, *_ in brute_contained([t for _, t in texts], items)}
    assert {r[0] for r in rows(three, "doc_id")} == {i for i, _ in texts} - hit
    four = stages["secrets"](spark, three, sf)
    assert four.columns == d.columns and four.count() == three.count()
    before = dict(rows(three, "doc_id", "text"))
    for i, text, n in rows(four, "doc_id", "text", "n_chars"):
        assert n == len(text) and not secrets.base_spans(text) and (text == before[i] or secrets.base_spans(before[i]))
    five = stages["packing"](spark, four, sf)
    assert {r[0] for r in rows(five, "doc_id")} == {r[0] for r in rows(four, "doc_id")}
    # Queue positions depend on how Spark dealt out the files, so cuts may fall elsewhere.
    whole = rows(corpus_pipeline.run(spark, sf), "doc_id", "length")
    assert {i for i, _ in whole} == {r[0] for r in rows(four, "doc_id")}
    assert sum(n for _, n in whole) == sum(n for _, n in rows(five, "doc_id", "length"))
