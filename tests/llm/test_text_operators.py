"""Scores, fingerprints, spans and benchmark items against brute force and on awkward rows."""

import random
import re

import numpy as np
import pytest
import xxhash

from geoloom.llm import boosting, decontaminate, golay, near_copies, pii, quality, secrets, simhash, toxicity
from geoloom.llm.common import map_rows, prefix_sums
from tests.llm.helpers import awkward, docs, empty, rows, shingles

VOCAB = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("ten", "sor", "vil", "dan", "gom", "hex", "wit")]


def prose(rng, n):
    return " ".join(rng.choices(VOCAB, k=n))


def labels(spark, flags, column):
    return spark.createDataFrame([(i, f) for i, f in enumerate(flags)], f"doc_id bigint, {column} int")


# -- toxicity, quality -----------------------------------------------------------


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(1)
    flags = [i % 4 == 0 for i in range(400)]
    texts = [prose(rng, 60) + (" you zorgling " + prose(rng, 20) + " zorgling blathide" if f else "") for f in flags]
    return docs(spark, texts), labels(spark, [int(f) for f in flags], "toxic"), flags


def test_toxicity_learns_from_labelled_texts(insults):
    d, l, flags = insults
    model = toxicity.fit(d, l)
    got = dict(rows(toxicity.scored(d, model), "doc_id", "score"))
    assert all((got[i] >= 0.5) == f for i, f in enumerate(flags))
    saved = model.dictionaries.distance()
    assert saved(b"zorgling") > 5 and saved(b"katen") <= 0
    assert toxicity.keep_ordinary(d, model).count() == flags.count(False)


def test_scores_of_awkward_rows(spark, insults):
    d, l, _ = insults
    odd = awkward(spark)
    toxic, good = toxicity.fit(d, l), quality.fit(d, l.withColumnRenamed("toxic", "quality"))
    for scored in (toxicity.scored(odd, toxic), quality.scored(odd, good)):
        out = scored.select("score").toPandas()["score"]
        assert len(out) == odd.count() and out.between(0, 1).all()
        assert scored.columns == odd.columns
    assert toxicity.scored(empty(odd), toxic).count() == quality.scored(empty(odd), good).count() == 0
    nobody = empty(l)
    assert set(toxicity.scored(d, toxicity.fit(d, nobody)).toPandas()["score"]) == {0.0}
    assert set(quality.scored(d, quality.fit(d, empty(l.withColumnRenamed("toxic", "quality")))).toPandas()["score"]) == {0.0}


def test_held_out_labels_are_not_read(insults):
    d, l, flags = insults
    from zlib import crc32

    turned = l.rdd.map(lambda r: (r[0], 1 - r[1] if crc32(str(r[0]).encode()) % 5 == 0 else r[1])).toDF(l.schema)
    a, b = (toxicity.fit(d, x) for x in (l, turned))
    assert a.dictionaries == b.dictionaries and np.array_equal(a.calibration.weights, b.calibration.weights)


def test_quality_votes_are_exact(spark):
    rng = random.Random(2)
    texts = [prose(rng, 50) if i % 3 else "| ".join(rng.choices(VOCAB, k=50)) for i in range(200)]
    d, l = docs(spark, texts), labels(spark, [int(i % 3 > 0) for i in range(200)], "quality")
    model = quality.fit(d, l)
    got = dict(rows(quality.scored(d, model), "doc_id", "score"))
    assert all((got[i] >= 0.3) == (i % 3 > 0) for i in range(200))
    v = model.latent(texts)
    for i in (0, 1, 77):
        cos = model.vectors @ v[i]
        near = np.argsort(-cos, kind="stable")[: quality.NEIGHBOURS]
        w = cos[near].clip(0) ** quality.SHARPNESS
        assert got[i] == pytest.approx((w * model.votes[near]).sum() / w.sum(), abs=1e-6)


# -- simhash -----------------------------------------------------------------------


def test_golay_words_two_bits_apart_share_a_codeword():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 1 << 23, 3000)
    row, index = golay.nearby(words)
    near = [set() for _ in words]
    for r, i in zip(row, index):
        near[r].add(int(i))
    assert {len(s) for s in near} == {1, 6}
    for flips in ((), (4,), (0, 22), (7, 8)):
        other = words ^ sum(1 << b for b in flips)
        row2, index2 = golay.nearby(other)
        shared = np.zeros(len(words), bool)
        for r, i in zip(row2, index2):
            shared[r] |= int(i) in near[r]
        assert shared.all()


def brute_fingerprint(text):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    low = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= 2 and low[j] < low[i]:
                    low[i], changed = low[j], True
    return low


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 1])
def test_links_connect_what_is_two_bits_apart(spark, bucket):
    rng = random.Random(4)
    fps = []
    for _ in range(12):
        seed = rng.getrandbits(64)
        for _ in range(25):
            fps.append(seed)
            for _ in range(rng.randint(0, 3)):
                seed ^= 1 << rng.randrange(64)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in set(signed)], "fp bigint")
    edges = simhash.links(distinct, bucket).collect()
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 2 for r in edges)
    low = {f: f for f in signed}
    for _ in range(len(low)):
        before = dict(low)
        for r in edges:
            low[r.u] = low[r.v] = min(low[r.u], low[r.v])
        if before == low:
            break
    want = brute_components(fps)
    got = {}
    for f, w in zip(signed, want):
        assert got.setdefault(w, low[f]) == low[f]
    assert len(set(got.values())) == len(got)


def test_groups_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "   "]
    for _ in range(15):
        t = prose(rng, 300)
        texts += [t, t, t.upper(), t + " " + prose(rng, 1)]
    d = docs(spark, texts, extra=True)
    got = rows(simhash.groups(d), "doc_id", "fp", "component_id")
    fps = [brute_fingerprint(t) for t in texts]
    low = brute_components(fps)
    assert {(r[0], r[1] % (1 << 64), r[2]) for r in got} == {(i, f, low[i]) for i, f in enumerate(fps)}
    kept = simhash.keep_one(d)
    assert {r[0] for r in rows(kept, "doc_id")} == set(low) and kept.columns == d.columns
    assert simhash.groups(empty(d)).count() == 0 == simhash.keep_one(empty(d)).count()


def test_near_copies_of_awkward_rows(spark):
    odd = awkward(spark)
    assert simhash.groups(odd).count() == odd.count()
    kept = [r[0] for r in rows(simhash.keep_one(odd), "doc_id")]
    assert kept.count(5) == 1 and 6 not in kept and kept.count(0) == 1 and 1 not in kept and kept.count(None) == 2


def test_long_texts_are_hashed_in_pieces():
    text = " ".join(VOCAB * 9000)
    assert len(text) > 2 * simhash.STEP
    pieces = list(simhash.shingle_hashes(text, 3))
    assert len(pieces) > 1
    assert np.concatenate(pieces).tolist() == [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 3)]


# -- decontamination -----------------------------------------------------------------


def brute_contained(texts, items, n=5, share=0.8):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    runs = lambda w: {" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    out = set()
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            want = runs(words(item))
            w, k = words(t), min(n, len(words(item)))
            have = {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}
            if want and len(want & have) >= share * len(want) - 1e-9:
                out.add((d, i, len(want), len(want & have)))
    return out


def test_contained_items_against_brute_force(spark):
    rng = random.Random(6)
    items = [prose(rng, n) for n in (3, 1, 4, 5, 6, 9, 14, 20, 33, 50, 90)] + [None, "", "..."]
    texts = [None, "", "...", items[0], items[0].upper(), prose(rng, 400)]
    for item in items[:11]:
        w = item.split()
        texts += [prose(rng, 150) + " " + item + " " + prose(rng, 300), item.replace(" ", ", ").upper(), " ".join(w[: len(w) * 9 // 10]), " ".join(w[: len(w) // 2])]
        w[len(w) // 2] = "xx"
        texts.append(prose(rng, 30) + " " + " ".join(w))
    d = docs(spark, texts, extra=True)
    b = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id bigint, text string, h string")
    got = decontaminate.contained(d, b)
    assert set(rows(got, "doc_id", "item_id", "item_runs", "shared_runs")) == brute_contained(texts, items)
    clean = decontaminate.clean(d, b)
    hit = {r[0] for r in brute_contained(texts, items)}
    assert {r[0] for r in rows(clean, "doc_id")} == set(range(len(texts))) - hit and clean.columns == d.columns
    assert decontaminate.contained(empty(d), b).count() == decontaminate.contained(d, empty(b)).count() == 0
    assert decontaminate.clean(d, empty(b)).count() == len(texts)


def test_decontamination_of_awkward_rows(spark):
    odd = awkward(spark)
    b = spark.createDataFrame([(1, "a b c d e f g"), (None, "A-b c d e f g"), (None, None)], "item_id bigint, text string")
    got = decontaminate.contained(odd, b)
    assert rows(got, "doc_id", "item_id") == sorted([(d, i) for d in (5, 6, None) for i in (1, None)], key=str)
    # Every row is decided by its own text: of the two rows without an id one stays.
    assert rows(decontaminate.clean(odd, b), "doc_id") == [(i,) for i in range(5)] + [(None,)]


# -- secrets, personal data -------------------------------------------------------------


def test_secret_base_spans_against_plain_patterns():
    rng = random.Random(7)
    parts = ["token", "API_KEY", "apikey", "Secret", "=", ": ", '"', "'", "AKIA", "abcdef0123456789" * 2, "ABCDEFGHIJKLMNOP", "x", " ", "é", "passwd", "ſecret", "toKen=", "deadbeef", "."]
    for _ in range(3000):
        t = "".join(rng.choices(parts, k=12))
        want = [("assign", *m.span()) for m in secrets.ASSIGN.finditer(t) if len(m[2]) >= 6]
        want += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        assert secrets.base_spans(t) == sorted(want, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_random_tokens_are_told_from_identifiers(spark):
    rng = random.Random(8)
    texts = [prose(rng, 80) for _ in range(60)]
    model = secrets.fit(docs(spark, texts))
    key = "sk-4eC39HqLyjWDarjtT1zdp7dcQz"
    base, every = model.spans(f"my key {key} and katenLosorMivilNedan2 too")
    assert base == [] and [s[0] for s in every] == ["random"] and every[0][1:] == (7, 7 + len(key))
    names = ["_".join(rng.choices(VOCAB, k=5)) + "1" for _ in range(500)]
    keys = ["".join(rng.choices(secrets.KEY_ALPHABETS[3], k=32)) for _ in range(500)]
    assert sum(model.llr(n) >= model.threshold for n in names) <= 5
    assert sum(model.llr(k) >= model.threshold for k in keys) >= 490
    odd = awkward(spark)
    assert secrets.found(odd, model).count() == odd.count()
    assert secrets.redact(odd, model).columns == odd.columns
    assert secrets.found(empty(odd), secrets.fit(empty(odd))).count() == 0
    d = docs(spark, [f'x token = "abcdef123456" y {key} z'])
    assert rows(secrets.redact(d, model), "text") == [('x [SECRET]" y [SECRET] z',)]


def brute_private(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub(r"\D", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]


def test_private_base_spans_against_plain_patterns():
    rng = random.Random(9)
    parts = ["0", "1", "25", "255", "300", ".", ".", "-", " ", "+", "@", "a", "Z", "é", "(", ")", "_", "mail", ".com", "4111111111111111", "+1 (017) 555-7713"]
    for _ in range(6000):
        t = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        assert pii.base_spans(t) == brute_private(t), t
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_boosted_candidates(spark):
    rng = random.Random(10)
    n = rng.randint
    texts = []
    for i in range(300):
        t = prose(rng, 30)
        texts.append([t, f"{t} call +1 ({n(200, 999)}) {n(200, 999)}-{n(1000, 9999)} now", f"{t} mail ab{i}.cd@mail{i}.example.com ok"][i % 3])
    model = pii.fit(docs(spark, texts))
    base, every = model.spans("please call me on 974-555-3436 today")
    assert base == [] and every == [("number", 18, 30)]
    assert model.spans("mail bob at example dot com now")[1]
    for plain in ("on 2023-05-12 we met", "version 1.2.3.400 came", "a total of 12,345,678 items", "ka ten at lo sor. Mi vil"):
        assert model.spans(plain) == ([], [])
    odd = awkward(spark)
    assert pii.found(odd, model).count() == odd.count() and pii.redact(odd, model).columns == odd.columns
    nothing = pii.fit(empty(odd))
    assert nothing.trees is None and pii.found(empty(odd), nothing).count() == 0
    assert rows(pii.redact(docs(spark, ["x a@b.cc y"]), model), "text") == [("x [EMAIL] y",)]


def test_boosting_fits_an_interaction():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = boosting.fit(x[:3000], y[:3000])
    assert ((model(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95


# -- helpers ---------------------------------------------------------------------------


def test_prefix_sums_over_blocks(spark):
    values = [(i * 7, (i * 13) % 11) for i in range(3000)]
    got = rows(prefix_sums(spark.createDataFrame(values, "at bigint, v bigint"), "at", {"before": "v"}), "at", "before")
    total, want = 0, []
    for at, v in values:
        want.append((at, total))
        total += v
    assert sorted(got) == want


def test_map_rows_keeps_types_on_empty_input(spark):
    df = spark.createDataFrame([], "a bigint")
    assert map_rows(df, lambda: lambda a: [(x, "y") for x in a], "a bigint, b string").collect() == []


# -- near copies -----------------------------------------------------------------------


def similar_components(texts):
    """Smallest position that links of five-word Jaccard similarity 0.8 or more lead to."""
    sets = [set(shingles(t, 5)) for t in texts]
    low = list(range(len(texts)))
    pairs = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 5 * len(a & b) >= 4 * len(a | b)]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if low[i] != low[j]:
                low[i] = low[j] = min(low[i], low[j])
                changed = True
    return low


@pytest.mark.parametrize("bucket", [near_copies.BUCKET, 2])
def test_near_copies_against_brute_force(spark, bucket):
    rng = random.Random(12)
    texts = [None, "", "one two", "One TWO", "one three"]
    for _ in range(12):
        w = prose(rng, rng.choice((60, 200, 500))).split()
        for changes in (0, 1, 2, 3, 5, 8, 12, 20):
            v = list(w)
            for at in rng.sample(range(len(v)), changes):
                v[at] = "changed"
            texts.append(" ".join(v))
    d = docs(spark, texts, extra=True)
    low = similar_components(texts)
    assert len(set(low)) < len(set(brute_components([brute_fingerprint(t) for t in texts])))
    got = rows(near_copies.groups(d, bucket=bucket), "doc_id", "component_id")
    assert got == sorted(enumerate(low), key=str)
    kept = near_copies.keep_one(d, bucket=bucket)
    assert {r[0] for r in rows(kept, "doc_id")} == set(low) and kept.columns == d.columns
    assert near_copies.keep_one(empty(d)).count() == 0
    odd = awkward(spark)
    ids = [r[0] for r in rows(near_copies.keep_one(odd), "doc_id")]
    assert ids.count(5) == 1 and 6 not in ids and ids.count(0) == 1 and 1 not in ids and ids.count(None) == 2


# -- class proportions -----------------------------------------------------------------


def test_toxicity_scores_do_not_follow_the_bounds_of_the_sample(spark):
    rng = random.Random(13)
    flags = [i % 10 == 0 for i in range(3000)]
    # The telling word occurs in ordinary texts too, so that scores are not all 0 or 1.
    texts = [prose(rng, 30) + (" zorgling" if rng.random() < (0.9 if f else 0.1) else "") for f in flags]
    d, l = docs(spark, texts), labels(spark, [int(f) for f in flags], "toxic")
    for bounds in ((3000, 4500), (3000, 300)):
        out = toxicity.scored(d, toxicity.fit(d, l, *bounds)).select("score").toPandas()["score"]
        assert 0.06 < out.mean() < 0.15, bounds


def test_all_of_a_long_window_is_scored(spark, insults):
    d, l, _ = insults
    saved = toxicity.fit(d, l).dictionaries.distance()
    for n in (0, 1, 19, 20, 39, 40, 41, 97):
        run = "kavil" * n
        assert toxicity.features(run + "zorgling" + run, saved)[0] >= 4 > toxicity.features(run + "katen" + run, saved)[0], n
    window = bytes(range(97, 123)) * 9
    parts = toxicity.pieces(window)
    assert max(map(len, parts)) <= toxicity.LONGEST_WINDOW and all(any(window[i : i + 20] in p for p in parts) for i in range(len(window) - 19))


def test_toxicity_of_texts_without_blanks(spark):
    rng = random.Random(14)
    signs = [chr(c) for c in range(0x4E00, 0x4E50)]
    flags = [i % 4 == 0 for i in range(400)]
    text = lambda n: "".join(rng.choices(signs, k=n))
    texts = [text(rng.randint(40, 60)) + ("龘龙龚" if f else "") + text(20) for f in flags]
    d, l = docs(spark, texts), labels(spark, [int(f) for f in flags], "toxic")
    got = dict(rows(toxicity.scored(d, toxicity.fit(d, l)), "doc_id", "score"))
    assert sum((got[i] >= 0.5) == f for i, f in enumerate(flags)) >= 396


# -- accounts and hexadecimal addresses ------------------------------------------------


def test_every_generator_can_add_a_span(spark):
    rng = random.Random(15)
    n = rng.randint
    texts = []
    for i in range(300):
        t = prose(rng, 30)
        texts.append([t, f"{t} call +1 ({n(200, 999)}) {n(200, 999)}-{n(1000, 9999)} now", f"{t} mail ab{i}.cd@mail{i}.example.com ok"][i % 3])
    model = pii.fit(docs(spark, texts))
    for kind, span in [
        ("account", "DE89370400440532013000"), ("account", "GB82 WEST 1234 5698 7654 32"), ("account", "FR1420041010050500013M02606"),
        ("hexaddress", "2001:db8:85a3:8d3:1319:8a2e:370:7348"), ("hexaddress", "fe80:1:2:3::7b"), ("hexaddress", "00:1B:44:11:3A:B7"),
        ("address", "bob at example dot com"),
    ]:
        text = f"katen losor {span} milvil negom"
        assert (kind, 12, 12 + len(span)) in model.spans(text)[1], span
    for plain in ("DE88370400440532013000", "AB12 CD34 EF56 GH78 JK90", "01:23:45:12", "4:3:2:1", "a:b:c:d"):
        assert model.spans(f"katen losor {plain} milvil negom") == ([], []), plain
