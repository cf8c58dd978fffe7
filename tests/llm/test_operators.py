"""Operators against brute force on small tables that hold nulls, empty texts, ties, repeated rows and clashing columns."""

import gzip
import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandframe.llm import additive_ann, decontaminate, karmarkar_karp, minhash_dedup, mixing, pii, quality, relative_lz, suffix_dedup, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc long, value string, chunk long"


def texts():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    made = [" ".join(word() for _ in range(r.randint(1, 90))) for _ in range(40)]
    out = [*made, None, "", " \t\n", "one two", "One TWO", "a " * 300, "b" * 400, made[3], made[3].upper()]
    for i in range(25):
        base = made[r.randrange(40)].split()
        at = r.randrange(len(base) + 1)
        out.append(" ".join(base[:at] + [word()] * r.randint(0, 1) + base[at:]))
        out.append(made[r.randrange(40)] + " " + made[r.randrange(40)])
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}", None, i, "x", 1) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(rows, units, size, within):
    first: dict = {}
    for i, t in rows:
        u = units(t)
        for j in range(len(u) - size + 1):
            first.setdefault(tuple(u[j : j + size]), (i, j))
    out = {}
    for i, t in rows:
        u = units(t)
        gone = [False] * len(u)
        for j in range(len(u) - size + 1):
            f = first[tuple(u[j : j + size])]
            if f < (i, j) if within else f[0] < i:
                gone[j : j + size] = [True] * size
        out[i] = (len(u), sum(gone), [x for x, g in zip(u, gone, strict=True) if not g])
    return out


def test_repeated_bytes(docs):
    want = brute(list(enumerate(texts())), lambda t: (t or "").encode(), 50, False)
    got = {r.doc_id: (r.n_bytes, r.n_removed, list(r.kept)) for r in suffix_dedup.remove_repeated_bytes(docs).collect()}
    assert got == want


def test_bytes_that_a_document_repeats_and_an_earlier_one_holds(spark):
    r = random.Random(8)
    make = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    rows = []
    for i in range(60):
        p, y = make(r.randint(51, 200)), make(r.randint(10, 150))
        cut = r.randint(0, len(p) - 51)
        rows += [(2 * i, p[cut:] + make(90)), (2 * i + 1, p + y + p + y)]
    want = brute(rows, lambda t: t.encode(), 50, False)
    got = {x.doc_id: (x.n_bytes, x.n_removed, list(x.kept)) for x in suffix_dedup.remove_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_repeated_words_and_factors(docs):
    rows = suffix = relative_lz.remove_repeated_words(docs).collect()
    want = brute(list(enumerate(texts())), lambda t: (t or "").encode().split(), 20, True)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept.split()) for r in rows} == want
    all_words = [(t or "").split() for t in texts()]
    for r in suffix:
        for f in r.factors:
            own = all_words[r.doc_id][f.start : f.start + f.length]
            assert len(own) >= 20 and own == all_words[f.source_doc][f.source_start : f.source_start + f.length]


def shingle_sets():
    out = []
    for t in texts():
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def test_near_duplicates(docs):
    sets = shingle_sets()
    label = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j in range(i):
                n = len(a & sets[j])
                if n and 100 * n >= 75 * (len(a) + len(sets[j]) - n):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == {i: (len(s), label[i], label[i] == i) for i, s in enumerate(sets)}


def test_shards(docs):
    rows = karmarkar_karp.shards(docs, 5, block=16).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts())))
    sums = Counter()
    places: dict = {}
    for r in rows:
        sums[r.shard] += r.size
        places.setdefault(texts()[r.doc_id] or "", set()).add(r.shard)
    assert max(sums.values()) - min(sums.values()) <= 0.02 * sum(sums.values())
    assert all(len(x) == 1 for x in places.values())
    for k in range(5):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))


def best_spread(sizes, k):
    """The least difference between the largest and the least shard, by trying all."""
    best = None
    for places in itertools.product(range(k), repeat=len(sizes)):
        sums = [0] * k
        for s, p in zip(sizes, places, strict=True):
            sums[p] += s
        if best is None or max(sums) - min(sums) < best:
            best = max(sums) - min(sums)
    return best


def test_differencing_is_near_the_optimum():
    r = random.Random(3)
    assert sorted(karmarkar_karp.difference([[x] for x in (4, 5, 6, 7, 8)], 2)[0]) == [14, 16]
    for _ in range(30):
        sizes = [r.randint(1, 60) for _ in range(8)]
        sums, places = karmarkar_karp.difference([[x] for x in sizes], 3)
        own = [0] * 3
        for s, p in zip(sizes, places, strict=True):
            own[p[0]] += s
        assert own == sums and sum(own) == sum(sizes)
        assert max(sums) - min(sums) <= best_spread(sizes, 3) + max(sizes) // 2


def test_base_spans():
    t = "a@b.c, x.y@z.co.uk 1.2.3.4.5 300.1.1.1, 4111 1111-1111 1111 +1 (203) 555-0199."
    assert [(t[s:e], pii.KINDS[k]) for s, e, k in pii.base_spans(t)] == [("a@b.c", "email"), ("x.y@z.co.uk", "email"), ("1.2.3.4", "ip"), ("4111 1111-1111 1111", "card"), ("+1 (203) 555-0199", "phone")]


def test_context_finds_unseen_identifiers(spark):
    rows = [(i, f"filler write to me: u{i}@mail.org now") for i in range(9)] + [(9, "filler write to me: u9@mail now"), (10, None)]
    got = {r.doc_id: [(x.start, x.end, x.kind) for x in r.found] for r in pii.find_personal(spark.createDataFrame(rows, "doc_id long, text string"), seeds=1).collect()}
    assert len(got) == 11 and got[10] == []


def test_context_finds_other_shapes(spark):
    rows = [(i, f"filler write to me: u{i}@mail.org now") for i in range(9)] + [(9, "filler write to me: u9@mail now")]
    rows += [(20 + i, f"please call at +1 203 555 01{i}{i} today") for i in range(9)] + [(29, "please call at 203 555 0199 today"), (30, "we saw 203 555 0199 birds")]
    got = {r.doc_id: [(rows[n][1][x.start : x.end], x.kind) for x in r.found] for r in pii.find_personal(spark.createDataFrame(rows, "doc_id long, text string")).collect() for n in [[d for d, _ in rows].index(r.doc_id)]}
    assert {d: x for d, x in got.items() if x} == {9: [("u9@mail", "email")], 29: [("203 555 0199", "phone")]}


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é" + "x" * 2000
    rows = [(1, "http://a.b/c", big, "q"), (2, None, big, "q"), (3, "https://d.e", "small", "q"), (4, "http://f", None, "q"), (5, "http://g/h i", "small\r\n\r\nWARC/1.1\r\n", "q")]
    path = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string, digest string"), str(tmp_path / "w"))
    got = warc.captures(warc.read_records(spark, path)).collect()
    assert len(got) == 5 and all(r.request and r.metadata for r in got)
    by = {re.search(rb"pageId: (\d+)", r.metadata.block)[1]: r.response for r in got}
    assert by[b"1"].type == "revisit" and by[b"2"].type == "response" and by[b"1"].refers_to == by[b"2"].id
    assert by[b"2"].block.partition(b"\r\n\r\n")[2] == big.encode()
    assert by[b"5"].block.partition(b"\r\n\r\n")[2] == b"small\r\n\r\nWARC/1.1\r\n"
    assert by[b"1"].payload_digest == hashlib.sha1(big.encode()).hexdigest()


def test_warc_classes_of_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 30_000)
    monkeypatch.setattr(warc, "FILE_RECORDS", 9)
    rows = [(i, "http://a", "x" * n) for i, n in enumerate([0, 5, 9000, 20_000, 300_000, 999, 1000, 1000])]
    path = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1), str(tmp_path / "w"))
    assert len(list((tmp_path / "w").iterdir())) >= 2
    got = warc.captures(warc.read_records(spark, path)).collect()
    assert sorted(len(r.response.block.partition(b"\r\n\r\n")[2]) for r in got) == sorted([0, 5, 9000, 20_000, 300_000, 999, 1000, 0])


def test_warc_empty_and_odd_archives(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.captures(warc.read_records(spark, warc.write_warc(none, str(tmp_path / "none")))).count() == 0
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "a.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record.replace(b"<a>", b"<b>")))
    (tmp_path / "odd" / "b.warc").write_bytes(record.replace(b"<a>", b"<c>"))
    assert sorted((r.id, r.block) for r in warc.read_records(spark, str(tmp_path / "odd")).collect()) == [("<a>", b"abc"), ("<b>", b"abc"), ("<c>", b"abc")]
    (tmp_path / "odd" / "b.warc").write_bytes(record[:-6])
    with pytest.raises(Exception):  # noqa: B017
        warc.read_records(spark, str(tmp_path / "odd")).collect()


def test_decontamination(spark):
    r = random.Random(1)
    item = [" ".join("".join(r.choice("abcdef") for _ in range(5)) for _ in range(30)) for _ in range(4)]
    near = item[1].split()
    near[0] = "zzz"
    rows = [(0, "x y z " + item[0].upper() + " end"), (1, " ".join(near)), (2, " ".join(item[2].split()[:14])), (3, None), (4, ""), (None, item[3])]
    items = spark.createDataFrame([(i, t, "t") for i, t in enumerate(item)] + [(9, None, "t")], "item_id long, text string, doc_id string")
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert {(x.doc_id, x.item_id, x.start) for x in got} == {(0, 0, 3), (1, 1, 0), (None, 3, 0)}
    assert next(x for x in got if x.doc_id == 1).similarity == pytest.approx(25 / 27)


def test_decontamination_between_offsets(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijklm") for _ in range(6))
    items = [[word() for _ in range(n)] for n in range(46, 53)]
    docs = [["x", "y", *[word()], *t[1 : len(t) // 2], word(), word(), *t[len(t) // 2 : -1], word(), "z", "z"] for t in items]
    count = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    want = {}
    for i, (d, t) in enumerate(zip(docs, items, strict=True)):
        of = lambda s: (a := count(d[s : s + len(t)]) & count(t)).total() / (2 * (len(t) - 4) - a.total())  # noqa: B023, E731
        want[i] = max(of(s) for s in range(len(d) - len(t) + 1))
    assert min(want.values()) >= 0.75
    frame = lambda rows, key: spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], f"{key} long, text string")
    got = {x.doc_id: x.similarity for x in decontaminate.contaminated(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert got == pytest.approx(want)


def fitted(cells, shares, order, rounds=1000):
    """Plain raking of {cell: tokens} to shares by margin."""
    w = dict(cells)
    for _ in range(rounds):
        for at, margin in enumerate(order):
            for v, x in shares[margin].items():
                have = sum(y for c, y in w.items() if c[at] == v)
                for c in w:
                    if c[at] == v and have:
                        w[c] *= x / have
    return w


@pytest.mark.parametrize("wanted", [None, {"source": {"s0": 3, "s1": 1, "s2": 1, "s3": 1, "none": 5}, "lang": {"en": 1, None: 1}}])
def test_mixture_meets_all_margins(docs, wanted):
    rows = mixing.mixed(docs, wanted, share=0.5).collect()
    assert len(rows) == len(texts())
    weight = {(r.source, r.lang, r.topic): r.weight for r in rows}
    tokens: Counter = Counter()
    for r in rows:
        tokens[r.source, r.lang, r.topic] += r.tokens
    shares = {}
    for at, m in enumerate(mixing.MARGINS):
        sums: Counter = Counter()
        for c, t in tokens.items():
            sums[c[at]] += t
        given = {k: (wanted or {}).get(m, {}).get(k or None, 0) if m in (wanted or {}) else t**mixing.POWER for k, t in sums.items()}
        shares[m] = {k: x / sum(given.values()) for k, x in given.items()}
        for v, x in shares[m].items():
            assert sum(w for k, w in weight.items() if k[at] == v) == pytest.approx(x, abs=2e-4)
    for c, x in fitted(tokens, shares, mixing.MARGINS).items():
        assert weight[c] == pytest.approx(x, abs=2e-3)
    assert sum(r.p * r.tokens for r in rows) / sum(tokens.values()) == pytest.approx(0.5, abs=0.02)
    assert all(0 <= r.p <= 1 for r in rows)
    # of cells that don't give all, probabilities are in proportion to weights
    ratio = [r.p * tokens[r.source, r.lang, r.topic] / r.weight for r in rows if 0 < r.p < 1]
    assert max(ratio) == pytest.approx(min(ratio))


def test_mixture_refuses_unknown_margins(docs):
    with pytest.raises(ValueError):
        mixing.mixed(docs, {"colour": {}})


def plain_spans(t):
    """The contract's patterns, as they stand."""
    found = []
    find = lambda p: [(m.start(), m.end(), m[0]) for m in re.finditer(p, t)]
    digits = lambda x: re.sub("[^0-9]", "", x)
    found += [(s, e, 0) for s, e, _ in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")]
    found += [(s, e, 1) for s, e, x in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(p) <= 255 for p in x.split("."))]
    luhn = lambda d: sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    found += [(s, e, 2) for s, e, x in find(r"[0-9]([\x20-]?[0-9])+") if 12 <= len(digits(x)) <= 19 and luhn(digits(x))]
    found += [(s, e, 3) for s, e, x in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 9 <= len(digits(x)) <= 15]
    return sorted(found, key=lambda x: (x[0], x[2]))


def test_base_spans_against_the_patterns():
    r = random.Random(7)
    parts = ["192.168.1.1", "@", "host.com", "4111111111111111", "+1 (203) 555-0199", ".", "-", " ", "1", "22", "a", "+", "b@c.de", "999.1.1.1", "(", ")", "4111 1111 1111 1111", "é", "12.5.6.7.8"]
    for _ in range(4000):
        t = "".join(r.choice(parts) for _ in range(r.randint(1, 7)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_words_before():
    assert pii.words_before("Call  me\tNOW 555", 13) == "me now"
    long = "x" * 300
    assert pii.words_before(f"a {long} b 1", len(long) + 5) == pii.words_before(f"zz {long} b 1", len(long) + 6) != pii.words_before(f"a {long}y b 1", len(long) + 6)


def test_ann_recall_and_odd_vectors(spark):
    x = np.random.default_rng(0).normal(size=(400, 16))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [None] * 16, 1), (404, [1.0], 1), (None, [1.0] * 16, 1)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = additive_ann.nearest(v, v.filter("vec_id % 20 = 0")).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 400, 20):
        s = u @ u[q]
        s[q] = -2
        own = [r for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q]
        hits += len({r.vec_id for r in own} & set(np.argsort(-s)[:5].tolist()))
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and all(r.score == pytest.approx(s[r.vec_id]) for r in own)
    assert hits >= 0.9 * 100


def test_ann_is_not_fitted_in_the_driver(spark, monkeypatch):
    x = np.random.default_rng(5).normal(size=(300, 8))
    v = spark.createDataFrame([(i, e) for i, e in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    train, driver = additive_ann.train, os.getpid()
    monkeypatch.setattr(additive_ann, "train", lambda x: train(x) if os.getpid() != driver else pytest.fail("the driver holds the sample"))
    got = {(r.query_id, r["rank"]): r.vec_id for r in additive_ann.nearest(v, v.filter("vec_id % 50 = 0")).collect()}
    s = (u := x / np.linalg.norm(x, axis=1, keepdims=True)) @ u.T - 3 * np.eye(300)
    assert got == {(q, n + 1): int(j) for q in range(0, 300, 50) for n, j in enumerate(np.argsort(-s[q])[:5])}
    assert not additive_ann.nearest(v.filter("vec_id = 50"), v).collect()


def test_ann_is_exact_on_many_rows(spark):
    x = np.random.default_rng(3).normal(size=(20_000, 64))
    x[7000:7300] = x[50]  # copies, more than are reranked
    v = spark.createDataFrame([(i, e) for i, e in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.vec_id for r in additive_ann.nearest(v, v.filter("vec_id % 50 = 0")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for q in range(0, 20_000, 50):
        s = np.round(u @ u[q], 12)
        s[q] = -2
        want |= {(q, n + 1): int(j) for n, j in enumerate(np.argsort(-s, kind="stable")[:5])}
    assert got == want


def test_quality_ranks_held_out(spark):
    r = random.Random(2)
    rows = [(i, " ".join(("WORD!!" if i % 4 == 0 else "word") + str(r.randint(0, 9)) for _ in range(50))) for i in range(300)] + [(300, None), (301, "")]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in quality.rate(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    assert len(got) == 302
    held = [i for i in range(300) if got[i].held_out]
    assert held and min(got[i].score for i in held if i % 4) > max(got[i].score for i in held if i % 4 == 0)


def test_quality_is_not_fitted_in_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ("GOOD one " if i % 3 else "bad! two ") * (i + 1)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    x = quality.features([r.text.encode() for r in docs.orderBy("doc_id").collect()]).astype(np.float32).astype(float)
    u = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    p = [i for i in u if i % 3]
    order = lambda y: y[np.lexsort(y.T[::-1])]
    want = quality.fit(order(x[p]), order(x[u]), len(p) / len(u))
    fit, driver = quality.fit, os.getpid()
    monkeypatch.setattr(quality, "fit", lambda *a: fit(*a) if os.getpid() != driver else pytest.fail("the driver holds the sample"))
    got = quality.train(docs, labels)
    assert {*got} == {*want} and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
    assert quality.train(docs, labels.filter("quality = 0")) is None and quality.train(docs.filter("doc_id < 0"), labels) is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
    assert relative_lz.remove_repeated_words(none).count() == 0
    assert minhash_dedup.near_duplicates(none).count() == 0
    assert karmarkar_karp.shards(none).count() == 0
    assert pii.find_personal(none).count() == 0
    assert mixing.mixed(none).count() == 0
    assert decontaminate.contaminated(none, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert quality.rate(none, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    v = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert additive_ann.nearest(v, v).count() == 0


def test_null_ids_are_kept(spark):
    d = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    assert sorted((r.component_id, r.kept) for r in minhash_dedup.near_duplicates(d).select(F.coalesce("component_id", F.lit(-1)).alias("component_id"), "kept").collect()) == [(-1, False), (-1, False), (-1, True)]
    assert karmarkar_karp.shards(d, 2).count() == 3
