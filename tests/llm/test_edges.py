"""Odd tables: few rows, repeated ids, words made to collide, long texts, and order of equal starts."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from strandframe.llm import components, minhash_dedup, pii, relative_lz, repeats, suffix_dedup

from .test_operators import brute

SCHEMA = "doc_id long, text string"
A = "the quick brown fox jumps over the lazy dog while seven grey cats sleep under an old oak tree near the river bank"
B = "one day a farmer went to sell two fat cows in town and came home late with a bag of magic beans for his wife"


def long_text(seed: int, size: int) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(5000)]
    out = []
    while size > 0:
        out.append(r.choice(words))
        size -= len(out[-1]) + 1
    return " ".join(out)


def shared_long(spark):
    one = long_text(1, 1_300_000)
    return [(1, one), (2, long_text(2, 150_000) + one[250_000:600_000] + long_text(3, 50_000)), (3, "x" * 300_000), (4, one[100:])]


SMALL = [[(1, "short")], [(1, None), (2, None)], [(1, A), (2, B)], [(1, A * 3), (2, B * 3)], [(5, A * 2), (3, A * 2), (4, "")]]


@pytest.mark.parametrize("rows", SMALL)
def test_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(docs).collect()}
    want = brute(sorted(rows), lambda t: (t or "").encode(), 50, False)
    assert got == {i: (n, gone, bytes(kept)) for i, (n, gone, kept) in want.items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept.split()) for r in relative_lz.remove_repeated_words(docs).collect()}
    assert got == brute(sorted(rows), lambda t: (t or "").encode().split(), 20, True)


def test_long_texts(spark):
    rows = shared_long(spark)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, hashlib.sha256(r.kept).digest()) for r in suffix_dedup.remove_repeated_bytes(docs).collect()}
    assert got == {i: (n, gone, hashlib.sha256(bytes(kept)).digest()) for i, (n, gone, kept) in brute(rows, lambda t: t.encode(), 50, False).items()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept.split()) for r in relative_lz.remove_repeated_words(docs).collect()}
    assert got == brute(rows, lambda t: t.encode().split(), 20, True)


def test_words_of_equal_byte_sums_differ(spark):
    one, two = "a" * 64 + "b" * 128 + "a" * 64, "b" * 64 + "a" * 128 + "b" * 64
    same = " ".join(f"w{i}" for i in range(19))
    rows = spark.createDataFrame([(1, f"{same} {one}"), (2, f"{same} {two}"), (3, one), (4, two)], SCHEMA)
    assert [r.n_removed for r in relative_lz.remove_repeated_words(rows).collect()] == [0, 0, 0, 0]
    assert all(r.kept for r in minhash_dedup.near_duplicates(rows.filter("doc_id > 2")).collect())


def test_factors_and_crossing_windows(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(words[:60])), (1, " ".join(words[40:100]))]
    # copies whose sources change in the middle of windows, and near misses of 19 words
    for i in range(2, 30):
        parts = [words[a : a + r.choice([15, 19, 20, 21, 35])] for a in (r.randrange(80) for _ in range(4))]
        rows.append((i, " ".join(itertools.chain(*parts))))
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept.split()) for x in relative_lz.remove_repeated_words(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows, lambda t: t.encode().split(), 20, True)


def permuted(rows):
    return [rows, rows[::-1]]


def test_one_id_with_several_texts(spark):
    near = " ".join([*B.split()[:-1], "husband"])
    for rows in permuted([(1, A), (1, B), (2, near)]):
        got = {(r.doc_id, r.component_id) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == {(1, 1), (2, 1)}
    c = " ".join(reversed(A.split()))
    for rows in permuted([(1, A), (2, B), (3, c), (9, A), (9, B), (9, c)])[:1]:
        got = {(r.doc_id, r.component_id) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == {(1, 1), (2, 1), (3, 1), (9, 1)}


def test_null_ids_hold_nothing_together(spark):
    rows = [(None, A), (None, B), (4, A), (5, " ".join(reversed(B.split())))]
    got = [(r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted([(None, None, True), (None, None, True), (4, None, False), (5, 5, True)], key=str)


@pytest.mark.parametrize("a, b", [("a b", "a b c d e f"), ("a b", "a b"), ("a b c d e a b c d e a", "b c d e a b"), ("a " * 30, "a " * 9), ("a b c d e f g", "b c d e f g h")])
def test_set_sizes(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split())]
    assert minhash_dedup.set_sizes(a.encode().split(), b.encode().split(), 5) == (len(sets[0]), len(sets[1]), len(sets[0] & sets[1]))


def test_base_spans_of_one_start():
    assert [pii.KINDS[k] for _, _, k in pii.base_spans("192.168.1.1@host.com")] == ["email", "ip"]
    assert [pii.KINDS[k] for _, _, k in pii.base_spans("4111111111111111@b.co")] == ["email", "card"]
    assert [pii.KINDS[k] for _, _, k in pii.base_spans("+4111111111111 1")][:1] == ["phone"]


@pytest.mark.parametrize("length", [4, 7, 8, 9, 50])
def test_refined_classes(length):
    r = np.random.default_rng(2)
    data = np.concatenate([r.integers(0, 3, 700), np.tile(r.integers(0, 3, 60), 5), np.zeros(200, int)]).astype(np.uint8)
    at = r.permutation(len(data) - length + 1)[:600]
    got = repeats.refined(data, at, length)
    text = data.tobytes()
    want = [text[i : i + length] for i in at]
    assert len(set(got.tolist())) == len(set(want)) == len(set(zip(got.tolist(), want, strict=True)))


@pytest.mark.parametrize("hot, piece", [(0, 200), (3, 1 << 18), (4096, 64)])
def test_frequent_lines_are_dealt_window_by_window(spark, monkeypatch, hot, piece):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SLICE", piece)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 3000)
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randint(2, 7)))
    line = "all rights reserved, see the file named license"
    rows = [(i, " ".join([*(word() for _ in range(r.randint(0, 15))), line, *(word() for _ in range(r.randint(0, 15)))] * r.randint(1, 2))) for i in range(80)]
    got = {x.doc_id: (x.n_bytes, x.n_removed, list(x.kept)) for x in suffix_dedup.remove_repeated_bytes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows, lambda t: t.encode(), 50, False)


def test_crowded_classes_are_split(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "SPLIT", 2)
    line = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(line[: 60 - i % 12] + [f"own{i}x{j}" for j in range(i * 7 % 13 * 4)])) for i in range(40)]
    rows += [(100 + i, " ".join(line[:30] + [f"two{j}" for j in range(40 + i)])) for i in range(12)]
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    label = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (len(sets[i]), label[i]) for i in sets}
    assert len(set(label.values())) > 4


def test_components_at_once_and_in_rounds(spark):
    r = random.Random(8)
    path = [(b"%04d" % i, b"%04d" % (i + 1)) for i in range(300)]
    pairs = [*path, *[(b"x%03d" % r.randrange(400), b"x%03d" % r.randrange(400)) for _ in range(250)], (b"z", b"z")]
    r.shuffle(pairs)
    label: dict = {x: x for p in pairs for x in p}
    while any(label[a] != label[b] for a, b in pairs):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    edges = spark.createDataFrame(pairs, "a binary, b binary").repartition(40).checkpoint()
    for few in (len(pairs), 0):
        assert {bytes(x.node): bytes(x.component) for x in components.components(edges, few).collect()} == label
    numbers = spark.createDataFrame([(-3, 2), (2, 2**40), (7, 7)], "a long, b long")
    assert sorted(tuple(x) for x in components.components(numbers).collect()) == [(-3, -3), (2, -3), (7, 7), (2**40, -3)]
    assert not components.components(numbers.filter("a > 9")).collect()


def test_few_edges_take_few_tasks(spark):
    """Each task takes driver memory and disk for its record: a few edges are not dealt over all partitions round by round."""
    edges = spark.range(0, 2000, 1, 40).selectExpr("id as a", "id div 10 as b").checkpoint()
    context = spark.sparkContext
    context.setJobGroup("few edges", "")
    try:
        assert components.components(edges).filter("component = 0").count() == 2000
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("few edges") for s in tracker.getJobInfo(j).stageIds}
        assert sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s))) <= 20
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
