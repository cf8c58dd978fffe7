"""Personal data by patterns, and by bootstrapped contextual extraction.

Base matches are the seeds. The words before a seed are a lexical pattern; identifier-like words that follow
a pattern are its instances. Spark scores the graph of patterns and instances in rounds: a pattern is worth
the share of its occurrences whose instance is trusted, an instance what its patterns make likely. Patterns
that end above the threshold mark what follows them as personal data.
"""

from __future__ import annotations

import hashlib
import re
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWEST, cut

#: Fixed values of the contract.
KINDS = ["email", "ip", "card", "phone"]
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++){3,}+")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What may be an identifier: a word with a digit or an at sign, and after it words of digits and their punctuation.
LIKE = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*(?:\x20[().+-]*[0-9][().0-9-]*(?![^\x20\x09-\x0D.,;:!?)\]}\"']))*")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROUNDS, LEAST_SCORE, LEAST_SEEDS = 3, 0.6, 3.0


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, leftmost, in one pass however long a word is."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by start, then kind; code points, end exclusive."""
    out: list[tuple[int, int, int]] = []
    out += [(a, b, 0) for a, b in emails(text)]
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isascii() and c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), 3))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
    for m in DOTTED.finditer(text):
        parts = list(DIGITS.finditer(text, m.start(), m.end()))
        for i in range(0, len(parts) - 3, 4):
            if all(len(x := p[0].lstrip("0")) <= 3 and int(x or 0) <= 255 for p in parts[i : i + 4]):
                out.append((parts[i].start(), parts[i + 3].end(), 1))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def words_before(text: str, at: int, n: int = 2) -> str:
    """The n words before a place, in lower case; a digest of them if they are long."""
    size = 64
    while True:
        begin = max(0, at - size)
        found = WORD.findall(text, begin, at)
        if begin == 0 or len(found) > n:
            break
        size *= 4
    out = " ".join(found[-n:]).lower()
    return out if len(out) <= 64 else hashlib.blake2b(out.encode("utf-8", "replace"), digest_size=16).hexdigest()


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, str, str | None]]:
    """(start, end, pattern, instance, kind of the seed or null) of base spans and of what is like an identifier outside them; a pattern is the two words before."""
    out = []
    at = 0
    found = [(s, e, KINDS[k]) for s, e, k in base]
    for m in LIKE.finditer(text):
        while at < len(base) and base[at][1] <= m.start():
            at += 1
        near = list(takewhile(lambda x: x[0] < m.end(), (base[j] for j in range(at, len(base)))))  # noqa: B023
        free = lambda s, e: not any(x < e and s < y for x, y, _ in near)  # noqa: B023, E731
        # where several words run into a base span, those outside it count one by one
        for s, e in [m.span()] if free(*m.span()) else [w.span() for w in WORD.finditer(text, *m.span()) if free(*w.span())]:
            while e > s and text[e - 1] in ".,;:!?)]}\"'":
                e -= 1
            if e > s:
                found.append((s, e, None))
    for s, e, kind in found:
        value = text[s:e]
        out.append((s, e, words_before(text, s), hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=8).hexdigest(), kind))
    return out


ROW = "doc long, row long, base array<struct<start: int, end: int, kind: int>>, cands array<struct<start: int, end: int, pattern: string, instance: string, kind: string>>"


def scan(docs: DataFrame) -> DataFrame:
    """Base spans and candidates of each document, with a number for the row."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())])), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.string())]))]

    def find(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                base = [base_spans(t) for t in part.column(2).to_pylist()]
                cands = [candidates(t, x) for t, x in zip(part.column(2).to_pylist(), base, strict=True)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array([[dict(zip(("start", "end", "kind"), x, strict=True)) for x in y] for y in base], kinds[2]), pa.array([[dict(zip(("start", "end", "pattern", "instance", "kind"), x, strict=True)) for x in y] for y in cands], kinds[3])], names=["doc", "row", "base", "cands"])

    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return own.mapInArrow(find, ROW)


def scored(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, score, seeds) from edges (pattern, instance, kind, c)."""
    edges = cut(edges)
    known = edges.filter("kind is not null").groupBy("pattern", "kind").agg(F.sum("c").alias("w"))
    kind = known.groupBy("pattern").agg(F.max(F.struct("w", "kind")).alias("x")).select("pattern", F.col("x.kind").alias("of"))
    # both sides of the joins come from checkpoints, so that a common pattern or instance can be split
    worth = cut(edges.groupBy("instance").agg(F.max(F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0)).alias("trust")))
    patterns = None
    for _ in range(rounds):
        patterns = cut(edges.join(worth, "instance").groupBy("pattern").agg((F.sum(F.col("c") * F.col("trust")) / F.sum("c")).alias("score"), F.sum(F.col("c") * F.col("trust")).alias("seeds")))
        doubt = F.exp(F.sum(F.log1p(-F.least(F.col("score") * F.col("seeds") / (F.col("seeds") + 2), F.lit(0.999)))))
        worth = cut(edges.join(patterns, "pattern").groupBy("instance").agg(F.when(F.max("kind").isNotNull(), 1.0).otherwise(1 - doubt).alias("trust")))
    return patterns.join(kind, "pattern").select("pattern", F.col("of").alias("kind"), "score", "seeds")


def find_personal(docs: DataFrame, rounds: int = ROUNDS, least: float = LEAST_SCORE, seeds: float = LEAST_SEEDS) -> DataFrame:
    """(doc_id, base, found) for each document; base and found: arrays of (start, end, kind name), found only by context.

    Whole texts are read, however long. Null text: empty. Null doc_id stays null. Repeated rows give rows each.
    Base spans that start together come in the order of KINDS. Other columns are ignored, whatever their names; an
    empty table gives an empty result.
    """
    rows = cut(scan(docs))
    occurrences = rows.select("row", F.explode("cands").alias("x")).select("row", "x.*")
    edges = occurrences.groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).cast("double").alias("c"))
    good = cut(scored(edges, rounds).filter((F.col("score") >= least) & (F.col("seeds") >= seeds)).select("pattern", F.col("kind").alias("of")))
    more = occurrences.filter("kind is null").join(good, "pattern").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", F.col("of").alias("kind")))).alias("found"))
    name = F.array(*[F.lit(k) for k in KINDS])
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.element_at(name, x["kind"] + 1).alias("kind")))
    empty = F.array().cast("array<struct<start: int, end: int, kind: string>>")
    return rows.join(more, "row", "left").select(F.when(F.col("doc") != LOWEST, F.col("doc")).alias("doc_id"), base.alias("base"), F.coalesce("found", empty).alias("found"))


def op6_bootstrapped_pii(spark, sf_dir: str) -> DataFrame:
    out = find_personal(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    write = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    rank = lambda x: F.array_position(F.array(*[F.lit(k) for k in KINDS]), x["kind"])
    keyed = F.array_sort(F.transform(F.concat("base", "found"), lambda x: F.struct(x["start"].alias("start"), rank(x).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return out.select("doc_id", *[count(k) for k in KINDS], F.sha2(write(F.col("base")), 256).alias("base_sha256"), write(keyed).alias("spans"))
