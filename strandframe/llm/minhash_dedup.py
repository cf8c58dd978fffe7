"""Near-duplicates by bottom-k sketches from one hash function.

The sketch of a document is the k least hashes of its distinct word shingles. Equal sets are one class from
then on. Inverted lists of the sketch values give the overlaps: similar sets share a number
of their k values that lies at most DEVIATIONS below the mean, but for a chance of about 2e-8, so a class is
listed only under its rarest values, as many as make a pair with that overlap meet. Short documents, which
common lines may fill, have longer sketches, and so hold more of their own. The union sketch's estimate filters, and sets are
compared whole. Lists are not paired out: each class is compared with one class of each of its lists, and takes
one of these as its leader. Two classes of one leader are linked either by what each shares with the leader,
which bounds their intersection, or share something beside it, by which they are listed anew. Classes of
different leaders meet in the lists: each round compares the members with one of them, classes that were linked
become one component, and only pairs of different components remain for the next.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWEST, cut, dealt, many_shingles, partitions, text_column
from .components import components

K, K_SHORT, SHORT = 48, 128, 256
DEVIATIONS = 5.5
ROUNDS = 1
#: Rows that name one class and meet its text in one task, at most.
SPLIT = 256


def overlap(n, k: int, percent: int):
    """The values that a set of n shares, at least, with a similar one in the bottom k of their union."""
    share = percent / 100
    union = F.greatest(F.ceil(n / share), F.lit(k + 1))
    spread = F.sqrt(k * share * (1 - share) * (union - k) / (union - 1))
    return F.greatest(F.least(F.ceil(n * percent / 100), F.floor(k * share - DEVIATIONS * spread)), F.lit(1)).cast("int")


def normal(text: bytes) -> bytes:
    """A-Z as lower case, words joined by one space."""
    return b" ".join(text.lower().split())


def digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def class_key(rep, words):
    """16 hex digits of the least doc_id, as bytes that order as it does, and the words' digest: centres and leaders are early documents."""
    return F.concat(F.unhex(F.lpad(F.hex(rep.bitwiseXOR(F.lit(LOWEST))), 16, "0")), words)


def words_of(key):
    """The digest in a class's key."""
    return F.substring(key, 9, 16)


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc, n, key, sketch): the number of shingles, a 128-bit digest of the words, the K least hashes, of sets of up to SHORT the K_SHORT least."""

    def make(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [normal(x) for x in part.column(1).to_pylist()]
                sets = many_shingles(texts, words)
                yield pa.record_batch([part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([digest(x) for x in texts], pa.binary()), pa.array([x[: K if len(x) > SHORT else K_SHORT] for x in sets], pa.list_(pa.int64()))], names=["doc", "n", "key", "sketch"])

    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc"), text_column(docs).alias("text"))
    return own.mapInArrow(make, "doc long, n long, key binary, sketch array<long>")


def estimate(a, b, k):
    """How many of the union's k least hashes both sketches have."""
    union = F.slice(F.array_sort(F.array_union(a, b)), F.lit(1), k)
    return F.size(F.array_intersect(union, F.array_intersect(a, b)))


def needed(n, percent: int):
    """overlap() by a set's own sketch, or by K where a similar set may have that."""
    return F.when(n <= SHORT * percent // 100, overlap(n, K_SHORT, percent)).otherwise(overlap(n, K, percent))


def listed(classes: DataFrame, percent: int) -> DataFrame:
    """(value, key, n): the inverted lists, without values that only one class has."""
    rows = classes.select("key", "n", F.explode("sketch").alias("value"))
    often = rows.groupBy("value").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    need = needed(F.col("n"), percent)
    own = rows.join(often, "value").groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("values"))
    # the values that no other class has come before all these
    return own.withColumn("most", (F.size("values") - need + 1).cast("int")).filter("most > 0").select("key", "n", F.explode(F.slice("values", F.lit(1), F.col("most"))).alias("v")).select("v.value", "key", "n")


def set_sizes(a: list[bytes], b: list[bytes], words: int) -> tuple[int, int, int]:
    """How many distinct shingles two texts have, and how many both; without hashes, so that unlike shingles are never one."""
    number: dict[bytes, int] = {}
    one = [np.array([number.setdefault(w, len(number)) for w in x], np.int64) for x in (a, b)]
    if min(len(a), len(b)) < words:
        # a text of fewer words is one shingle, and like no shingle of another length
        sizes = [len(np.unique(np.lib.stride_tricks.sliding_window_view(x, min(words, len(x))), axis=0)) for x in one]
        return sizes[0], sizes[1], int(len(a) == len(b) and a == b)
    size = np.array([len(x) for x in one])
    ranks = np.concatenate(one)
    valid = np.ones(len(ranks), bool)
    length = 1
    while length < words:
        # ranks of runs of `length` words become ranks of longer ones; those that leave a text are dropped at the end
        step = min(length, words - length)
        ahead = np.append(ranks[step:], np.zeros(step, np.int64))
        ranks = np.unique(ranks * (ranks.max() + 1) + ahead, return_inverse=True)[1]
        length += step
    ends = np.cumsum(size)
    for e in ends.tolist():
        valid[max(e - words + 1, 0) : e] = False
    own = np.arange(len(ranks)) < ends[0]
    x, y = np.unique(ranks[valid & own]), np.unique(ranks[valid & ~own])
    return len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))


def crowded(rows: DataFrame, name: str) -> DataFrame | None:
    """(name, parts) of the classes that more than SPLIT rows name; None if there are none. rows: a checkpoint."""
    crowds = cut(rows.groupBy(name).agg(F.ceil(F.count(F.lit(1)) / SPLIT).alias("parts")).filter("parts > 1"))
    # one task looks at all parts of so few rows, where isEmpty() alone starts job after job
    return None if crowds.coalesce(1).isEmpty() else crowds


def marked(rows: DataFrame, crowds: DataFrame | None, name: str) -> DataFrame:
    """rows with the parts of the class that column `name` holds, null if it isn't crowded."""
    parts = f"parts_{name}"
    if crowds is None:
        return rows.withColumn(parts, F.lit(None).cast("long"))
    # a cut, so that rows of a crowd are left out of joins by `name` before they are shuffled
    return cut(rows.join(crowds.withColumnRenamed("parts", parts), name, "left"))


def with_text(rows: DataFrame, crowds: DataFrame | None, texts: DataFrame, name: str, z: str) -> DataFrame:
    """marked() rows with the text, as z, of the class that column `name` holds; texts: (key, z), dealt by key.

    The texts stay where they are but for those of `crowds`, which go to each of the class's parts, a copy for about SPLIT rows.
    """
    text = texts.select(F.col("key").alias(name), F.col("z").alias(z))
    if crowds is None:
        return rows.join(text, name)
    parts = F.col(f"parts_{name}")
    few = rows.filter(parts.isNull()).join(text, name)
    copies = text.join(crowds, name).select(name, z, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    many = rows.filter(parts.isNotNull()).withColumn("part", F.pmod(F.xxhash64(*rows.columns), parts)).join(copies, [name, "part"])
    return few.select(*rows.columns, z).union(many.select(*rows.columns, z))


def compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, na, nb, both) of pairs: the sizes of their whole sets and of the intersection, by the words themselves; texts: (key, z)."""
    pairs = cut(pairs)
    many_a, many_b = crowded(pairs, "a"), crowded(pairs, "b")
    pairs = marked(marked(pairs, many_a, "a"), many_b, "b")

    def check(batches):
        un = zstandard.ZstdDecompressor()
        last: tuple = (None, None)
        for batch in batches:
            a, b, za, zb = (batch.column(i).to_pylist() for i in range(4))
            sizes = []
            for i in range(len(a)):
                if last[0] != b[i]:
                    last = (b[i], un.decompress(zb[i]).split())
                sizes.append(set_sizes(un.decompress(za[i]).split(), last[1], words))
            columns = np.array(sizes, np.int64).reshape(-1, 3).T
            yield pa.record_batch([batch.column(0), batch.column(1), *map(pa.array, columns)], names=["a", "b", "na", "nb", "both"])

    with_a = with_text(pairs, many_a, texts, "a", "za")
    both = with_text(with_a, many_b, texts, "b", "zb")
    return both.select("a", "b", "za", "zb").mapInArrow(check, "a binary, b binary, na long, nb long, both long")


def linked(sizes: DataFrame, percent: int) -> DataFrame:
    return sizes.filter((F.col("both") > 0) & (F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent)).select("a", "b")


def leaders(lists: DataFrame, centre: DataFrame) -> DataFrame:
    """(key, n, leader): of the centres of a class's lists, of those it meets a quarter as often as any, that of most list rows."""
    met = cut(lists.join(centre.select("value", F.col("d").alias("leader")), "value").groupBy("key", "n", "leader").agg(F.count(F.lit(1)).alias("times")))
    # both sides of the join come from checkpoints, so that a leader with many rows can be split
    fame = cut(met.groupBy("leader").agg(F.sum("times").alias("fame")))
    own = met.join(fame, "leader").groupBy("key", "n").agg(F.collect_list(F.struct((-F.col("fame")).alias("minus"), "leader", "times")).alias("x"), F.max("times").alias("most"))
    return own.select("key", "n", F.array_min(F.filter("x", lambda y: y["times"] * 4 >= F.col("most")))["leader"].alias("leader"))


def inside(led: DataFrame, percent: int) -> DataFrame:
    """(a, b) of one leader that may be linked by what they share with it alone; led: (key, n, leader, i, component, of).

    i is the intersection with the leader; sets of n and m that are linked share (n + m) * percent / (100 + percent)
    at least, so m <= i * (100 + percent) / percent - n. Classes that hang with the leader already need no pairing.
    """
    most = F.floor(F.col("i") * (100 + percent) / percent) - F.col("n")
    ask = led.filter("component != of").withColumn("from", F.ceil(F.col("n") * percent / 100)).withColumn("to", F.least(F.floor(F.col("n") * 100 / percent), most)).filter("`from` <= to")
    ask = ask.select("leader", F.col("key").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.explode(F.sequence("from", "to")).alias("nb"))
    other = led.select("leader", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), most.alias("room"))
    met = ask.join(other, ["leader", "nb"]).filter((F.col("ca") != F.col("cb")) & (F.col("na") <= F.col("room")))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def outside(led: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """(value, key, n): lists of what classes of one leader share beside it, whole sets, for leaders with classes that do not hang with them."""

    def rest(batches):
        un = zstandard.ZstdDecompressor()
        last: tuple = (None, None)
        for batch in batches:
            leader, zd, zl = (batch.column(i).to_pylist() for i in (2, 4, 5))
            out = []
            for i in range(len(leader)):
                if last[0] != leader[i]:
                    last = (leader[i], many_shingles([un.decompress(zl[i])], words)[0])
                out.append(np.setdiff1d(many_shingles([un.decompress(zd[i])], words)[0], last[1], assume_unique=True))
            yield pa.record_batch([*(batch.column(i) for i in range(4)), pa.array(out, pa.list_(pa.int64()))], names=["key", "n", "leader", "i", "rest"])

    # both sides of the join come from checkpoints, and what counts its rows comes after one, so that a leader with many rows can be split
    open_ = cut(led.filter("component != of").select("leader").distinct())
    rows = cut(led.join(open_, "leader", "left_semi").filter("n > i").select("key", "n", "leader", "i"))
    crowds = crowded(rows, "leader")
    rows = marked(rows, crowds, "leader")
    rows = with_text(rows.join(texts.select("key", F.col("z").alias("zd")), "key"), crowds, texts, "leader", "zl")
    made = rows.select("key", "n", "leader", "i", "zd", "zl").mapInArrow(rest, "key binary, n long, leader binary, i long, rest array<long>")
    each = cut(made.select("key", "n", "i", F.explode("rest").alias("u"), "leader").select("key", "n", "i", F.xxhash64("leader", "u").alias("value")))
    often = each.groupBy("value").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    own = each.join(often, "value").groupBy("key", "n", "i").agg(F.array_sort(F.collect_list(F.struct("often", "value"))).alias("values"))
    need = F.greatest(F.ceil(F.col("n") * percent / 100) - F.col("i"), F.lit(1))
    most = (F.size("values") - need + 1).cast("int")
    return own.withColumn("most", most).filter("most > 0").select("key", "n", F.explode(F.slice("values", F.lit(1), F.col("most"))).alias("v")).select("v.value", "key", "n")


def near_duplicates(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each document.

    Two documents are linked when 100 * intersection >= percent * union of their sets of shingles of `words`
    words, A-Z as lower case; with fewer words, the whole sequence is the one shingle. component_id: the least
    doc_id reachable by links. Null or empty texts have no set and link with nothing. Null doc_id: less than
    any other, and null in the result; it doesn't hold rows together. Repeated rows give a row each; rows of one
    other doc_id with different texts hold their components together. Links are confirmed on the words of whole
    texts, however long. Other columns are ignored; an empty table gives an empty result.
    """
    made = cut(sketches(docs, words))
    filled = made.filter("n > 0")
    # a class is a sequence of words: its key, sketch and text are those of no other
    classes = cut(filled.groupBy("key").agg(F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).withColumn("key", class_key(F.col("rep"), F.col("key"))))
    lists = dealt(listed(classes, percent), "value")
    several = lists.groupBy("value").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("value")
    active = lists.join(several, "value").select("key").distinct()

    def squeeze(batches):
        c = zstandard.ZstdCompressor(3)
        for b in batches:
            texts = [normal(x) for x in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array([digest(x) for x in texts], pa.binary()), pa.array([c.compress(x) for x in texts], pa.binary())], names=["key", "z"])

    small = docs.select(text_column(docs).alias("text")).mapInArrow(squeeze, "key binary, z binary")
    wanted = active.select(words_of("key").alias("same"), "key")
    texts = dealt(small.withColumnRenamed("key", "same").join(wanted, "same").dropDuplicates(["key"]).select("key", "z"), "key")
    shape = classes.select("key", "n", "sketch")

    def alike(sa: str, sb: str, na: str, nb: str):
        k = F.when(F.greatest(na, nb) > SHORT, K).otherwise(K_SHORT)
        return estimate(F.col(sa), F.col(sb), k) >= F.least(needed(F.col(na), percent), needed(F.col(nb), percent))

    def likely(pairs: DataFrame) -> DataFrame:
        """Of distinct (a, b), a < b, those that the estimate allows."""
        with_a = pairs.join(shape.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
        both = with_a.join(shape.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
        return both.filter(alike("sa", "sb", "na", "nb")).select("a", "b")

    def verified(pairs: DataFrame) -> DataFrame:
        return linked(compared(likely(pairs), texts, words), percent)

    def close(x: str, y: str):
        return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)

    def ordered(x: str, y: str):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    def labelled(rows: DataFrame, links: list[DataFrame]) -> DataFrame:
        """rows with the component of their key."""
        return rows.join(components(reduce(DataFrame.union, links)).withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))

    # each class with the least of each of its lists, and with its leader whatever the estimate
    centre = cut(lists.groupBy("value").agg(F.min(F.struct("key", "n")).alias("x"), F.count(F.lit(1)).alias("m")).filter("m > 1").select("value", F.col("x.key").alias("d"), F.col("x.n").alias("m")))
    lead = cut(leaders(lists, centre))
    first = lists.join(centre, "value").filter((F.col("key") != F.col("d")) & close("n", "m")).select(*ordered("key", "d")).distinct()
    follow = lead.filter("key != leader").select(*ordered("key", "leader"))
    sizes = cut(compared(likely(first).union(follow).distinct(), texts, words))
    # a checkpoint for each step that finds links; none is written again with the next
    links = [cut(linked(sizes, percent))]
    shared = lead.select("key", "n", "leader", *ordered("key", "leader")).join(sizes.select("a", "b", "both"), ["a", "b"], "left")
    led = labelled(shared.select("key", "n", "leader", F.coalesce("both", "n").alias("i")), links)
    led = cut(led.join(led.filter("key = leader").select("leader", F.col("component").alias("own")), "leader", "left").withColumn("of", F.coalesce("own", "leader")).drop("own"))
    # those of one leader: by what they share with it, by lists of what they share beside it; of several: by the lists
    links.append(cut(verified(inside(led, percent))))
    beside = outside(led, texts, percent, words).select("value", "key", "n", F.col("key").alias("side"))
    across = lists.join(lead.select("key", "leader"), "key").select("value", "key", "n", F.col("leader").alias("side"))
    lists = cut(across.union(beside))
    for nth in range(ROUNDS + 1):
        state = labelled(lists, links)
        # value lists that still hold several components and sides, and how many pairs of these they have
        square = lambda c: F.sum(F.col(c) * F.col(c))
        both = state.groupBy("value", "component", "side").agg(F.count(F.lit(1)).alias("c"))
        by_side = both.groupBy("value", "side").agg(F.sum("c").alias("c")).groupBy("value").agg(square("c").alias("sides"), F.count(F.lit(1)).alias("n_sides"))
        by_part = both.groupBy("value", "component").agg(F.sum("c").alias("c"), square("c").alias("both")).groupBy("value").agg(F.sum("c").alias("m"), square("c").alias("parts"), F.sum("both").alias("both"), F.count(F.lit(1)).alias("n_parts"))
        several = by_part.filter("n_parts > 1").join(by_side.filter("n_sides > 1"), "value").withColumn("pairs", (F.col("m") * F.col("m") - F.col("parts") - F.col("sides") + F.col("both")) / 2).filter("pairs > 0")
        open_ = cut(state.join(several.select("value", "m", "pairs"), "value"))
        left = open_.agg(F.coalesce(F.sum(F.col("pairs") / F.col("m")), F.lit(0.0)).alias("pairs"), F.count(F.lit(1)).alias("rows")).first()
        if not left["rows"]:
            break
        last = nth == ROUNDS or left["pairs"] <= 2 * left["rows"]
        if last:
            # each pair once, in the first list that both are in, and only if the estimate allows it
            held = open_.groupBy("key", "side").agg(F.collect_list("value").alias("values"))
            open_ = open_.join(held, ["key", "side"]).join(shape.select("key", "sketch"), "key")
        more = ["values", "sketch"] if last else []
        names = {"key": "d", "n": "nd", "component": "o", "side": "p", "values": "values_d", "sketch": "sketch_d"}
        other = open_.select("value", *(F.col(c).alias(names[c]) for c in ["key", "n", "component", "side", *more]))
        if not last:
            other = other.groupBy("value").agg(F.min(F.struct(F.xxhash64("o", F.lit(nth)), "d", "nd", "o", "p")).alias("x")).select("value", "x.d", "x.nd", "x.o", "x.p")
        met = open_.join(other, "value").filter((F.col("component") != F.col("o")) & (F.col("side") != F.col("p")) & close("n", "nd"))
        if last:
            met = met.filter((F.col("key") < F.col("d")) & (F.array_min(F.array_intersect("values", "values_d")) == F.col("value")) & alike("sketch", "sketch_d", "n", "nd"))
            links.append(cut(linked(compared(met.select(*ordered("key", "d")).distinct(), texts, words), percent)))
            break
        links.append(cut(verified(met.select(*ordered("key", "d")).distinct())))
        lists = open_.select("value", "key", "n", "side")
    # rows of one doc_id with different texts hold their classes together
    mixed = filled.filter(F.col("doc") != LOWEST).groupBy("doc").agg(F.min("key").alias("a"), F.max("key").alias("z")).filter("a != z").select("doc", "a")
    twice = filled.select("doc", F.col("key").alias("b")).join(mixed, "doc").filter("a != b").select("a", "b").distinct()
    for side in ("a", "b"):
        twice = twice.join(classes.select(words_of("key").alias(side), F.col("key").alias("own")), side).drop(side).withColumnRenamed("own", side)
    edges = reduce(DataFrame.union, [*links, cut(twice.select("a", "b"))])
    of = classes.select("key", "rep")
    if not edges.coalesce(partitions(docs.sparkSession)).isEmpty():
        held = of.join(components(edges).withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
        held = cut(held)
        least = cut(held.groupBy("component").agg(F.min("rep").alias("rep")))
        of = cut(held.select("key", "component").join(least, "component").select("key", "rep"))
    out = made.select("doc", "n", "key").join(of.select(words_of("key").alias("key"), "rep"), "key", "left").select("doc", "n", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc")).alias("component"))
    null = lambda c: F.when(F.col(c) != LOWEST, F.col(c))
    return out.select(null("doc").alias("doc_id"), F.col("n").alias("n_shingles"), null("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"))


def op8_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
