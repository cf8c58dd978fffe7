"""Benchmark passages in documents, by SimHash over item-sized windows; DataFrame and SQL functions only.

Windows of an item's length are fingerprinted, as the items are, that hold one of its shingles where the item
has it, or that start between two such. All others hold no more of the item than the nearest of these: what is
shared in a window lies, moved, also in the window at the least or the greatest offset of what it shares. Fingerprints are cut into one block more than the radius, so that any two within the radius agree
on a block (multi-index hashing); pairs that do are held against the radius, and then against the exact
weighted similarity of their shingles, the sum of lesser counts over the sum of greater ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

RADIUS = 23
SHINGLE = 5
#: Rows of item shingles up to which these are sent to all executors; beyond, they are shuffled.
SENT_ROWS = 200_000


def words(text) -> Column:
    """A-Z as lower case, split at ASCII white space."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def grams(w, size) -> Column:
    """Hashes of the runs of `size` words; none if there are fewer."""
    return F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(size) if isinstance(size, int) else size)))).otherwise(F.array().cast("array<bigint>"))


def shingles(w) -> Column:
    """All 5-word shingles; of fewer words, the whole sequence as one."""
    return F.when(F.size(w) >= SHINGLE, grams(w, SHINGLE)).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))


def fingerprint(w) -> Column:
    """The fingerprint as a long: bit i set if more of the words' hashes have it than not."""
    hashes = F.transform(w, lambda x: F.xxhash64(x))
    more = lambda b: F.aggregate(hashes, F.lit(0), lambda s, h: s + F.getbit(h, b).cast("int") * 2 - 1) > 0
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.when(more(b), F.lit("1")).otherwise(F.lit("0")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda s, x: F.shiftleft(s, 1).bitwiseOR(x.cast("long")))


def similarity(a, b) -> Column:
    """Sum of lesser counts over sum of greater counts of the shingles in two arrays."""
    count = lambda x, h: F.size(F.filter(x, lambda y: y == h))
    lesser = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, h: s + F.least(count(a, h), count(b, h)))
    return lesser / (F.size(a) + F.size(b) - lesser)


def blocks(fp) -> Column:
    """RADIUS + 1 pieces of the fingerprint, each with its number."""
    edges = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return F.array(*[F.lit(i).cast("long") * 64 + F.shiftrightunsigned(F.shiftleft(fp, 64 - edges[i + 1]), 64 - edges[i + 1] + edges[i]) for i in range(RADIUS + 1)])


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, item_id, start, similarity): for each document and item the best window of the item's length, in words, if its weighted similarity is percent or more.

    Null or empty texts and items match nothing. Items of under 5 words match as whole sequences. A document
    shorter than the item is one window. Null doc_ids are kept, and count as one document, as repeated rows do.
    Rows of one item_id are held as items each. Other columns are ignored; empty tables give an empty result.
    """
    item = items.select(F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select("item_id", words("text").alias("w")).filter(F.size("w") > 0)
    item = cut(item.withColumn("item", F.monotonically_increasing_id()).select("item", "item_id", F.size("w").alias("m"), "w", shingles(F.col("w")).alias("s")))
    sizes = sorted(r[0] for r in item.select(F.least("m", F.lit(SHINGLE))).distinct().collect())  # at most 5 numbers
    held = cut(item.select("item", "m", F.posexplode("s").alias("at", "gram")))
    if held.count() <= SENT_ROWS:
        held = F.broadcast(held)
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select("doc_id", words("text").alias("w"))
    found = None
    for size in sizes:
        # What is beside an explosion goes with each of its rows: never the words. Outer, as Spark else asks before
        # whether there is anything to explode, by an expression that takes the words anew for each place.
        rows = text.select("doc_id", F.size("w").alias("n"), grams(F.col("w"), size).alias("g")).select("doc_id", "n", F.posexplode_outer("g").alias("pos", "gram"))
        same = held.filter(F.least("m", F.lit(SHINGLE)) == size) if len(sizes) > 1 else held
        hit = rows.join(same, "gram").select("doc_id", "m", F.greatest(F.least(F.col("pos") - F.col("at"), F.col("n") - F.col("m")), F.lit(0)).alias("start"))
        found = hit if found is None else found.union(hit)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}, start int, similarity double")
    aligned = found.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("m", "start"))).alias("at"))

    def filled(x, i):
        after = F.get("at", i + 1)
        # starts further apart have no window between them that holds shingles aligned to both
        close = (after["m"] == x["m"]) & (after["start"] - x["start"] <= 2 * (x["m"] - SHINGLE))
        last = F.when(close, after["start"] - 1).otherwise(x["start"])
        return F.transform(F.sequence(x["start"], last), lambda s: F.struct(s.alias("start"), x["m"].alias("m")))

    windows = aligned.select("doc_id", F.flatten(F.transform("at", filled)).alias("at"))
    own = text.alias("t").join(windows.alias("x"), F.col("t.doc_id").eqNullSafe(F.col("x.doc_id"))).select("t.doc_id", "w", "at")
    inside = F.filter("at", lambda x: x["start"] < F.size("w"))
    pieces = F.transform(inside, lambda x: F.struct(x["start"].alias("start"), x["m"].alias("m"), F.slice("w", x["start"] + 1, x["m"]).alias("v")))
    each = own.select("doc_id", pieces.alias("x")).select("doc_id", F.explode_outer("x").alias("x")).filter("x.start is not null").select("doc_id", "x.start", "x.m", "x.v")
    window = each.withColumn("fp", fingerprint(F.col("v"))).select("doc_id", "start", "m", "fp", shingles(F.col("v")).alias("sv"))
    marked = item.select("item", "item_id", "m", fingerprint(F.col("w")).alias("ifp"), "s").withColumn("block", F.explode(blocks(F.col("ifp"))))
    near = window.withColumn("block", F.explode(blocks(F.col("fp")))).join(marked, ["m", "block"])
    # a pair meets once for each block that agrees: the first counts
    differ = F.col("fp").bitwiseXOR(F.col("ifp"))
    first = F.array_min(F.filter(F.transform(F.arrays_zip(blocks(F.col("fp")).alias("a"), blocks(F.col("ifp")).alias("b")), lambda z: F.when(z["a"] == z["b"], z["a"])), lambda z: z.isNotNull()))
    pairs = near.filter(F.bit_count(differ) <= RADIUS).filter(F.col("block") == first)
    exact = pairs.withColumn("similarity", similarity(F.col("sv"), F.col("s"))).filter(F.col("similarity") * 100 >= percent)
    best = exact.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("at"))).alias("x"))
    return best.select("doc_id", "item_id", (-F.col("x.at")).cast("int").alias("start"), "x.similarity")


def op7_simhash_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
