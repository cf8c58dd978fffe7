"""Mixing sources to target weights by iterative proportional fitting; DataFrame and SQL functions only.

Tokens are summed to cells of source, language and topic. The cells' weights are raked to each margin's targets in
turn until every margin is within a tolerance of its targets; documents are then kept with their cell's probability,
by a hash of doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .decontaminate import words

MARGINS = ("source", "lang", "topic")
SHARE, POWER = 0.7, 0.75
#: Raking goes on until no margin's share is further from its target, a few rounds between two looks, up to a bound
#: that targets without a common solution reach.
TOLERANCE, ROUNDS_A_LOOK, MOST_LOOKS = 1e-4, 4, 25
#: Targets that contradict each other are known by a distance that a look leaves nearly as it was.
STALLED = 0.99
#: Cells up to which raking takes place in one partition; beyond, each margin is a shuffle.
ONE_PARTITION = 50_000
#: Cells up to which their probabilities are sent to all executors; beyond, documents are shuffled.
SENT_ROWS = 100_000


def topic(text) -> Column:
    """A topic by the whole text's form, where documents have none."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.contains(t, F.lit(" | ")), "listing").when(F.contains(t, F.lit("@")), "contact").when(F.length(t) < 1000, "note").when(F.length(t) < 4000, "article").otherwise("long")


def cells(docs: DataFrame) -> DataFrame:
    """docs with their cell and tokens (words; 1 at least)."""
    own = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), topic(F.col("text")).alias("topic"), F.greatest(F.size(words(F.coalesce(F.col("text").cast("string"), F.lit("")))), F.lit(1)).cast("long").alias("tokens"))
    return own


def targets(base: DataFrame, margin: str, given: dict | None = None, power: float = POWER) -> DataFrame:
    """(margin, share): the given weights, to a sum of 1 over the values that there are, or else tempered token shares, so that large values give way to small ones."""
    sums = base.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t"))
    if given is None:
        weight = sums.select(margin, F.pow("t", F.lit(power)).alias("x"))
    else:
        pairs = [x for k, v in given.items() for x in (F.lit("" if k is None else str(k)), F.lit(float(v)))]
        weight = sums.select(margin, F.coalesce(F.element_at(F.create_map(*pairs), F.col(margin)) if pairs else F.lit(None).cast("double"), F.lit(0.0)).alias("x"))
    whole = weight.agg(F.sum("x").alias("z"))
    return weight.join(F.broadcast(whole)).select(margin, F.when(F.col("z") > 0, F.col("x") / F.col("z")).otherwise(0.0).alias("share"))  # one row


def furthest(now: DataFrame, wanted: dict[str, DataFrame]) -> float:
    """The largest distance of a margin's share from its target."""
    each = [now.groupBy(margin).agg(F.abs(F.sum("w") - F.max(f"{margin}_share")).alias("d")).select("d") for margin in wanted]
    out = each[0]
    for more in each[1:]:
        out = out.union(more)
    return out.agg(F.coalesce(F.max("d"), F.lit(0.0))).first()[0]


def raked(base: DataFrame, wanted: dict[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """base (cells with tokens) and w: the cell's share of the mixture. wanted: by margin, (value, share); a value without a share gets none."""
    now = base.withColumn("w", F.col("tokens").cast("double"))
    for margin, share in wanted.items():
        now = now.join(share.withColumnRenamed("share", f"{margin}_share"), margin, "left").fillna(0.0, [f"{margin}_share"])
    now = cut(now)
    small = now.count() <= ONE_PARTITION
    before = float("inf")
    for _ in range(MOST_LOOKS):
        if small:
            now = now.coalesce(1)
        for _ in range(ROUNDS_A_LOOK):
            for margin in wanted:
                have = F.sum("w").over(Window.partitionBy(margin))  # over cells, whose number doesn't grow with the documents
                now = now.withColumn("w", F.when(have > 0, F.col("w") * F.col(f"{margin}_share") / have).otherwise(F.lit(0.0)))
        now = cut(now)
        far = furthest(now, wanted)
        if far <= tolerance or far > STALLED * before:
            break
        before = far
    return now.select(*base.columns, "w")


def probabilities(mixture: DataFrame, share: float = SHARE) -> DataFrame:
    """Adds p: each cell's probability, so that `share` of all tokens is expected in proportion to w; cells that would need more than all of theirs give all, and the rest is raised until none is above that."""
    now = mixture.withColumn("p", F.lit(0.0))
    full = -1
    while True:
        left = now.agg(F.coalesce(F.sum(F.when(F.col("p") >= 1, F.col("tokens"))), F.lit(0)).alias("full"), F.coalesce(F.sum(F.when(F.col("p") < 1, F.col("w"))), F.lit(0.0)).alias("open"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("all")).first()
        if left["full"] == full:
            return now
        # cells that give all only become more, so this ends
        full = left["full"]
        scale = max(0.0, share * left["all"] - full) / left["open"] if left["open"] > 0 else 0.0
        now = cut(now.withColumn("p", F.when(F.col("p") >= 1, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.lit(scale) * F.col("w") / F.col("tokens")))))


def mixed(docs: DataFrame, wanted: dict[str, dict] | None = None, share: float = SHARE, power: float = POWER, tolerance: float = TOLERANCE, seed: int = 7) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, weight, p, selected) for each document.

    wanted: target weights by margin and value, such as {"lang": {"en": 3, "de": 1}}; values that no document has are
    left out and the rest brought to a sum of 1, values of documents that are not named get none. Margins not named
    have the tempered token shares as targets. Where targets contradict each other, the last margin raked holds.
    Null source or language: a value of its own, empty (None in wanted). Null or empty text: one token. Texts are
    counted whole, however long. Null doc_id: drawn once, for all such rows, as repeated ids are. Other columns are
    ignored, whatever their names; an empty table gives an empty result.
    """
    if unknown := set(wanted or {}) - set(MARGINS):
        raise ValueError(f"no such margin: {', '.join(sorted(unknown))}")
    own = cells(docs)
    base = cut(own.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")))
    shares = {m: cut(targets(base, m, (wanted or {}).get(m), power)) for m in MARGINS}
    p = probabilities(raked(base, shares, tolerance), share).withColumnRenamed("tokens", "cell_tokens")
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    if base.count() <= SENT_ROWS:
        p = F.broadcast(p)
    return own.join(p, list(MARGINS)).select("doc_id", *MARGINS, "tokens", F.col("w").alias("weight"), "p", (drawn < F.col("p")).alias("selected"))


def op10_ipf_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
