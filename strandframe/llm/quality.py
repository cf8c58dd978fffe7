"""Quality by positive-unlabelled learning.

Trusted positives and unlabelled web text, with an estimated share of positives in the latter, give an
unbiased risk; its negative part is kept from falling below zero, which is what overfitting would do. The
score is the classifier's probability. Features are counts over the whole text, of kinds of bytes and words and
of hashed words and pairs of words; nothing else is an input.

The unlabelled text is that of labelled documents, good and bad, whose labels the risk doesn't see: of these the
share of positives is known, and so a bounded sample of labelled rows is all that is fitted on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ODD, cut, mix, slabs, text_column, word_bounds, word_hashes

SAMPLE = 20_000
#: Classes of bytes, by their characters.
SETS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "!", "%", "#", "$", "&", "*", "|", ".", ",", "@", "-", "/:", "<>{}[]()=;", "\n", " ", "\"'", "?"]
CLASS = np.full(256, len(SETS) + 1, np.int64)
CLASS[128:] = len(SETS)
for _i, _s in enumerate(SETS):
    CLASS[[ord(c) for c in _s]] = _i
N_CLASSES = len(SETS) + 2
#: Buckets of hashed words, and of hashed pairs of neighbours.
N_WORDS, N_PAIRS = 64, 64
N_SHAPE = 2 * N_CLASSES + 9
N_FEATURES = N_SHAPE + N_WORDS + N_PAIRS
#: How far hashed features count against the others: many and noisy, they'd fit small samples by chance.
HASHED_WEIGHT = 0.1


def features(texts: list[bytes]) -> np.ndarray:
    """A row for each text."""
    out = [np.zeros((0, N_FEATURES))]
    for _, held in slabs(texts):
        data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
        sizes = np.array([len(x) + 1 for x in held])
        doc = np.repeat(np.arange(len(held)), sizes)
        counts = np.bincount(doc * N_CLASSES + CLASS[data], minlength=len(held) * N_CLASSES).reshape(-1, N_CLASSES).astype(float)
        counts[:, SETS.index("\n")] -= 1
        n = np.maximum(sizes - 1, 1)[:, None]
        starts, ends = word_bounds(data)
        words = word_hashes(data, starts, ends)
        of = doc[starts]
        n_words = np.bincount(of, minlength=len(held)).astype(float)
        w = np.maximum(n_words, 1)
        same = np.zeros(len(words))
        same[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
        order = np.lexsort((words, of))
        new = np.ones(len(words), bool)
        new[1:] = (words[order][1:] != words[order][:-1]) | (of[order][1:] != of[order][:-1])
        kinds = np.bincount(of[order][new], minlength=len(held))
        last = CLASS[data[ends - 1]] if len(ends) else np.zeros(0, np.int64)
        odd_end = np.isin(last, [3, 4, 5, 6, 7, 8, 9])
        upper = CLASS[data[starts]] == 0 if len(starts) else np.zeros(0, bool)
        up_end = np.zeros(len(words), bool)
        if len(words):
            up_end = upper & (CLASS[data[np.minimum(starts + 1, ends - 1)]] == 0) & (ends - starts > 1)
        per = lambda x: np.bincount(of, weights=x.astype(float), minlength=len(held)) / w
        more = np.stack([np.log1p(n_words), np.log1p(n[:, 0]), per(same), kinds / w, kinds / np.sqrt(w), per(odd_end), per(upper), per(up_end), (counts[:, 17] + 1) / w], 1)
        pairs = mix(words[:-1] * ODD[1] + words[1:] * ODD[2]) if len(words) else words
        inside = of[1:] == of[:-1]
        hashed = lambda x, doc, k: np.bincount(doc * k + (x % np.uint64(k)).astype(np.int64), minlength=len(held) * k).reshape(-1, k) / np.sqrt(w)[:, None]
        out.append(np.concatenate([counts / n, np.log1p(counts), more, hashed(words, of, N_WORDS), hashed(pairs[inside], of[1:][inside], N_PAIRS)], 1))
    return np.concatenate(out)


def shaped(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """What the classifier sees: features to one scale, the squares of those that aren't hashed, and a constant."""
    z = np.clip((x - mean) / sd, -6, 6)
    own = z[:, :N_SHAPE]
    return np.concatenate([own, own * own / 6, z[:, N_SHAPE:] * HASHED_WEIGHT, np.ones((len(z), 1))], 1)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-4) -> dict:
    """Weights that minimise the non-negative risk with the logistic loss."""
    mean, sd = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = shaped(positive, mean, sd), shaped(unlabelled, mean, sd)
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        fp, fu = 1 / (1 + np.exp(-np.clip(p @ w, -30, 30))), 1 / (1 + np.exp(-np.clip(u @ w, -30, 30)))
        negative = -np.log1p(-np.minimum(fu, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(fp, 1 - 1e-12)).mean()
        # as products, which need no copy of the sample
        plus = -prior * ((1 - fp) @ p) / len(p)
        minus = fu @ u / len(u) - prior * (fp @ p) / len(p)
        # where the negative risk is under zero, only it is raised again
        g = plus + minus if negative >= 0 else -minus
        g = g + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate / (1 + t / 200) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return {"mean": mean, "sd": sd, "w": w}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    f = shaped(x, model["mean"], model["sd"]) @ model["w"]
    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def held_out(doc_id):
    """A fifth of the documents, by their id; of null, none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """A model from up to `sample` labelled positives and up to `sample` of all labelled documents, those with the least hashes of doc_id.

    The prior is the share of positives among all labelled ids that are not held out. None without positives.
    """
    told = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    told = cut(told)
    shares = told.agg(F.avg((F.col("quality") == 1).cast("double")).alias("prior")).first()
    pick = lambda df, seed: df.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)
    ids = pick(told.filter("quality = 1"), 1).withColumn("u", F.lit(0)).union(pick(told, 2).withColumn("u", F.lit(1)))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs).alias("text")).join(F.broadcast(cut(ids)), "doc_id").select("u", "text")  # at most 2 * sample ids

    def make(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(list(features(b.column(1).to_pylist()).astype(np.float32)), pa.list_(pa.float32()))], names=["u", "x"])

    if shares["prior"] is None:
        return None
    prior = min(float(shares["prior"]), 0.99)

    def fitted(batches):
        # one row of the model's floats; in a task, so that the driver holds no sample
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        u = np.concatenate([np.asarray(b.column(0)) for b in held]) == 1
        if u.all() or not u.any():
            return
        x = np.concatenate([np.asarray(b.column(1).flatten()) for b in held]).reshape(len(u), -1)
        held.clear()
        order = np.lexsort(x.T[::-1])  # the sums don't depend on the order in which rows came
        x, u = x[order], u[order]
        model = fit(x[~u].astype(np.float64), x[u].astype(np.float64), prior)
        yield pa.record_batch([pa.array([v.tobytes()], pa.binary()) for v in model.values()], names=["mean", "sd", "w"])

    # a shuffle of at most 2 * sample rows, as texts are read and counted in all tasks
    model = chosen.mapInArrow(make, "u int, x array<float>").repartition(1).mapInArrow(fitted, "mean binary, sd binary, w binary").first()
    return {k: np.frombuffer(v) for k, v in model.asDict().items()} if model else None


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, score). Null and empty texts have scores too; without a model all scores are 0.5."""

    def make(batches):
        for b in batches:
            x = features(b.column(1).to_pylist())
            s = predict(model, x) if model else np.full(len(x), 0.5)
            yield pa.record_batch([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs).alias("text")).mapInArrow(make, "doc_id long, score double")


def rate(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each document.

    Whole texts are scored, however long; null counts as empty, and empty texts have a score too. Null doc_id stays
    null and is not held out. Repeated rows are scored each. Ids with several labels are positives only if all are 1;
    null labels count for nothing, and without a positive every score is 0.5. Other columns are no input, whatever
    their names; an empty table gives an empty result.
    """
    out = score(docs, train(docs, labels, sample))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs whose text is predicted 1, with all columns; without a labelled positive all rows.

    Nulls, long and repeated texts as in rate(); an empty table gives an empty one.
    """
    model = train(docs, labels, sample)
    schema = docs.schema
    at = docs.columns.index("text")

    def keep(batches):
        for b in batches:
            texts = [x.encode() if x is not None else b"" for x in b.column(at).to_pylist()]
            good = predict(model, features(texts)) >= threshold if model else np.ones(len(texts), bool)
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, schema)


def op9_pu_quality(spark, sf_dir: str) -> DataFrame:
    return rate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
