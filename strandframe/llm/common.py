"""What the operators share: the checkpoint folder, hashed words and texts in bounded slabs."""

from __future__ import annotations

import gc
import tempfile
import time

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOWEST = -(2**63)
#: Least time between two collections of what checkpoints left behind, in local sessions; on a cluster each is collected.
COLLECT_SECONDS = 3.0
_collected = [0.0]
#: Words are runs of bytes other than these.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
#: Words up to this many bytes are hashed together.
SHORT_WORD = 64
#: Two independent random 64-bit values for a byte at a place of a word.
PLACE = _rng.integers(0, 2**64, (2, SHORT_WORD * 256), dtype=np.uint64, endpoint=False)
ODD = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where a local session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows from the shared folder, without lineage."""
    spark = df.sparkSession
    shared_folder(spark)
    out = df.checkpoint(eager=True)
    del df
    # shuffle files behind an earlier checkpoint are of no more use; Spark drops them when their RDDs are collected
    if not spark.sparkContext.master.startswith("local") or time.monotonic() - _collected[0] > COLLECT_SECONDS:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _collected[0] = time.monotonic()
    return out


def dealt(df: DataFrame, key: str) -> DataFrame:
    """cut() of df dealt by a key; what groups by the key later needs no shuffle of it.

    Spark keeps a checkpoint's partitioning only if its plan isn't adaptive.
    """
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(df.repartition(partitions(spark), key))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_column(docs: DataFrame, name: str = "text"):
    """The text's UTF-8 bytes; null is empty."""
    return F.coalesce(docs[name].cast("binary"), F.lit(b""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACES[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes; the two lanes are independent."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    held = np.minimum(sizes, SHORT_WORD)
    first = np.cumsum(held) - held
    place = np.arange(held.sum()) - np.repeat(first, held)
    values = PLACE[lane].take(place * 256 + data[np.repeat(starts, held) + place])
    out = mix(np.add.reduceat(values, first) + sizes.astype(np.uint64) * ODD[lane])
    for i in np.flatnonzero(sizes > SHORT_WORD).tolist():
        digest = xxhash.xxh3_128_digest(data[starts[i] : ends[i]].tobytes())
        out[i] = int.from_bytes(digest[8 * lane : 8 * lane + 8], "little")
    return out


def windows_hash(symbols: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of `size` symbols."""
    n = len(symbols) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = symbols[:n] * ODD[1]
    for i in range(1, size):
        total += symbols[i : i + n] * ODD[1 + i]
    return mix(total)


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct 63-bit hashes of a text's shingles of `size` words, A-Z as lower case.

    Fewer words: the whole sequence is the one shingle. No words: none.
    """
    data = np.frombuffer(text.lower(), np.uint8)
    words = word_hashes(data, *word_bounds(data))
    if not len(words):
        return np.zeros(0, np.int64)
    return np.unique(windows_hash(words, min(size, len(words))) >> np.uint64(1)).astype(np.int64)


def slabs(texts, size: int = 1 << 20):
    """Consecutive (first index, texts) of about `size` bytes."""
    held: list[bytes] = []
    total, at = 0, 0
    for i, text in enumerate(texts):
        held.append(text)
        total += len(text)
        if total >= size:
            yield at, held
            held, total, at = [], 0, i + 1
    if held:
        yield at, held


def many_shingles(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """shingles() of each text."""
    out: list[np.ndarray] = []
    for _, held in slabs(texts):
        data = np.frombuffer(b"\n".join(held).lower(), np.uint8)
        ends_at = np.cumsum([len(x) + 1 for x in held])
        starts, ends = word_bounds(data)
        words = word_hashes(data, starts, ends)
        upto = np.searchsorted(starts, ends_at)
        grams = windows_hash(words, size) >> np.uint64(1)
        since = 0
        for to in upto.tolist():
            n = to - since
            if n >= size:
                out.append(np.unique(grams[since : to - size + 1]).astype(np.int64))
            elif n:
                out.append((windows_hash(words[since:to], n) >> np.uint64(1)).astype(np.int64))
            else:
                out.append(np.zeros(0, np.int64))
            since = to
    return out
