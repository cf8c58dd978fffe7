"""Substring dedup by relative Lempel-Ziv parsing.

The reference is the whole corpus, indexed by all its windows in blocks dealt by their hashes. Every document is
factored greedily: at its first word that no factor covers and that begins a window found earlier, a factor is
extended while the following windows lie at the following places of the same source. Factors of at least `window`
words are duplicate spans. Windows that cross the end of a factor may come from another source: they are checked
one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWEST, word_bounds
from .repeats import Kind, covered, repeated, runs

FACTOR = [("start", pa.int64()), ("length", pa.int64()), ("source_doc", pa.int64()), ("source_start", pa.int64())]
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("factors", pa.list_(pa.struct(FACTOR)))])
DDL = "doc_id long, n_words long, n_removed long, kept binary, spans array<struct<start: long, end: long>>, factors array<struct<start: long, length: long, source_doc: long, source_start: long>>"


def parsed(starts: np.ndarray, src: np.ndarray, at: np.ndarray, window: int) -> tuple[list[dict], np.ndarray]:
    """The greedy parse, in words, and the starts of the windows that cross a boundary behind a factor.

    Given are the windows that start earlier, ascending, with their first occurrence. A factor begins at the
    first such window behind the last factor and goes on as long as its source does; windows that start in a
    factor's last words go beyond it and count by themselves.
    """
    if not len(starts):
        return [], starts
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (src[1:] != src[:-1]) | (np.diff(at) != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    out: list[dict] = []
    crossing, end = [], 0
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        k = i + max(0, end - int(starts[i]))  # a run's windows follow one another
        crossing.append(starts[i : min(k, j + 1)])
        if k <= j:
            end = int(starts[j]) + window
            out.append({"start": int(starts[k]), "length": end - int(starts[k]), "source_doc": None if src[k] == LOWEST else int(src[k]), "source_start": int(at[k])})
    return out, np.concatenate(crossing)


def factored(factors: list[dict], crossing: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of n words lie in a factor of `window` words or more, or in a window across a boundary."""
    step = np.zeros(n + 1, np.int64)
    for f in factors:
        if f["length"] >= window:
            step[f["start"]] += 1
            step[f["start"] + f["length"]] -= 1
    return (np.cumsum(step[:-1]) > 0) | covered(crossing, window, n)


def remove_repeated_words(docs: DataFrame, window: int = 20) -> DataFrame:
    """Each document without the words covered by a window of `window` words that also starts earlier.

    Earlier: in a document with a smaller doc_id, or before in the same one. Words are runs of characters
    other than ASCII white space, unchanged. Returns doc_id, n_words, n_removed, kept (the kept words joined
    by one space, UTF-8), spans (removed runs of words, end exclusive), factors. Null text: no words. Null
    doc_id: smaller than any other. Rows with the same doc_id and text are not earlier than each other but
    for a smaller start. Other columns are ignored; an empty table gives an empty result.
    """
    if window < 4:
        raise ValueError("window must be at least 4")

    def finish(text: bytes, doc: int, starts: np.ndarray, again: np.ndarray, src: np.ndarray, at: np.ndarray) -> dict:
        begins, _ = word_bounds(np.frombuffer(text, np.uint8))
        factors, crossing = parsed(starts[again], src[again], at[again], window)
        mask = factored(factors, crossing, window, len(begins))
        kept = b" ".join(w for w, gone in zip(text.split(), mask.tolist(), strict=True) if not gone) if len(begins) else b""
        return {"doc_id": None if doc == LOWEST else doc, "n_words": len(begins), "n_removed": int(mask.sum()), "kept": kept, "spans": [{"start": a, "end": b} for a, b in runs(mask)], "factors": factors}

    return repeated(docs, Kind(True, window, max(2, window * 8 // 20), True), finish, SCHEMA, DDL)


def op4_relative_lz(spark, sf_dir: str) -> DataFrame:
    out = remove_repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("factors").cast("long").alias("n_factors"))
