"""Suffix-array dedup by bucket-pointer refinement.

Suffixes stand in buckets of equal q-grams, across the corpus. Buckets that one document alone has are settled. In
the others, equal stretches of text are taken out whole; what is left is refined by sorting suffixes on the bucket
identifiers of later offsets, 8 bytes to 16 to 32 to `length`, each round's identifiers serving in the next (see
`repeats.refined`), until suffixes of one bucket share `length` bytes. A bucket's first document owns the string.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWEST
from .repeats import Kind, covered, repeated, runs

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
DDL = "doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<start: long, end: long>>"


def remove_repeated_bytes(docs: DataFrame, length: int = 50) -> DataFrame:
    """Each document without the bytes covered by a `length`-byte string that starts in a document with a smaller doc_id.

    Returns doc_id, n_bytes, n_removed, kept (binary), spans (maximal removed runs, end exclusive). Null text:
    empty. Null doc_id: smaller than any other. Rows with the same doc_id are kept apart and are not earlier
    than each other. Other columns are ignored; an empty table gives an empty result.
    """
    if length < 4:
        raise ValueError("length must be at least 4")

    def finish(text: bytes, doc: int, starts: np.ndarray, again: np.ndarray, _src: np.ndarray, _at: np.ndarray) -> dict:
        mask = covered(starts[again], length, len(text))
        kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
        return {"doc_id": None if doc == LOWEST else doc, "n_bytes": len(text), "n_removed": int(mask.sum()), "kept": kept, "spans": [{"start": a, "end": b} for a, b in runs(mask)]}

    return repeated(docs, Kind(False, length, max(2, length * 24 // 50), False), finish, SCHEMA, DDL)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
