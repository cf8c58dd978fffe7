"""Windows of the corpus that also start earlier: the exchange under suffix_dedup and relative_lz.

Documents are dealt once, compressed, to chunks of a few MB and checkpointed. Windows are sampled by
content: a run of window starts with the same smallest q-gram at one place is one segment, so equal windows
always fall under equal q-grams. Three rounds follow. In each, a chunk sends sorted distinct keys, dealt to
buckets by their leading bits, and gets back one answer per key in the same order, so that no key travels
with its text and a key that a third of the corpus holds costs one row per chunk:

1. q-grams that one chunk alone has are settled: nothing under them repeats.
2. Segments under the others are compared whole; an earlier equal segment settles all its windows.
3. Where a q-gram has several segments, the first of each is refined window by window: of words by the windows'
   keys, of bytes by `refined()` on the segments' own text. Where documents do not repeat themselves, further
   copies in the first document take the answers of these.

Keys of whole segments, and of windows of words, have 128 bits of two independent hashes. Memory: one chunk, or one
bucket of about a million keys. A q-gram of bytes with more than HOT segments sends its windows one by one, dealt by
their own hashes, so that a very frequent line is no single key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWEST, ODD, cut, dealt, mix, text_column, word_bounds, word_hashes

CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 1 << 20
#: Segments under one q-gram beyond which its windows are dealt one by one.
HOT = 4096
#: Bytes of segments that are refined at once; segments of one q-gram stay together.
SLICE = 1 << 18
PIECE = 1 << 17
_rng = np.random.Generator(np.random.PCG64(77))
BYTE = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTOR = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_POWERS: dict[int, tuple] = {}


@dataclass(frozen=True)
class Kind:
    """How a text becomes symbols, the window's length, the q-gram's, and whether a document repeats itself."""

    words: bool
    window: int
    gram: int
    within: bool


def symbols_of(text: bytes, kind: Kind) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit values for each symbol."""
    data = np.frombuffer(text, np.uint8)
    if kind.words:
        bounds = word_bounds(data)
        return word_hashes(data, *bounds), word_hashes(data, *bounds, lane=1)
    return BYTE[0][data], BYTE[1][data]


def bucket_ids(values: np.ndarray, lane: int, size: int, steps: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Identifiers of the buckets of equal `size`-grams at each start.

    Identifiers of i symbols refine to 2i by those at the offset i; what was made on the way is used again.
    """
    steps = {} if steps is None else steps
    steps.setdefault(1, values)
    one = FACTOR[lane]

    def joined(a: int, b: int) -> np.ndarray:
        n = len(values) - a - b + 1
        return steps[a][:n] * np.uint64(pow(one, b, 2**64)) + steps[b][a : a + n]

    if len(values) < size:
        return np.zeros(0, np.uint64)
    done, power = 0, 1
    while True:
        if size & power:
            if done and done + power not in steps:
                steps[done + power] = joined(done, power)
            done += power
            if done == size:
                return steps[size]
        if power * 2 not in steps and power * 2 <= size:
            steps[power * 2] = joined(power, power)
        power *= 2


def powers(lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the lane's factor, and of its inverse, for a piece."""
    if lane not in _POWERS:
        n = PIECE * 2 + 4096
        both = []
        for f in (FACTOR[lane], pow(FACTOR[lane], -1, 2**64)):
            x = np.full(n, f, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x))
        _POWERS[lane] = tuple(both)
    return _POWERS[lane]


def keys_at(values: np.ndarray, lane: int, size: int, at: np.ndarray) -> np.ndarray:
    """Keys of the `size`-grams at some starts, from running sums."""
    up, down = powers(lane)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[at + size] - sums[at]) * down[at] + ODD[20 + lane])


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    have = 1
    n = len(x) - size + 1
    while have * 2 <= size:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return x[:n] if have == size else np.minimum(x[:n], x[size - have : size - have + n])


class Segments:
    """The segments of some texts: row i of doc, start, size, gram; with lanes also the 128-bit key."""

    def __init__(self, texts: list[bytes], kind: Kind, wanted: tuple[np.ndarray, int] | None = None):
        """wanted: (sorted leading bits of q-grams, how many bits are cut off); only their segments are kept."""
        self.kind = kind
        parts: list[list[np.ndarray]] = [[] for _ in range(6)]
        self.lengths = np.zeros(len(texts), np.int64)
        held: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        total = 0
        for i, text in enumerate(texts):
            a, b = symbols_of(text, kind)
            self.lengths[i] = len(a)
            for at in range(0, max(len(a) - kind.window + 1, 0), PIECE):
                held.append((i, at, a[at : at + PIECE + kind.window - 1], b[at : at + PIECE + kind.window - 1]))
                total += len(held[-1][2])
                if total >= PIECE:
                    self._add(held, parts, wanted)
                    held, total = [], 0
        if held:
            self._add(held, parts, wanted)
        join = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
        self.doc, self.start, self.size = (join(p, np.int64) for p in parts[:3])
        self.gram, self.one, self.two = (join(p, np.uint64) for p in parts[3:])

    def _add(self, held: list, parts: list, wanted: tuple[np.ndarray, int] | None) -> None:
        kind, L = self.kind, self.kind.window
        sizes = np.array([len(x[2]) for x in held])
        a = np.concatenate([x[2] for x in held])
        steps: dict[int, np.ndarray] = {}
        grams = mix(bucket_ids(a, 0, kind.gram, steps))
        low = sliding_min(grams, L - kind.gram + 1)
        n = len(low)
        ends = np.cumsum(sizes)
        valid = np.ones(n, bool)
        for e in ends[:-1].tolist():
            valid[max(e - L + 1, 0) : e] = False
        first = valid.copy()
        # a segment's windows have one leftmost place of the q-gram, so none of them equals another
        first[1:] &= ~valid[:-1] | (low[1:] != low[:-1]) | (grams[: n - 1] == low[1:])
        at = np.flatnonzero(first)
        close = np.ones(n, bool)
        close[:-1] = first[1:] | ~valid[1:]
        size = np.flatnonzero(close & valid) - at + 1
        gram = mix(low[at] + ODD[12])  # least hashes are small ones; buckets need even leading bits
        if wanted is not None:
            keep = found(gram >> np.uint64(wanted[1]), wanted[0])[1]
            at, size, gram = at[keep], size[keep], gram[keep]
        piece = np.searchsorted(ends, at, side="right")
        begin = (ends - sizes)[piece]
        parts[0].append(np.array([x[0] for x in held])[piece])
        parts[1].append(np.array([x[1] for x in held])[piece] + at - begin)
        parts[2].append(size)
        parts[3].append(gram)
        if wanted is not None:
            last = at + size - 1
            ends_at = np.concatenate([at, last])
            # a window's bucket: that of its q-gram, refined by those at later offsets
            ids, done = steps[kind.gram][ends_at], kind.gram
            while done < L:
                more = min(kind.gram, L - done)
                ids = ids * np.uint64(pow(FACTOR[0], more, 2**64)) + bucket_ids(a, 0, more, steps)[ends_at + done]
                done += more
            both = [mix(ids), keys_at(np.concatenate([x[3] for x in held]), 1, L, ends_at)]
            for lane, ids in enumerate(both):
                parts[4 + lane].append(mix(ids[: len(at)] * ODD[8] + ids[len(at) :] * ODD[9] + size.astype(np.uint64) * ODD[10 + lane]))


def window_keys(texts: list[bytes], kind: Kind, doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit keys of all windows of the segments given, which come in the order of the documents."""
    out: tuple[list, list] = ([], [])
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    for i in np.unique(doc).tolist():
        own = slice(cuts[i], cuts[i + 1])
        at = spread(start[own], size[own])
        for lane, values in enumerate(symbols_of(texts[i], kind)):
            for k in range(0, len(values), PIECE):
                here = at[(at >= k) & (at < k + PIECE)]
                if len(here):
                    out[lane].append(keys_at(values[k : k + PIECE + kind.window - 1], lane, kind.window, here - k))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out)  # type: ignore[return-value]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def found(x: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each would stand in a sorted array, and whether it does."""
    at = np.searchsorted(among, x)
    if not len(among):
        return at, np.zeros(len(x), bool)
    at = np.minimum(at, len(among) - 1)
    return at, among[at] == x


def distinct(keys: list[np.ndarray], doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows with the same keys, in the order of the keys: the row with the least (doc, pos); each row's class; the starts of classes in the order."""
    order = np.lexsort((pos, doc, *keys[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of, np.flatnonzero(new)


class Chunk:
    """A chunk of documents and what is known of it; every round makes the same arrays again."""

    def __init__(self, table: pa.Table, kind: Kind):
        un = zstandard.ZstdDecompressor()
        rows = sorted(zip(table["doc"].to_pylist(), table["z"].to_pylist(), strict=True))
        self.texts = [un.decompress(z) for _, z in rows]
        self.docs = np.array([d for d, _ in rows], np.int64)
        self.kind = kind

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct q-grams; whether more than one document here has it, or segment where documents repeat themselves."""
        s = Segments(self.texts, self.kind)
        gram = s.gram
        if not self.kind.within:
            order = np.lexsort((s.doc, gram))
            gram, doc = gram[order], s.doc[order]
            gram = gram[np.append(True, (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1]))] if len(gram) else gram
        keys, counts = np.unique(gram, return_counts=True)
        return keys, counts > 1

    def second(self, wanted: tuple[np.ndarray, int]) -> tuple[Segments, np.ndarray, np.ndarray]:
        s = Segments(self.texts, self.kind, wanted)
        first, of, _ = distinct([s.gram, s.one, s.two], self.docs[s.doc], s.start if self.kind.within else np.zeros(len(s.doc), np.int64))
        return s, first, of

    def third(self, s: Segments, first: np.ndarray, of: np.ndarray, told: Answers) -> tuple:
        """The first segments of several under one q-gram, and their windows."""
        own = first[told.several & (told.doc == self.docs[s.doc[first]]) & ((told.pos == s.start[first]) if self.kind.within else True)]
        own = own[np.argsort(s.doc[own], kind="stable")]
        # windows of one document must come in the order of their starts, piece by piece
        own = own[np.lexsort((s.start[own], s.doc[own]))]
        one, two = window_keys(self.texts, self.kind, s.doc[own], s.start[own], s.size[own])
        doc = np.repeat(s.doc[own], s.size[own])
        pos = spread(s.start[own], s.size[own])
        f, c, _ = distinct([one, two], self.docs[doc], pos if self.kind.within else np.zeros(len(pos), np.int64))
        return own, one, two, doc, pos, f, c


@dataclass
class Units:
    """What a chunk sends to be refined: first segments of several under one q-gram, or single windows of hot ones.

    own: the segments, by document and start; their windows, one after another, are `doc` and `pos`. key, start, size
    and at are those of the units, in the order of their keys; at is where a unit's windows stand among all.
    """

    own: np.ndarray
    doc: np.ndarray
    pos: np.ndarray
    key: np.ndarray
    unit_doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    at: np.ndarray


def units(chunk: Chunk, s: Segments, first: np.ndarray, told: Answers) -> Units:
    pick = told.several & (told.doc == chunk.docs[s.doc[first]])
    own, hot = first[pick], told.hot[pick]
    order = np.lexsort((s.start[own], s.doc[own]))
    own, hot = own[order], hot[order]
    size = s.size[own]
    parts = np.where(hot, size, 1)
    of = np.repeat(np.arange(len(own)), parts)
    step = spread(np.zeros(len(own), np.int64), parts)
    doc, start = s.doc[own][of], s.start[own][of] + step
    key = s.gram[own][of]
    for i in np.flatnonzero(hot[of]).tolist():
        key[i] = xxhash.xxh3_64_intdigest(chunk.texts[doc[i]][start[i] : start[i] + chunk.kind.window])
    by_key = np.argsort(key, kind="stable")
    own_at = np.cumsum(size) - size
    return Units(own, np.repeat(s.doc[own], size), spread(s.start[own], size), key[by_key], doc[by_key], start[by_key], np.where(hot[of], 1, size[of])[by_key], (own_at[of] + step)[by_key])


def asked_texts(chunk_id: int, chunk: Chunk, u: Units, bits: int) -> pa.Table:
    """The units' keys, documents, sizes and texts, dealt to buckets by the keys' leading bits."""
    lead = (u.key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(u.key), np.int64)
    at = np.flatnonzero(np.diff(lead, prepend=-1)) if len(lead) else np.zeros(0, np.int64)
    rows: dict[str, list] = {"bucket": [], "keys": [], "docs": [], "pos": []}
    c = zstandard.ZstdCompressor(3)
    for i, j in zip(at.tolist(), [*at[1:].tolist(), len(lead)][: len(at)], strict=True):
        texts = [chunk.texts[d][a : a + n + chunk.kind.window - 1] for d, a, n in zip(u.unit_doc[i:j].tolist(), u.start[i:j].tolist(), u.size[i:j].tolist(), strict=True)]
        rows["bucket"].append(int(lead[i]))
        rows["keys"].append(u.key[i:j].tobytes())
        rows["docs"].append(tight(chunk.docs[u.unit_doc[i:j]]))
        rows["pos"].append(c.compress(u.size[i:j].astype(np.int32).tobytes() + b"".join(texts)))
    return pa.table({"bucket": pa.array(rows["bucket"], pa.int64()), "chunk": pa.array([chunk_id] * len(at), pa.int64()), **{k: pa.array(rows[k], pa.binary()) for k in ("keys", "docs", "pos")}})


def refined(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A class for each start: starts of one class have the same `length` bytes behind them.

    Bucket-pointer refinement: suffixes stand in buckets of their first q bytes; sorted by the identifier of their
    bucket and of that at the offset q, they stand in buckets of 2q bytes, whose identifiers serve again for 4q. In
    the last step only buckets with several of the starts are refined; the others are settled.
    """
    have = 8
    while have > length:
        have //= 2
    n = np.uint64(len(data) + 1)
    values = np.zeros(len(data) - have + 1, np.uint64)
    for i in range(have):
        values = values << np.uint64(8) | data[i : i + len(values)]
    rank = lambda x: np.unique(x, return_inverse=True)[1].astype(np.uint64)
    ids = rank(values)
    while have * 2 <= length:
        ids = rank(ids[:-have] * n + ids[have:])
        have *= 2
    out = ids[at].astype(np.int64)
    if have < length:
        open_ = np.flatnonzero(np.bincount(out)[out] > 1)
        finer = rank(ids[at[open_]] * n + ids[at[open_] + length - have])
        out[open_] = finer.astype(np.int64) + int(n)
    return out


def earliest_texts(table: pa.Table, length: int) -> pa.Table:
    """Round 3 of bytes in a bucket: for each window of the units the first document that has it."""
    un = zstandard.ZstdDecompressor()
    key = [np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()]
    doc = [loose([b], np.int64) for b in table["docs"].to_pylist()]
    raw = [un.decompress(b) for b in table["pos"].to_pylist()]
    size = [np.frombuffer(r, np.int32, len(k)).astype(np.int64) for r, k in zip(raw, key, strict=True)]
    text = np.concatenate([np.frombuffer(r, np.uint8, offset=4 * len(k)) for r, k in zip(raw, key, strict=True)])
    windows = [int(x.sum()) for x in size]
    keys, docs, sizes = np.concatenate(key), np.concatenate(doc), np.concatenate(size)
    spans = sizes + length - 1
    begin, answer_at = np.cumsum(spans) - spans, np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.int64)
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(order))
    upto = np.cumsum(spans[order])[ends - 1]
    g = 0
    while g < len(starts):
        # whole groups of one key, up to a slice
        h = max(g + 1, int(np.searchsorted(upto, (upto[g - 1] if g else 0) + SLICE, side="right")))
        i, j, g = starts[g], ends[h - 1], h
        part = order[i:j]
        data = text[spread(begin[part], spans[part])]
        own = np.cumsum(spans[part]) - spans[part]
        found = refined(data, spread(own, sizes[part]), length)
        of = np.repeat(docs[part], sizes[part])
        by = np.lexsort((of, found))
        head = np.ones(len(by), bool)
        head[1:] = found[by][1:] != found[by][:-1]
        least = np.empty(len(by), np.int64)
        least[by] = of[by][head][np.cumsum(head) - 1]
        out[spread(answer_at[part], sizes[part])] = least
    flat = [out[e - n : e] for e, n in zip(np.cumsum(windows).tolist(), windows, strict=True)]
    none = [bytes(2 * -(-n // 8)) for n in windows]
    return told(table, 3, none, windows, [tight(x) for x in flat], [tight(np.zeros(0, np.int64))] * len(flat))


@dataclass
class Answers:
    """For each key of a chunk: the first document that has it, where, and whether its q-gram has several segments, or very many."""

    doc: np.ndarray
    pos: np.ndarray
    several: np.ndarray
    hot: np.ndarray


def answers(rows: list[dict]) -> Answers:
    rows = sorted(rows, key=lambda r: r["bucket"])
    bits: list[list] = [[], []]
    for r in rows:
        raw = np.frombuffer(r["bits"], np.uint8)
        for out, part in zip(bits, np.split(raw, 2), strict=True):
            out.append(np.unpackbits(part, count=r["n"]))
    several, hot = (np.concatenate(x).astype(bool) if x else np.zeros(0, bool) for x in bits)
    return Answers(loose([r["docs"] for r in rows], np.int64), loose([r["pos"] for r in rows], np.int64), several, hot)


TOLD = pa.schema([("chunk", pa.int64()), ("round", pa.int32()), ("bucket", pa.int64()), ("n", pa.int64()), ("docs", pa.binary()), ("pos", pa.binary()), ("bits", pa.binary())])
TOLD_DDL = "chunk long, round int, bucket long, n long, docs binary, pos binary, bits binary"
ASKED_DDL = "bucket long, chunk long, keys binary, docs binary, pos binary"


def asked(chunk: int, keys: list[np.ndarray], docs: np.ndarray | None, pos: np.ndarray | None, bits: int, cut40: bool = False) -> pa.Table:
    """Keys, sorted by the first, dealt to 2**bits buckets by its leading bits."""
    lead = (keys[0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys[0]), np.int64)
    at = np.flatnonzero(np.diff(lead, prepend=-1)) if len(lead) else np.zeros(0, np.int64)
    rows: dict[str, list] = {"bucket": [], "chunk": [], "keys": [], "docs": [], "pos": []}
    for i, j in zip(at.tolist(), [*at[1:].tolist(), len(lead)][: len(at)], strict=True):  # no keys, no rows
        rows["bucket"].append(int(lead[i]))
        rows["chunk"].append(chunk)
        if cut40:
            rows["keys"].append(five(keys[0][i:j] >> np.uint64(24 - bits)))
        else:
            rows["keys"].append(np.stack([k[i:j] for k in keys], 1).tobytes())
        rows["docs"].append(b"" if docs is None else np.packbits(docs[i:j]).tobytes() if cut40 else tight(docs[i:j]))
        rows["pos"].append(b"" if pos is None else pos[i:j].astype(np.int32).tobytes())
    return pa.table({"bucket": pa.array(rows["bucket"], pa.int64()), "chunk": pa.array(rows["chunk"], pa.int64()), **{k: pa.array(rows[k], pa.binary()) for k in ("keys", "docs", "pos")}})


def tight(x: np.ndarray) -> bytes:
    """Few different values, compressed."""
    return zstandard.ZstdCompressor(1).compress(x.tobytes())


def loose(blobs, kind) -> np.ndarray:
    un = zstandard.ZstdDecompressor()
    return np.frombuffer(b"".join(un.decompress(b) for b in blobs if b), kind)


def five(keys: np.ndarray) -> bytes:
    """The low 40 bits of each."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def eight(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return wide.reshape(-1).view("<u8")


def shared(table: pa.Table) -> pa.Table:
    """Round 1 in a bucket: to each chunk those of its keys that it has twice or another chunk has too."""
    blobs = table["keys"].to_pylist()
    sizes = [len(b) // 5 for b in blobs]
    keys = eight(b"".join(blobs))
    twice = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table["docs"].to_pylist(), sizes, strict=True)]).astype(bool)
    order = keys.argsort(kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    more = twice
    more[order[1:][same]] = True
    more[order[:-1][same]] = True
    ends = np.cumsum(sizes)
    picked = [five(keys[e - n : e][more[e - n : e]]) for e, n in zip(ends, sizes, strict=True)]
    return told(table, 1, picked, [len(x) // 5 for x in picked])


def told(table: pa.Table, nth: int, bits: list[bytes], sizes: list[int], docs: list[bytes] | None = None, pos: list[bytes] | None = None) -> pa.Table:
    n = len(bits)
    return pa.table({"chunk": table["chunk"].cast(pa.int64()), "round": pa.array([nth] * n, pa.int32()), "bucket": table["bucket"].cast(pa.int64()), "n": pa.array(sizes, pa.int64()), "docs": pa.array(docs or [b""] * n, pa.binary()), "pos": pa.array(pos or [b""] * n, pa.binary()), "bits": pa.array(bits, pa.binary())}, schema=TOLD)


def earliest(table: pa.Table, nth: int) -> pa.Table:
    """Rounds 2 and 3 in a bucket: for each key the least (document, position); of a q-gram, whether it has several segments."""
    width = 3 if nth == 2 else 2
    blobs = table["keys"].to_pylist()
    sizes = [len(b) // (8 * width) for b in blobs]
    keys = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, width)
    doc = loose(table["docs"].to_pylist(), np.int64)
    raw = b"".join(table["pos"].to_pylist())
    pos = np.frombuffer(raw, np.int32).astype(np.int64) if raw else np.zeros(len(doc), np.int64)
    lanes = [np.ascontiguousarray(keys[:, i]) for i in range(width)]
    first, of, _ = distinct(lanes, doc, pos)
    if nth == 2:
        own = lanes[0][first]
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        gram = np.cumsum(new) - 1
        count = np.bincount(gram)[gram][of] if len(own) else np.zeros(0, np.int64)
    else:
        count = np.zeros(len(of), np.int64)
    flags = lambda a, b: np.packbits(count[a:b] > 1).tobytes() + np.packbits(count[a:b] > HOT).tobytes()
    d, p = doc[first][of], pos[first][of]
    ends = np.cumsum(sizes)
    spans = [(e - n, e) for e, n in zip(ends.tolist(), sizes, strict=True)]
    return told(table, nth, [flags(a, b) for a, b in spans], sizes, [tight(d[a:b]) for a, b in spans], [tight(p[a:b]) for a, b in spans])


def known(rows: list[dict], bits: int) -> tuple[tuple[np.ndarray, int], dict[int, list[dict]]]:
    """From the answers so far: the leading bits of the q-grams that matter, and the answers by round."""
    by = {k: sorted((r for r in rows if r["round"] == k), key=lambda r: r["bucket"]) for k in (1, 2, 3)}
    leads = [eight(r["bits"]) + (np.uint64(r["bucket"]) << np.uint64(40)) for r in by[1]]
    return (np.concatenate(leads) if leads else np.zeros(0, np.uint64), 24 - bits), by


def deal(docs: DataFrame) -> tuple[DataFrame, int]:
    """(chunk, doc, z): the texts, compressed, checkpointed; and the bits of the bucket numbers."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc"), text_column(docs).alias("text"))
    total = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = max(1, -(-total // CHUNK_BYTES))
    bits = min(24, (total // 14 // BUCKET_KEYS).bit_length())

    def squeeze(batches):
        c = zstandard.ZstdCompressor(3)
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array([c.compress(x) for x in b.column(2).to_pylist()], pa.binary())], names=["chunk", "doc", "z"])

    numbered = own.select(F.pmod(F.xxhash64("doc", F.octet_length("text")), F.lit(chunks)).alias("chunk"), "doc", "text")
    return dealt(numbered.mapInArrow(squeeze, "chunk long, doc long, z binary"), "chunk"), bits


def repeated(docs: DataFrame, kind: Kind, finish: Callable[[bytes, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray], dict[str, Any]], schema: pa.Schema, ddl: str) -> DataFrame:
    """finish(text, doc, starts, repeated, source document, source start) for every document.

    starts are those of the windows under q-grams met elsewhere, ascending; all others start nowhere else.
    """
    chunks, bits = deal(docs)

    def round_one(key, table):
        grams, twice = Chunk(table, kind).grams()
        return asked(key[0].as_py(), [grams], twice, None, bits, True)

    def round_two(key, table, more):
        chunk = Chunk(table, kind)
        wanted, _ = known(more.to_pylist(), bits)
        s, first, _ = chunk.second(wanted)
        return asked(key[0].as_py(), [s.gram[first], s.one[first], s.two[first]], chunk.docs[s.doc[first]], s.start[first] if kind.within else None, bits)

    def round_three(key, table, more):
        chunk = Chunk(table, kind)
        wanted, by = known(more.to_pylist(), bits)
        s, first, of = chunk.second(wanted)
        if not kind.words:
            return asked_texts(key[0].as_py(), chunk, units(chunk, s, first, answers(by[2])), bits)
        _, one, two, doc, pos, f, _ = chunk.third(s, first, of, answers(by[2]))
        return asked(key[0].as_py(), [one[f], two[f]], chunk.docs[doc[f]], pos[f] if kind.within else None, bits)

    def last(key, table, more):
        chunk = Chunk(table, kind)
        wanted, by = known(more.to_pylist(), bits)
        s, first, of = chunk.second(wanted)
        said = answers(by[2])
        windows = answers(by[3])
        if kind.words:
            own, _, _, w_doc, w_pos, _, c = chunk.third(s, first, of, said)
            w_src, w_at = windows.doc[c], windows.pos[c]
        else:
            u = units(chunk, s, first, said)
            own, w_doc, w_pos = u.own, u.doc, u.pos
            w_src = np.zeros(len(w_doc), np.int64)
            w_src[spread(u.at, u.size)] = windows.doc
            w_at = np.zeros(len(w_doc), np.int64)
        # segments with an earlier equal one, whole; the windows of first segments one by one
        rest = np.ones(len(s.doc), bool)
        rest[own] = False
        rest = np.flatnonzero(rest)
        src, at = said.doc[of[rest]], said.pos[of[rest]]
        step = spread(np.zeros(len(rest), np.int64), s.size[rest])
        doc = np.concatenate([np.repeat(s.doc[rest], s.size[rest]), w_doc])
        pos = np.concatenate([spread(s.start[rest], s.size[rest]), w_pos])
        src, at = np.repeat(src, s.size[rest]), np.repeat(at, s.size[rest]) + step
        if not kind.within:
            # a segment that its first document holds again: the windows as where it sent them
            sent = np.full(len(first), -1)
            sent[of[own]] = np.cumsum(s.size[own]) - s.size[own]
            like = (sent[of[rest]] >= 0) & (said.doc[of[rest]] == chunk.docs[s.doc[rest]])
            where, these = spread(sent[of[rest]][like], s.size[rest][like]), np.repeat(like, s.size[rest])
            src[these], at[these] = w_src[where], w_at[where]
        src = np.concatenate([src, w_src])
        at = np.concatenate([at, w_at])
        order = np.lexsort((pos, doc))
        doc, pos, src, at = doc[order], pos[order], src[order], at[order]
        mine = chunk.docs[doc]
        again = (src < mine) | ((src == mine) & (at < pos) if kind.within else False)
        cuts = np.searchsorted(doc, np.arange(len(chunk.texts) + 1))
        out = [finish(t, int(chunk.docs[i]), pos[cuts[i] : cuts[i + 1]], again[cuts[i] : cuts[i + 1]], src[cuts[i] : cuts[i + 1]], at[cuts[i] : cuts[i + 1]]) for i, t in enumerate(chunk.texts)]
        return pa.Table.from_pylist(out, schema)

    with_told = lambda f, told_so_far, ddl: chunks.groupBy("chunk").cogroup(told_so_far.groupBy("chunk")).applyInArrow(f, ddl)
    first = cut(chunks.groupBy("chunk").applyInArrow(round_one, ASKED_DDL).groupBy("bucket").applyInArrow(shared, TOLD_DDL))
    second = cut(with_told(round_two, first, ASKED_DDL).groupBy("bucket").applyInArrow(lambda t: earliest(t, 2), TOLD_DDL))
    third = cut(with_told(round_three, first.unionByName(second), ASKED_DDL).groupBy("bucket").applyInArrow(lambda t: earliest(t, 3) if kind.words else earliest_texts(t, kind.window), TOLD_DDL))
    return with_told(last, first.unionByName(second).unionByName(third), ddl)


def covered(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of n symbols lie in a window at one of the starts."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + window, n), -1)
    return np.cumsum(step[:-1]) > 0


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
