"""Genomic indexes (BAI, CSI, TBI, FAI, CRAI) and the plans made from them; no Spark here."""

from __future__ import annotations

import gzip
import heapq
import struct
from dataclasses import dataclass, field

from strandframe.functions import storage

#: Fixed values of the binning scheme of BAI and TBI: the bits of a window, the levels, and a bin that holds statistics.
SHIFT, DEPTH = 14, 5
STATISTICS = 37450

Ranges = list[tuple[int, int]]


def merged(ranges: Ranges) -> Ranges:
    """The same places in disjoint ranges."""
    out: Ranges = []
    for begin, stop in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((begin, stop))
    return out


@dataclass
class Contig:
    """The bins of a contig: chunks of virtual offsets; `low` has the least offset by window (linear) or by bin (CSI)."""

    bins: dict[int, Ranges] = field(default_factory=dict)
    linear: list[int] = field(default_factory=list)
    low: dict[int, int] = field(default_factory=dict)
    shift: int = SHIFT
    depth: int = DEPTH

    def chunks(self, start: int, end: int) -> Ranges:
        """Disjoint virtual offset ranges that hold all records over 1-based start..end."""
        most = 1 << (self.shift + 3 * self.depth)
        first, last = start - 1, min(end, most) - 1
        if first > last:
            return []
        least = self.linear[min(first >> self.shift, len(self.linear) - 1)] if self.linear else 0
        found: Ranges = []
        base = 0
        for level in range(self.depth + 1):
            bits = self.shift + 3 * (self.depth - level)
            least = max(least, self.low.get(base + (first >> bits), 0))
            n = (last >> bits) - (first >> bits) + 1
            if n > len(self.bins):
                found += [c for b, x in self.bins.items() if base + (first >> bits) <= b <= base + (last >> bits) for c in x]
            else:
                found += [c for b in range(base + (first >> bits), base + (last >> bits) + 1) for c in self.bins.get(b, ())]
            base += 1 << 3 * level
        return merged([c for c in found if c[1] > least])

    def span(self) -> tuple[int, int] | None:
        """Where the contig's records begin and end."""
        every = [c for x in self.bins.values() for c in x]
        return (min(c[0] for c in every), max(c[1] for c in every)) if every else None

    def starts(self) -> list[int]:
        """Virtual offsets where records are known to begin."""
        return sorted({c[0] for x in self.bins.values() for c in x} | {x for x in self.linear if x} | {x for x in self.low.values() if x})


def _contigs(data: bytes, at: int, n: int, shift: int = SHIFT, depth: int = DEPTH, csi: bool = False) -> list[Contig]:
    out = []
    statistics = ((1 << 3 * (depth + 1)) - 1) // 7 + 1
    for _ in range(n):
        contig = Contig(shift=shift, depth=depth)
        (n_bins,) = struct.unpack_from("<i", data, at)
        at += 4
        for _ in range(n_bins):
            low = 0
            if csi:
                number, low, n_chunks = struct.unpack_from("<IQi", data, at)
                at += 16
            else:
                number, n_chunks = struct.unpack_from("<Ii", data, at)
                at += 8
            flat = struct.unpack_from(f"<{2 * n_chunks}Q", data, at)
            at += 16 * n_chunks
            if number != statistics:
                contig.bins[number] = list(zip(flat[::2], flat[1::2], strict=True))
                if csi:
                    contig.low[number] = low
        if not csi:
            (n_windows,) = struct.unpack_from("<i", data, at)
            contig.linear = list(struct.unpack_from(f"<{n_windows}Q", data, at + 4))
            at += 4 + 8 * n_windows
        out.append(contig)
    return out


def _names(block: bytes) -> list[str]:
    return block.rstrip(b"\0").decode().split("\0") if block else []


def read(path: str, names: list[str] | None = None) -> dict[str, Contig]:
    """Contigs of a BAI, CSI or TBI index by name; names in the header's order, where the index has none."""
    with storage.opened(path) as f:
        data = f.read()
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    if data[:4] == b"BAI\1":
        return dict(zip(names or [], _contigs(data, 8, struct.unpack_from("<i", data, 4)[0]), strict=False))
    if data[:4] == b"TBI\1":
        n, *_, size = struct.unpack_from("<8i", data, 4)
        return dict(zip(_names(data[36 : 36 + size]), _contigs(data, 36 + size, n), strict=False))
    if data[:4] == b"CSI\1":
        shift, depth, size = struct.unpack_from("<3i", data, 4)
        own = _names(data[16 + 28 : 16 + size]) if size > 28 else names or []
        (n,) = struct.unpack_from("<i", data, 16 + size)
        return dict(zip(own, _contigs(data, 20 + size, n, shift, depth, True), strict=False))
    raise ValueError(f"not a BAI, CSI or TBI index: {path}")


def pieces(contig: Contig, most: int, within: Ranges | None = None) -> Ranges:
    """The contig's records, or those in some ranges, cut where records begin into pieces of about `most` bytes of the file."""
    span = contig.span()
    if not span:
        return []
    points = contig.starts()
    out: Ranges = []
    for begin, end in [span] if within is None else within:
        cuts = [begin]
        for p in points:
            if cuts[-1] < p < end and (p >> 16) - (cuts[-1] >> 16) >= most:
                cuts.append(p)
        out += zip(cuts, [*cuts[1:], end], strict=True)
    return out


def packed(ranges: Ranges, groups: int) -> list[Ranges]:
    """Ranges in groups of nearly equal bytes, the largest dealt first."""
    weight = lambda r: max((r[1] >> 16) - (r[0] >> 16), 1)
    if len(ranges) <= groups:
        return [[r] for r in ranges]
    heap = [(0, i) for i in range(groups)]
    out: list[Ranges] = [[] for _ in range(groups)]
    for r in sorted(ranges, key=lambda r: (-weight(r), r)):
        load, i = heapq.heappop(heap)
        out[i].append(r)
        heapq.heappush(heap, (load + weight(r), i))
    return [sorted(x) for x in out]


def planned(contigs: dict[str, Contig], wanted: list[tuple[str, int, int]] | None, groups: int, most: int) -> tuple[list[Ranges], int]:
    """Groups of virtual offset ranges, one a task, and where the last contig's records end.

    Contigs are cut at `most` bytes, and where there are more contigs than groups also at a group's share, so that a
    heavy contig doesn't make one task long. wanted: (contig, first, last) regions; none for all records.
    """
    spans = [s for c in contigs.values() if (s := c.span())]
    end = max((s[1] for s in spans), default=0)
    if wanted is not None:
        by_name: dict[str, Ranges] = {}
        for name, a, b in wanted:
            if name in contigs:
                by_name.setdefault(name, []).extend(contigs[name].chunks(a, b))
        found = [r for name, x in by_name.items() for r in pieces(contigs[name], most, merged(x))]
        total = sum((b >> 16) - (a >> 16) for a, b in found)
        return packed(found, max(1, min(groups, -(-total // most)))), end
    if len(spans) > groups:
        total = sum((b >> 16) - (a >> 16) for a, b in spans)
        most = max(1, min(most, -(-total // groups)))
    return packed([r for c in contigs.values() for r in pieces(c, most)], groups), end


@dataclass(frozen=True)
class Sequence:
    """A contig of a FASTA file: name, bases, first byte, bases and bytes a line."""

    name: str
    bases: int
    offset: int
    per_line: int
    width: int

    @property
    def bytes(self) -> int:
        whole, rest = divmod(self.bases, max(self.per_line, 1))
        return whole * self.width + rest


def fai(path: str) -> list[Sequence]:
    out = []
    with storage.opened(path) as f:
        for line in f.read().decode().splitlines():
            if line.strip():
                parts = line.split("\t")
                if len(parts) < 5:
                    raise ValueError(f"not a line of a FAI index: {line!r}")
                out.append(Sequence(parts[0], *(int(x) for x in parts[1:5])))
    return out


def crai(path: str) -> list[tuple[int, int, int, int]]:
    """(contig number, first base, bases, container's byte) of a CRAI index's slices."""
    with storage.opened(path) as f:
        data = f.read()
    text = (gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data).decode()
    rows = [line.split("\t") for line in text.splitlines() if line.strip()]
    return [(int(r[0]), int(r[1]), int(r[2]), int(r[3])) for r in rows]
