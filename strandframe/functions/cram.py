"""CRAM 3.0 containers as alignment rows; no Spark here. The codecs that 3.1 adds raise."""

from __future__ import annotations

import bz2
import gzip
import lzma
import struct
import zlib
from collections.abc import Callable, Container, Iterator
from dataclasses import dataclass, field

from strandframe.functions import index, storage
from strandframe.functions.decode import ALL, fasta, tag_value

#: Fixed values of the format.
BASES = "ACGTN"
EXTERNAL, HUFFMAN, BYTES_LENGTH, BYTES_STOP, BETA, SUBEXP, GAMMA = 1, 3, 4, 5, 6, 7, 9
QUALITIES, DETACHED, DOWNSTREAM, NO_BASES = 1, 2, 4, 8
PAIRED, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST = 1, 4, 8, 16, 32, 64


def mode(text: str) -> str:
    if text not in ("file", "none"):
        raise ValueError(f"referenceMode must be file or none, not {text}")
    return text


class Bytes:
    """Bytes read one after another."""

    def __init__(self, b: bytes, at: int = 0):
        self.b, self.at = b, at

    def byte(self) -> int:
        self.at += 1
        return self.b[self.at - 1]

    def take(self, n: int) -> bytes:
        out = self.b[self.at : self.at + n]
        if len(out) != n:
            raise EOFError("CRAM data cut short")
        self.at += n
        return out

    def until(self, stop: int) -> bytes:
        end = self.b.index(stop, self.at)
        out = self.b[self.at : end]
        self.at = end + 1
        return out

    def int32(self) -> int:
        return struct.unpack("<i", self.take(4))[0]

    def itf8(self) -> int:
        """An integer whose first byte's leading ones count the bytes behind it."""
        x = self.byte()
        if x < 0x80:
            return x
        if x < 0xC0:
            return (x & 0x3F) << 8 | self.byte()
        if x < 0xE0:
            return (x & 0x1F) << 16 | int.from_bytes(self.take(2), "big")
        if x < 0xF0:
            return (x & 0x0F) << 24 | int.from_bytes(self.take(3), "big")
        rest = self.take(4)
        value = (x & 0x0F) << 28 | int.from_bytes(rest[:3], "big") << 4 | rest[3] & 0x0F
        return value - (1 << 32) if value >= 1 << 31 else value

    def ltf8(self) -> int:
        x = self.byte()
        more = 8 if x == 0xFF else 7 - (~x & 0xFF).bit_length() + 1
        value = (x & (0xFF >> min(more + 1, 8))) << 8 * more | int.from_bytes(self.take(more), "big")
        return value - (1 << 64) if value >= 1 << 63 else value

    def array(self) -> list[int]:
        return [self.itf8() for _ in range(self.itf8())]


class Bits:
    """Bits, the highest of a byte first."""

    def __init__(self, b: bytes):
        self.b, self.at = b, 0

    def bit(self) -> int:
        self.at += 1
        return self.b[self.at - 1 >> 3] >> (7 - (self.at - 1 & 7)) & 1

    def take(self, n: int) -> int:
        out = 0
        for _ in range(n):
            out = out << 1 | self.bit()
        return out


# rANS 4x8


def _frequencies(data: Bytes) -> tuple[list[int], list[int], bytes]:
    """Frequencies, their running sums and the symbol of each of 4096 slots."""
    freq, before, slots = [0] * 256, [0] * 256, bytearray()
    symbol, run = data.byte(), 0
    while True:
        f = data.byte()
        if f >= 128:
            f = (f & 127) << 8 | data.byte()
        freq[symbol], before[symbol] = f, len(slots)
        slots += bytes([symbol]) * f
        if run:
            run -= 1
            symbol += 1
        elif data.b[data.at] == symbol + 1:
            symbol = data.byte()
            run = data.byte()
        else:
            symbol = data.byte()
        if not symbol:
            return freq, before, bytes(slots).ljust(4096, b"\0")


def rans(block: bytes) -> bytes:
    data = Bytes(block)
    order, _, n = data.byte(), data.int32(), data.int32()
    if not n:
        return b""
    tables: dict[int, tuple] = {}
    if order == 0:
        tables[0] = _frequencies(data)
    else:
        context, run = data.byte(), 0
        while True:
            tables[context] = _frequencies(data)
            if run:
                run -= 1
                context += 1
            elif data.b[data.at] == context + 1:
                context = data.byte()
                run = data.byte()
            else:
                context = data.byte()
            if not context:
                break
    state = list(struct.unpack("<4I", data.take(16)))
    raw, at = data.b, data.at
    out = bytearray(n)

    def step(k: int, table: tuple) -> int:
        nonlocal at
        freq, before, slots = table
        x = state[k]
        low = x & 4095
        symbol = slots[low]
        x = freq[symbol] * (x >> 12) + low - before[symbol]
        while x < 1 << 23 and at < len(raw):
            x = x << 8 | raw[at]
            at += 1
        state[k] = x
        return symbol

    if order == 0:
        for i in range(n):
            out[i] = step(i & 3, tables[0])
        return bytes(out)
    quarter, last = n >> 2, [0] * 4
    for i in range(quarter):
        for k in range(4):
            last[k] = out[k * quarter + i] = step(k, tables[last[k]])
    for i in range(4 * quarter, n):
        last[3] = out[i] = step(3, tables[last[3]])
    return bytes(out)


UNPACK: dict[int, Callable[[bytes], bytes]] = {0: bytes, 1: lambda b: zlib.decompress(b, 31), 2: bz2.decompress, 3: lzma.decompress, 4: rans}


@dataclass
class Block:
    kind: int
    ident: int
    data: bytes


def block(data: Bytes) -> Block:
    begin = data.at
    method, kind, ident, packed, size = data.byte(), data.byte(), data.itf8(), data.itf8(), data.itf8()
    raw = data.take(packed)
    crc = struct.unpack("<I", data.take(4))[0]
    if zlib.crc32(data.b[begin : data.at - 4]) != crc:
        raise ValueError("damaged CRAM block")
    if method not in UNPACK:
        raise ValueError(f"CRAM compression method {method} is not supported")
    out = UNPACK[method](raw)
    if len(out) != size:
        raise ValueError("CRAM block of another size than stated")
    return Block(kind, ident, out)


@dataclass
class ContainerHead:
    begin: int
    data: int
    end: int
    ref: int
    blocks: int
    landmarks: list[int]


def container(f, at: int) -> ContainerHead | None:
    f.seek(at)
    head = f.read(1 << 12)
    if not head:
        return None
    b = Bytes(head)
    length, ref, start = b.int32(), b.itf8(), b.itf8()
    b.itf8(), b.itf8(), b.ltf8(), b.ltf8()
    blocks = b.itf8()
    n = b.itf8()
    while len(head) - b.at < 5 * n + 4 and (more := f.read(5 * n + 4)):
        head += more
        b.b = head
    landmarks = [b.itf8() for _ in range(n)]
    b.take(4)
    end = at + b.at + length
    # the last container holds no reads: nothing but a fixed start and an empty header
    return ContainerHead(at, at + b.at, end, ref, 0 if ref == -1 and start == 4542278 else blocks, landmarks)


@dataclass
class Header:
    contigs: list[tuple[str, int]]
    groups: list[str]
    end: int


def header(f) -> Header:
    f.seek(0)
    start = f.read(26)
    if start[:4] != b"CRAM":
        raise ValueError("not a CRAM file")
    if start[4] != 3:
        raise ValueError(f"CRAM {start[4]}.{start[5]} is not supported")
    first = container(f, 26)
    f.seek(first.data)
    text = block(Bytes(f.read(first.end - first.data))).data
    lines = text[4 : 4 + struct.unpack("<i", text[:4])[0]].decode().splitlines()
    field_ = lambda line, key: next((x[3:] for x in line.split("\t") if x.startswith(key + ":")), "")
    contigs = [(field_(x, "SN"), int(field_(x, "LN") or 0)) for x in lines if x.startswith("@SQ")]
    return Header(contigs, [field_(x, "ID") for x in lines if x.startswith("@RG")], first.end)


def containers(f, at: int, size: int) -> Iterator[int]:
    """Where containers of reads begin, from their headers alone."""
    while at < size and (c := container(f, at)):
        if c.blocks:
            yield at
        at = c.end


# encodings


class Slice:
    """The streams of a slice: core bits and external blocks."""

    def __init__(self, core: bytes, external: dict[int, bytes]):
        self.core = Bits(core)
        self.external = {k: Bytes(v) for k, v in external.items()}


@dataclass
class Encoding:
    kind: int
    numbers: list[int] = field(default_factory=list)
    codes: dict[tuple[int, int], int] = field(default_factory=dict)
    inner: list[Encoding] = field(default_factory=list)

    def number(self, s: Slice, one_byte: bool = False) -> int:
        if self.kind == EXTERNAL:
            data = s.external[self.numbers[0]]
            return data.byte() if one_byte else data.itf8()
        if self.kind == HUFFMAN:
            if (0, 0) in self.codes:
                return self.codes[0, 0]
            code = bits = 0
            while True:
                code, bits = code << 1 | s.core.bit(), bits + 1
                if (bits, code) in self.codes:
                    return self.codes[bits, code]
        offset = self.numbers[0]
        if self.kind == BETA:
            return s.core.take(self.numbers[1]) - offset
        if self.kind == GAMMA:
            n = 0
            while not s.core.bit():
                n += 1
            return (1 << n | s.core.take(n)) - offset
        if self.kind == SUBEXP:
            n = 0
            while s.core.bit():
                n += 1
            k = self.numbers[1]
            return (s.core.take(k) if not n else (1 << n + k - 1) + s.core.take(n + k - 1)) - offset
        raise ValueError(f"CRAM encoding {self.kind} is not supported")

    def many(self, s: Slice, n: int) -> bytes:
        if self.kind == EXTERNAL:
            return s.external[self.numbers[0]].take(n)
        return bytes(self.number(s, True) & 255 for _ in range(n))

    def bytes(self, s: Slice) -> bytes:
        if self.kind == BYTES_LENGTH:
            return self.inner[1].many(s, self.inner[0].number(s))
        if self.kind == BYTES_STOP:
            return s.external[self.numbers[1]].until(self.numbers[0])
        return bytes([self.number(s, True)])


def encoding(data: Bytes) -> Encoding:
    kind, size = data.itf8(), data.itf8()
    p = Bytes(data.take(size))
    if kind == EXTERNAL:
        return Encoding(kind, [p.itf8()])
    if kind == HUFFMAN:
        symbols, lengths = p.array(), p.array()
        codes, code, bits = {}, 0, 0
        for length, symbol in sorted(zip(lengths, symbols, strict=True)):
            code <<= length - bits
            bits = length
            codes[length, code] = symbol
            code += 1
        return Encoding(kind, codes=codes)
    if kind == BYTES_LENGTH:
        return Encoding(kind, inner=[encoding(p), encoding(p)])
    if kind == BYTES_STOP:
        return Encoding(kind, [p.byte(), p.itf8()])
    if kind in (BETA, SUBEXP):
        return Encoding(kind, [p.itf8(), p.itf8()])
    return Encoding(kind, [p.itf8()] if kind == GAMMA else [])


@dataclass
class Compression:
    """How a container's reads are stored."""

    names: bool = True
    deltas: bool = True
    swaps: dict[str, str] = field(default_factory=dict)
    tag_lines: list[list[bytes]] = field(default_factory=list)
    series: dict[str, Encoding] = field(default_factory=dict)
    tags: dict[int, Encoding] = field(default_factory=dict)


def compression(b: bytes) -> Compression:
    data, out = Bytes(b), Compression()
    data.itf8()
    for _ in range(data.itf8()):
        key = data.take(2).decode()
        if key == "SM":
            for base, code in zip(BASES, data.take(5), strict=True):
                others = BASES.replace(base, "")
                # two bits for each other base, by which a read names it
                by_code = {code >> 6 - 2 * i & 3: x for i, x in enumerate(others)}
                out.swaps[base] = "".join(by_code.get(i, "N") for i in range(4))
        elif key == "TD":
            lines = data.take(data.itf8())
            out.tag_lines = [[x[i : i + 3] for i in range(0, len(x), 3)] for x in lines.split(b"\0")[:-1]]
        else:
            value = bool(data.byte())
            if key == "RN":
                out.names = value
            elif key == "AP":
                out.deltas = value
    data.itf8()
    for _ in range(data.itf8()):
        key = data.take(2).decode()
        out.series[key] = encoding(data)
    data.itf8()
    for _ in range(data.itf8()):
        number = data.itf8()
        out.tags[number] = encoding(data)
    return out


class Reference:
    """Bases of a FASTA file, by its FAI index if there is one; without a file, N."""

    def __init__(self, path: str | None):
        self.path, self.file, self.whole = path, None, None
        self.places = {}

    def __enter__(self) -> Reference:
        if self.path:
            if storage.is_file(self.path + ".fai"):
                self.places = {c.name: c for c in index.fai(self.path + ".fai")}
                self.file = storage.opened(self.path)
            else:
                with storage.opened(self.path) as f:
                    text = gzip.GzipFile(fileobj=f) if self.path.lower().endswith(".gz") else f
                    self.whole = {name: bases for name, bases, _ in fasta(x.decode() for x in text)}
        return self

    def __exit__(self, *_) -> None:
        if self.file:
            self.file.close()

    def bases(self, name: str, start: int, n: int) -> str:
        """n bases from a 0-based start, N beyond the end."""
        got = ""
        if self.whole is not None:
            got = self.whole.get(name, "")[start : start + n]
        elif c := self.places.get(name):
            n_own = max(0, min(n, c.bases - start))
            at = lambda x: c.offset + x // c.per_line * c.width + x % c.per_line
            if n_own:
                self.file.seek(at(start))
                got = b"".join(self.file.read(at(start + n_own - 1) - at(start) + 1).split()).decode()
        return got.upper().ljust(n, "N")


def records(f, at: int, head: Header, reference: Reference, want: Container[int] = ALL) -> Iterator[tuple]:
    """Rows of the container that begins at a byte."""
    c = container(f, at)
    f.seek(c.data)
    data = Bytes(f.read(c.end - c.data))
    how = compression(block(data).data)
    for mark in c.landmarks:
        data.at = mark
        info = Bytes(block(data).data)
        ref, start, span, n = info.itf8(), info.itf8(), info.itf8(), info.itf8()
        counter, n_blocks = info.ltf8(), info.itf8()
        info.array()
        embedded = info.itf8()
        blocks = [block(data) for _ in range(n_blocks)]
        external = {x.ident: x.data for x in blocks if x.kind == 4}
        core = next((x.data for x in blocks if x.kind == 5), b"")
        own = external.get(embedded, b"").decode() if embedded >= 0 else None
        yield from rows(Slice(core, external), how, head, reference, (ref, start, span, n, counter), own, want)


def rows(s: Slice, how: Compression, head: Header, reference: Reference, place: tuple, own: str | None, want: Container[int]) -> Iterator[tuple]:
    ref, start, span, n, counter = place
    held = own if own is not None else reference.bases(head.contigs[ref][0], start - 1, span) if ref >= 0 and 9 in want else None
    get = lambda key: how.series[key].number(s)
    out: list[dict] = []
    before = start
    for i in range(n):
        r: dict = {"flag": get("BF"), "name": None, "mate": None, "tlen": 0}
        flags = get("CF")
        r["ref"] = get("RI") if ref == -2 else ref
        length = get("RL")
        pos = get("AP")
        if how.deltas:
            pos += before
            before = pos
        r["pos"], r["end"] = pos, pos
        group = get("RG")
        if how.names:
            r["name"] = how.series["RN"].bytes(s).decode()
        if flags & DETACHED:
            mate = get("MF")
            r["flag"] |= (MATE_REVERSE if mate & 1 else 0) | (MATE_UNMAPPED if mate & 2 else 0)
            if not how.names:
                r["name"] = how.series["RN"].bytes(s).decode()
            r["mate"] = get("NS"), get("NP")
            r["tlen"] = get("TS")
        elif flags & DOWNSTREAM:
            r["next"] = i + get("NF") + 1
        tags = {}
        for key in how.tag_lines[get("TL")] if how.tag_lines else []:
            raw = how.tags[int.from_bytes(key, "big")].bytes(s)
            kind = chr(key[2])
            if kind in "ZH" and not raw.endswith(b"\0"):
                raw += b"\0"
            tags[key[:2].decode()] = tag_value(kind, raw, 0)[0]
        if group >= 0 and group < len(head.groups):
            tags["RG"] = "Z:" + head.groups[group]
        r["tags"] = tags
        quals = bytearray(b"\xff") * length
        if not r["flag"] & UNMAPPED:
            bases = (lambda p, k: held[p - start : p - start + k].ljust(k, "N")) if held is not None else (lambda p, k: reference.bases(head.contigs[r["ref"]][0], p - 1, k) if 9 in want and r["ref"] >= 0 else "N" * k)  # noqa: B023
            r["seq"], r["cigar"], r["end"] = aligned(s, how, pos, length, bases, quals)
            r["mapq"] = get("MQ")
        else:
            r["seq"], r["cigar"], r["mapq"] = None, None, 0
            if not flags & NO_BASES:
                r["seq"] = how.series["BA"].many(s, length).decode()
        if flags & QUALITIES:
            quals = how.series["QS"].many(s, length)
        if flags & NO_BASES:
            r["seq"] = None
        r["qual"] = None if not length or all(x == 255 for x in quals) else bytes(min(x + 33, 255) for x in quals).decode("latin-1")
        out.append(r)
    mates(out, counter)
    for i, r in enumerate(out):
        name = r["name"] if r["name"] is not None else str(counter + i + 1)
        contig = lambda x: head.contigs[x][0] if x >= 0 else None
        m_ref, m_pos = r["mate"] or (-1, 0)
        pos = r["pos"] if r["ref"] >= 0 else 0
        yield None if name == "*" else name, r["flag"], contig(r["ref"]), pos or None, r["mapq"], r["cigar"], contig(m_ref), m_pos or None, r["tlen"], r["seq"] or None, r["qual"], r["tags"], pos - 1 if pos else None


def aligned(s: Slice, how: Compression, pos: int, length: int, bases: Callable[[int, int], str], quals: bytearray) -> tuple[str, str | None, int]:
    """A mapped read's bases, CIGAR and last place on the reference, from where it differs from that."""
    series = how.series
    parts: list[str] = []
    ops: list[list] = []
    done, at = 0, pos

    def op(n: int, kind: str) -> None:
        if n and ops and ops[-1][1] == kind:
            ops[-1][0] += n
        elif n:
            ops.append([n, kind])

    def match(n: int) -> None:
        nonlocal done, at
        if n > 0:
            parts.append(bases(at, n))
            op(n, "M")
            done, at = done + n, at + n

    def given(text: str, kind: str) -> None:
        nonlocal done, at
        parts.append(text)
        op(len(text), kind)
        done += len(text)
        at += len(text) if kind == "M" else 0

    where = 0
    for _ in range(series["FN"].number(s)):
        kind = chr(series["FC"].number(s, True))
        where += series["FP"].number(s)
        if kind not in "qQ":
            match(where - 1 - done)
        if kind == "X":
            code = series["BS"].number(s, True)
            base = bases(at, 1)
            given(how.swaps.get(base if base in BASES else "N", "NNNN")[code], "M")
        elif kind == "B":
            given(chr(series["BA"].number(s, True)), "M")
            quals[where - 1] = series["QS"].number(s, True)
        elif kind == "b":
            given(series["BB"].bytes(s).decode(), "M")
        elif kind == "I":
            given(series["IN"].bytes(s).decode(), "I")
        elif kind == "i":
            given(chr(series["BA"].number(s, True)), "I")
        elif kind == "S":
            given(series["SC"].bytes(s).decode(), "S")
        elif kind in "DN":
            n = series["DL" if kind == "D" else "RS"].number(s)
            op(n, kind)
            at += n
        elif kind in "PH":
            op(series["PD" if kind == "P" else "HC"].number(s), kind)
        elif kind == "Q":
            quals[where - 1] = series["QS"].number(s, True)
        elif kind == "q":
            values = series["QQ"].bytes(s)
            quals[where - 1 : where - 1 + len(values)] = values
        else:
            raise ValueError(f"CRAM read feature {kind!r} is not known")
    match(length - done)
    return "".join(parts), "".join(f"{n}{k}" for n, k in ops) or None, max(at - 1, pos)


def mates(out: list[dict], counter: int) -> None:
    """Fills in what reads of one template in a slice say of each other."""
    linked = {r["next"] for r in out if "next" in r}
    for i, first in enumerate(out):
        if "next" not in first or i in linked:
            continue
        chain = [first]
        while "next" in chain[-1]:
            chain.append(out[chain[-1]["next"]])
        name = next((r["name"] for r in chain if r["name"] is not None), str(counter + i + 1))
        left, right = min(r["pos"] for r in chain), max(r["end"] for r in chain)
        placed = all(r["ref"] == first["ref"] and not r["flag"] & UNMAPPED for r in chain) and first["ref"] >= 0
        leftmost = [r for r in chain if r["pos"] == left]
        for r, mate in zip(chain, [*chain[1:], first], strict=True):
            r["name"] = name
            r["mate"] = mate["ref"], mate["pos"]
            r["flag"] |= (MATE_REVERSE if mate["flag"] & REVERSE else 0) | (MATE_UNMAPPED if mate["flag"] & UNMAPPED else 0)
            if placed:
                ahead = r["pos"] == left and (len(leftmost) == 1 or bool(r["flag"] & FIRST))
                r["tlen"] = (right - left + 1) * (1 if ahead else -1)
