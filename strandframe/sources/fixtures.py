"""Genomics files made from the driver's tables, for the queries and tests; not public sinks.

Tasks turn the rows of ranges into parts of a file, in the folder that driver and executors share, and then copy the
parts to their places in it; one task joins what the parts tell of an index. The driver has names and sizes of parts alone.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import pickle
import shutil
import struct
import tempfile
import uuid
import zlib
from collections import namedtuple
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

VERSION = 3
SEQUENCE = "translate(md5(cast({} as string)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
#: Fixed values of the formats: the blocks that end BGZF and CRAM files.
BGZF_END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
CRAM_END = bytes.fromhex("0f000000ffffffff0fe0454f4600000000010005bdd94f0001000606010001000100ee63014b")
STEP = 1 << 14
SHIFT, DEPTH = 14, 5
#: Rows of a part of a file, and rows that a task holds at a time: a multiple of a CRAM slice's.
PART, HELD = 1 << 16, 8000

#: Ranges of virtual offsets of the records over windows first..last of a contig, by (contig number, first, last).
Runs = dict[tuple[int, int, int], list[tuple[int, int]]]


def bgzf_block(part: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(part) + z.flush()
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part))


def bgzf(data: bytes, step: int = STEP) -> bytes:
    return b"".join(bgzf_block(data[at : at + step]) for at in range(0, len(data), step)) + BGZF_END


def packed(records: list[bytes], head: bytes, step: int = STEP) -> tuple[bytes, list[tuple[int, int]]]:
    """A BGZF file, and the virtual offsets from and to of each record."""
    data = head + b"".join(records)
    blocks = [bgzf_block(data[at : at + step]) for at in range(0, len(data), step)]
    places = [0]
    for b in blocks:
        places.append(places[-1] + len(b))
    virtual = lambda x: places[x // step] << 16 | x % step
    spans, at = [], len(head)
    for r in records:
        spans.append((virtual(at), virtual(at + len(r))))
        at += len(r)
    return b"".join(blocks) + BGZF_END, spans


def bin_of(first: int, last: int, depth: int = DEPTH) -> int:
    """The least bin that holds 0-based first..last."""
    for level in range(depth, -1, -1):
        bits = SHIFT + 3 * (depth - level)
        if first >> bits == last >> bits:
            break
    return ((1 << 3 * level) - 1) // 7 + (first >> bits)


def windows_of(b: int, depth: int = DEPTH) -> range:
    """The windows of a bin."""
    level = next(x for x in range(depth, -1, -1) if b >= ((1 << 3 * x) - 1) // 7)
    size = 1 << 3 * (depth - level)
    first = (b - ((1 << 3 * level) - 1) // 7) * size
    return range(first, first + size)


def joined(into: Runs, found: Runs, by: int = 0) -> None:
    """Adds the runs of a later part of a file, whose offsets count from `by`."""
    for key, spans in found.items():
        own = into.setdefault(key, [])
        for begin, end in spans:
            if own and own[-1][1] == begin + by:
                own[-1] = (own[-1][0], end + by)
            else:
                own.append((begin + by, end + by))


def runs(rows: list[tuple[int, int, int]], spans: list[tuple[int, int]]) -> Runs:
    """rows: contig number, first and last base (1-based), sorted; a negative contig has no place."""
    out: Runs = {}
    for (c, first, last), span in zip(rows, spans, strict=True):
        if c < 0:
            continue
        own = out.setdefault((c, max(first, 1) - 1 >> SHIFT, max(last, 1) - 1 >> SHIFT), [])
        if own and own[-1][1] == span[0]:
            own[-1] = (own[-1][0], span[1])
        else:
            own.append(span)
    return out


def depth_of(found: Runs) -> int:
    """Levels of bins that hold all runs; BAI and TBI have DEPTH."""
    windows = max((last for _, _, last in found), default=0)
    return max(DEPTH, -(-windows.bit_length() // 3))


def binned(found: Runs, contigs: int, csi: bool = False, depth: int = DEPTH) -> bytes:
    """The contigs' part of an index."""
    bins: list[dict] = [{} for _ in range(contigs)]
    linear: list[dict] = [{} for _ in range(contigs)]
    for (c, first, last), spans in found.items():
        bins[c].setdefault(bin_of(first << SHIFT, last << SHIFT, depth), []).extend(spans)
        for w in range(first, last + 1):
            linear[c][w] = min(linear[c].get(w, spans[0][0]), spans[0][0])
    out = []
    for own, windows in zip(bins, linear, strict=True):
        out.append(struct.pack("<i", len(own)))
        for b, spans in sorted(own.items()):
            chunks: Runs = {}
            joined(chunks, {(0, 0, 0): sorted(spans)})
            low = struct.pack("<Q", next(windows[w] for w in windows_of(b, depth) if w in windows)) if csi else b""
            out.append(struct.pack("<I", b) + low + struct.pack("<i", len(chunks[0, 0, 0])) + b"".join(struct.pack("<2Q", *x) for x in chunks[0, 0, 0]))
        if not csi:
            flat, last = [], 0
            for w in range(max(windows, default=-1) + 1):
                last = windows.get(w, last)
                flat.append(last)
            out.append(struct.pack("<i", len(flat)) + struct.pack(f"<{len(flat)}Q", *flat))
    return b"".join(out)


def tabix_of(found: Runs, names: list[str], columns: tuple[int, int, int, int], csi: bool = False, depth: int = DEPTH) -> bytes:
    text = b"".join(n.encode() + b"\0" for n in names)
    facts = struct.pack("<7i", *columns, 35, 0, len(text)) + text
    if csi:
        return bgzf(b"CSI\1" + struct.pack("<3i", SHIFT, depth, len(facts)) + facts + struct.pack("<i", len(names)) + binned(found, len(names), True, depth))
    return bgzf(b"TBI\1" + struct.pack("<i", len(names)) + facts + binned(found, len(names)))


def tabix(rows, spans, names: list[str], columns: tuple[int, int, int, int], csi: bool = False) -> bytes:
    """A TBI or CSI index of text; columns: the format, then the columns of the contig, the first and the last base."""
    return tabix_of(runs(rows, spans), names, columns, csi)


def bai_of(found: Runs, contigs: int, csi: bool = False, depth: int = DEPTH) -> bytes:
    if csi:
        return bgzf(b"CSI\1" + struct.pack("<4i", SHIFT, depth, 0, contigs) + binned(found, contigs, True, depth))
    return b"BAI\1" + struct.pack("<i", contigs) + binned(found, contigs)


def bai(rows, spans, contigs: int) -> bytes:
    return bai_of(runs(rows, spans), contigs)


def tag_bytes(kind: str, value) -> bytes:
    if kind == "Z":
        return value.encode() + b"\0"
    if kind == "A":
        return value.encode()
    if kind == "B":
        of, values = value
        return of.encode() + struct.pack(f"<i{len(values)}{of if of != 'C' else 'B'}", len(values), *values)
    return struct.pack("<" + {"i": "i", "C": "B", "f": "f"}[kind], value)


def bam_head(header: str, contigs: list[tuple[str, int]]) -> bytes:
    text = header.encode()
    out = [b"BAM\1", struct.pack("<i", len(text)), text, struct.pack("<i", len(contigs))]
    for name, size in contigs:
        out.append(struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", size))
    return b"".join(out)


def bam_read(read: tuple) -> bytes:
    """read: name, flag, contig number, pos (1-based), mapq, [(length, op)], mate contig, mate pos, tlen, seq, qual, [(key, kind, value)]."""
    codes = {c: i for i, c in enumerate("=ACMGRSVTWYHKDBN")}
    name, flag, ref, pos, mapq, cigar, mref, mpos, tlen, seq, qual, tags = read
    nibbles = [codes[c] for c in seq] + [0] * (len(seq) % 2)
    body = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name) + 1, mapq, 4680, len(cigar), flag, len(seq), mref, mpos - 1, tlen) + name.encode() + b"\0"
    body += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(op)) for n, op in cigar)
    body += bytes(nibbles[i] << 4 | nibbles[i + 1] for i in range(0, len(nibbles), 2)) + (bytes(ord(c) - 33 for c in qual) or b"\xff" * len(seq))
    for key, kind, value in tags:
        body += key.encode() + kind.encode() + tag_bytes(kind, value)
    return struct.pack("<i", len(body)) + body


def bam(header: str, contigs: list[tuple[str, int]], reads: Iterable[tuple]) -> bytes:
    return bam_head(header, contigs) + b"".join(bam_read(r) for r in reads)


# CRAM


def itf8(x: int) -> bytes:
    x &= 0xFFFFFFFF
    for bits, mark in ((7, 0), (14, 0x80), (21, 0xC0), (28, 0xE0)):
        if x < 1 << bits:
            n = bits // 7
            return bytes([mark | x >> 8 * (n - 1)]) + (x & (1 << 8 * (n - 1)) - 1).to_bytes(n - 1, "big")
    return bytes([0xF0 | x >> 28, x >> 20 & 255, x >> 12 & 255, x >> 4 & 255, x & 15])


def cram_block(kind: int, ident: int, data: bytes, method: int = 1) -> bytes:
    body = gzip.compress(data, 6, mtime=0) if method == 1 else data
    out = bytes([method, kind]) + itf8(ident) + itf8(len(body)) + itf8(len(data)) + body
    return out + struct.pack("<I", zlib.crc32(out))


def cram_container(ref: int, start: int, span: int, n: int, counter: int, blocks: list[bytes], landmarks: list[int]) -> bytes:
    body = b"".join(blocks)
    out = struct.pack("<i", len(body)) + b"".join(itf8(x) for x in (ref, start, span, n, counter, 0, len(blocks), len(landmarks), *landmarks))
    return out + struct.pack("<I", zlib.crc32(out)) + body


SERIES = ["BF", "CF", "RI", "RL", "AP", "RG", "MF", "NS", "NP", "TS", "NF", "TL", "FN", "FC", "FP", "BS", "DL", "MQ", "BA", "QS"]
STRINGS = ["RN", "SC", "IN", "BB"]


def cram(header: str, contigs: list[tuple[str, int]], reads: list[tuple], each: int = 1000, reference: dict[str, str] | None = None, names: bool = True) -> tuple[bytes, list[tuple]]:
    """A CRAM file with one slice a container, and the rows of its CRAI index. Reads as for bam(), sorted; neighbours of one name are mates. Matches are stored as bases, or with a reference as what differs from it."""
    out = cram_head(header)
    data, index = cram_slices(contigs, reads, each, reference, names, len(out))
    return out + data + CRAM_END, index


def cram_head(header: str) -> bytes:
    text = header.encode()
    out = b"CRAM\x03\x00" + b"made".ljust(20, b"\0")
    return out + cram_container(0, 0, 0, 0, 0, [cram_block(0, 0, struct.pack("<i", len(text)) + text)], [])


def cram_slices(contigs: list[tuple[str, int]], reads: list[tuple], each: int = 1000, reference: dict[str, str] | None = None, names: bool = True, begin: int = 0, earlier: int = 0) -> tuple[bytes, list[tuple]]:
    """Containers of reads, which stand from the byte `begin` behind `earlier` other reads, and their rows of the index."""
    out, index = b"", []
    for at in range(0, len(reads), each):
        part = reads[at : at + each]
        refs = {r[2] for r in part}
        ref = refs.pop() if len(refs) == 1 else -2
        spans = [(r[3], r[3] + max(1, sum(n for n, o in r[5] if o in "MDN")) - 1) for r in part]
        start = min(s for s, _ in spans) if ref >= 0 else 0
        span = max(e for _, e in spans) - start + 1 if ref >= 0 else 0
        data: dict[str, bytearray] = {k: bytearray() for k in [*SERIES, *STRINGS, *(f"{k}#" for k in STRINGS)]}
        number = lambda key, x: data[key].extend(itf8(x))  # noqa: B023, E731
        lines: list[bytes] = []
        kinds: dict[bytes, list[bytes]] = {}

        def string(key: str, value: bytes, data=data):
            data[f"{key}#"].extend(itf8(len(value)))
            data[key].extend(value)

        before = start
        for i, (name, flag, own, pos, mapq, cigar, mref, mpos, tlen, seq, qual, tags) in enumerate(part):
            ahead = i + 1 < len(part) and part[i + 1][0] == name
            behind = i > 0 and part[i - 1][0] == name
            number("BF", flag)
            number("CF", (1 if qual else 0) | (4 if ahead else 0 if behind else 2) | (0 if seq else 8))
            if ref == -2:
                number("RI", own)
            number("RL", len(seq))
            number("AP", pos - before)
            before = pos
            number("RG", -1)
            if names:
                string("RN", name.encode())
            if ahead:
                number("NF", 0)
            elif not behind:
                number("MF", flag >> 5 & 1 | (flag >> 3 & 1) << 1)
                if not names:
                    string("RN", name.encode())
                number("NS", mref)
                number("NP", mpos)
                number("TS", tlen)
            line = b"".join(k.encode() + t.encode() for k, t, _ in tags)
            if line not in lines:
                lines.append(line)
            number("TL", lines.index(line))
            for k, t, value in tags:
                kinds.setdefault((k + t).encode(), []).append(tag_bytes(t, value))
            if not flag & 4:
                features, done, place = [], 0, pos
                for n, op in cigar:
                    if op == "M" and reference is None:
                        features.append((done + 1, "b", seq[done : done + n]))
                    elif op == "M":
                        bases = reference[contigs[own][0]][place - 1 : place - 1 + n]
                        for j, (x, y) in enumerate(zip(bases, seq[done : done + n], strict=True)):
                            if x != y:
                                features.append((done + j + 1, "X", "ACGTN".replace(x, "").index(y)))
                    elif op in "SI":
                        features.append((done + 1, op, seq[done : done + n]))
                    elif op == "D":
                        features.append((done + 1, "D", n))
                    done += n if op in "MSI" else 0
                    place += n if op in "MD" else 0
                number("FN", len(features))
                last = 0
                for where, kind, value in features:
                    data["FC"].append(ord(kind))
                    number("FP", where - last)
                    last = where
                    if kind == "X":
                        data["BS"].append(value)
                    elif kind == "D":
                        number("DL", value)
                    else:
                        string({"b": "BB", "S": "SC", "I": "IN"}[kind], value.encode())
                number("MQ", mapq)
            elif seq:
                data["BA"].extend(seq.encode())
            if qual:
                data["QS"].extend(ord(c) - 33 for c in qual)
        ids = {k: i + 1 for i, k in enumerate(data)}
        encoded = lambda kind, body: itf8(kind) + itf8(len(body)) + body
        series = b"".join(k.encode() + encoded(1, itf8(ids[k])) for k in SERIES)
        series += b"".join(k.encode() + encoded(4, encoded(1, itf8(ids[f"{k}#"])) + encoded(1, itf8(ids[k]))) for k in STRINGS)
        external = {ids[k]: bytes(v) for k, v in data.items() if v}
        made = b""
        for j, (key, values) in enumerate(kinds.items()):
            a, b = 100 + 2 * j, 101 + 2 * j
            made += itf8(int.from_bytes(key, "big")) + encoded(4, encoded(1, itf8(a)) + encoded(1, itf8(b)))
            external |= {a: b"".join(itf8(len(v)) for v in values), b: b"".join(values)}
        kept = b"RN" + bytes([names]) + b"AP\x01RR" + bytes([reference is not None]) + b"SM" + bytes([0b00011011] * 5)
        td = b"".join(x + b"\0" for x in lines)
        kept += b"TD" + itf8(len(td)) + td
        sized = lambda n, body: itf8(len(itf8(n) + body)) + itf8(n) + body
        head = cram_block(1, 0, sized(5, kept) + sized(len(SERIES) + len(STRINGS), series) + sized(len(kinds), made))
        facts = b"".join(itf8(x) for x in (ref, start, span, len(part), earlier + at, len(external) + 1, len(external) + 1, 0, *external, -1)) + bytes(16)
        blocks = [head, cram_block(2, 0, facts), cram_block(5, 0, b"", 0), *(cram_block(4, k, v) for k, v in external.items())]
        index.append((ref, start, span, begin + len(out), len(head), sum(map(len, blocks[1:]))))
        out += cram_container(ref, start, span, len(part), earlier + at, blocks, [len(head)])
    return out, index


def crai(rows: list[tuple]) -> bytes:
    return gzip.compress("".join("\t".join(map(str, r)) + "\n" for r in rows).encode())


# BCF


def typed(values: list[int]) -> bytes:
    return bytes([len(values) << 4 | 3]) + struct.pack(f"<{len(values)}i", *values)


def bcf_text(text: str) -> bytes:
    raw = text.encode()
    return (bytes([len(raw) << 4 | 7]) if len(raw) < 15 else bytes([0xF7]) + typed([len(raw)])) + raw


def bcf(header: str, rows: Iterable[tuple]) -> bytes:
    """rows: contig number, pos, id, ref, alts, qual, filter numbers, [(key number, ints, or None for a flag)], [(key number, genotype?, ints of each sample)]."""
    return bcf_head(header) + b"".join(map(bcf_record, rows))


def bcf_head(header: str) -> bytes:
    text = header.encode() + b"\0"
    return b"BCF\2\2" + struct.pack("<I", len(text)) + text


def bcf_record(row: tuple) -> bytes:
    contig, pos, ident, ref, alts, qual, filters, info, formats = row
    shared = struct.pack("<iii", contig, pos - 1, len(ref)) + (struct.pack("<f", qual) if qual is not None else b"\x01\0\x80\x7f")
    samples = len(formats[0][2]) if formats else 0
    shared += struct.pack("<II", (1 + len(alts)) << 16 | len(info), len(formats) << 24 | samples)
    shared += bcf_text(ident or ".") + b"".join(bcf_text(x) for x in [ref, *alts]) + (typed(filters) if filters else b"\0")
    for key, values in info:
        shared += typed([key]) + (typed(values) if values is not None else b"\0")
    own = b""
    for key, _, values in formats:
        own += typed([key]) + bytes([len(values[0]) << 4 | 3]) + b"".join(struct.pack(f"<{len(v)}i", *v) for v in values)
    return struct.pack("<II", len(shared), len(own)) + shared + own


# files from the driver's tables


def folder(spark, sf_dir: str, table: str) -> str:
    """A folder for files made from a table as it is now: in the session's shared folder, or in a local session in a temporary one."""
    path = f"{sf_dir}/{table}.parquet"
    st = os.stat(path) if os.path.exists(path) else None
    stamp = hashlib.md5(f"{VERSION} {path} {st and (st.st_size, st.st_mtime_ns)}".encode()).hexdigest()[:16]
    shared = (spark.conf.get("spark.checkpoint.dir", None) or "").removeprefix("file:")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    out = os.path.join(shared or os.path.join(tempfile.gettempdir(), f"strandframe-{os.getuid()}"), stamp)
    os.makedirs(out, exist_ok=True)
    return out


VCF_HEAD = "##fileformat=VCFv4.2\n##FILTER=<ID=PASS,Description=\"x\">\n##FILTER=<ID=q10,Description=\"x\">\n##INFO=<ID=DP,Number=1,Type=Integer,Description=\"x\">\n##INFO=<ID=SOMATIC,Number=0,Type=Flag,Description=\"x\">\n##INFO=<ID=AC,Number=A,Type=Integer,Description=\"x\">\n##FORMAT=<ID=GT,Number=1,Type=String,Description=\"x\">\n##FORMAT=<ID=DP,Number=1,Type=Integer,Description=\"x\">\n##contig=<ID=chr1>\n##contig=<ID=chr2>\n##contig=<ID=chr3>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\n"


def vcf_line(k: int, c: int) -> str:
    alts = "G,T" if k % 5 == 0 else "C"
    info = f"DP={k % 60}" + (";SOMATIC" if k % 2 else "") + f";AC={'1,2' if k % 5 == 0 else '1'}"
    return f"chr{c % 3 + 1}\t{k}\t{'.' if k % 4 == 0 else f'rs{k}'}\t{'AT' if k % 6 == 0 else 'A'}\t{alts}\t{'.' if k % 7 == 0 else k % 90}\t{('PASS', 'q10', '.')[k % 3]}\t{info if k % 8 else '.'}\tGT:DP\t0/{k % 2}:{k % 30}\t1|1:{k % 20}\n"


def bcf_row(k: int, c: int) -> tuple:
    info = [(2, [k % 60]), *([(3, None)] if k % 2 else []), (4, [1, 2] if k % 5 == 0 else [1])]
    formats = [(5, True, [[2, (k % 2 + 1) << 1], [4, 5]]), (2, False, [[k % 30], [k % 20]])]
    return c % 3, k, None if k % 4 == 0 else f"rs{k}", "AT" if k % 6 == 0 else "A", ["G", "T"] if k % 5 == 0 else ["C"], None if k % 7 == 0 else float(k % 90), ([0], [1], [])[k % 3], info if k % 8 else [], formats


def read_row(r, sorted_: bool) -> tuple:
    """A read of an order; in sorted files some have no place."""
    lost = sorted_ and r.k % 13 == 0
    flag = 4 if lost or r.k % 11 == 0 else 99 if r.k % 2 else 147
    ref, pos = (-1, 0) if lost else (r.c % 3, r.k * 10 + 1)
    cigar = [] if lost else [(r.k % 10 + 1, "S"), (31 - r.k % 10, "M")]
    tags = [("NM", "C", r.k % 8), ("RG", "Z", r.p)] + ([("XA", "A", "P"), ("XF", "f", r.k % 8 / 8), ("XB", "B", ("i", [1, r.k]))] if sorted_ else [])
    return f"r{r.k}", flag, ref, pos, r.k % 61 if not lost else 0, cigar, ref, r.k * 10 + 200 if not lost else 0, 231 if not lost else 0, r.s, "I" * 32, tags


def sam_line(r: tuple, contigs) -> str:
    return f"{r[0]}\t{r[1]}\t{contigs[r[2]][0]}\t{r[3]}\t{r[4]}\t{''.join(f'{n}{o}' for n, o in r[5])}\t=\t{r[7]}\t{r[8]}\t{r[9]}\t{r[10]}\tNM:i:{r[11][0][2]}\tRG:Z:{r[11][1][2]}\n"


def bed_line(r) -> str:
    return f"chr{r.u % 5 + 1}\t{r.e * 10}\t{r.e * 10 + 50 + r.e % 100}\t{r.t}\t{r.e % 1000}\t{'+-.'[r.e % 3]}\t{r.e * 10}\t{r.e * 10 + 5}\t{r.e % 3 * 65536}\t2\t1,2,\t0,{r.e % 9},\n"


def fasta_record(r) -> tuple[str, int, bytes, bytes]:
    """The name, the bases, the line of the name and the lines of the bases."""
    bases = r.s[: 20 + r.k % 12].lower() if r.k % 3 == 0 else r.s[: 20 + r.k % 12]
    return r.n, len(bases), f">{r.n} made\n".encode(), "".join(bases[i : i + 20] + "\n" for i in range(0, len(bases), 20)).encode()


TABLES = {"events": "events", "orders": "orders", "sorted": "orders", "nation": "nation", "part_R1_001": "part", "part_R2_001": "part", "peaks": "events"}
CONTIGS = [(f"chr{i}", 2**31 - 1) for i in (1, 2, 3)]


@dataclass
class File:
    """How a file is made: columns of the table, those made of them behind the sort, what it is sorted by (None: as the
    table is), what stands first and last, and the bytes and the index's rows of some rows, whose bytes count from 0."""

    columns: list[str]
    encode: Callable[[list], tuple[bytes, object]]
    late: tuple[str, ...] = ()
    order: list[str] | None = None
    head: bytes = b""
    tail: bytes = b""
    #: (index, rows of another part, the byte where that part begins) adds them; from the index its bytes and ending
    join: Callable[[object, object, int], None] | None = None
    index: Callable[[object], tuple[bytes, str]] | None = None
    empty: type = list


def plain(line: Callable, pack: str = "") -> Callable[[list], tuple[bytes, object]]:
    """Rows as they are, in BGZF blocks or as a member of gzip."""

    def encode(rows):
        data = b"".join(map(line, rows))
        return bgzf(data)[: -len(BGZF_END)] if pack == "bgzf" else gzip.compress(data, mtime=0) if pack else data, None

    return encode


def placed(line: Callable, place: Callable, of: Callable = lambda r: r) -> Callable[[list], tuple[bytes, object]]:
    """Rows, or what is made of them, in BGZF blocks, and their runs."""

    def encode(rows):
        rows = [of(r) for r in rows]
        data, spans = packed([line(r) for r in rows], b"")
        data = data[: -len(BGZF_END)]
        spans[-1] = (spans[-1][0], len(data) << 16)  # no block goes on behind these rows
        return data, runs([place(r) for r in rows], spans)

    return encode


def add_rows(into: list, rows: list[tuple], by: int, at: int) -> None:
    """Index rows of a later part; their item `at` is a byte."""
    into += [(*r[:at], r[at] + by, *r[at + 1 :]) for r in rows]


def packing(kind: str) -> str:
    """How a text file is packed."""
    return "bgzf" if kind.endswith((".bgz", ".gz")) and kind not in ("fastq.gz", "fa.gz") else "gzip" if kind.endswith(".gz") else ""


def file_of(name: str) -> File:
    """events: BED in the table's order; peaks: BED sorted, with an index; orders: VCF, BCF, SAM, BAM in the table's order;
    sorted: VCF, BAM, CRAM sorted, with an index; nation: FASTA, as .fasta with an index; part: FASTQ.

    Places over what a TBI or BAI index can tell get a CSI index of more levels.
    """
    stem, kind = name.split(".", 1)
    pack = packing(kind)
    tail = BGZF_END if pack == "bgzf" or kind in ("bcf", "bam") else b""
    head = lambda data: bgzf(data)[: -len(BGZF_END)] if tail else data
    offset = {"empty": dict, "join": lambda into, found, by: joined(into, found, by << 16)}
    if kind.startswith("bed"):
        columns, line = ["event_id e", "user_id u", "event_type t"], lambda r: bed_line(r).encode()
        facts = {"head": head(b"track name=x\n"), "tail": tail}
        if stem != "peaks":
            return File(columns, plain(line, pack), **facts)

        def told(found, names=tuple(f"chr{i}" for i in range(1, 6))):
            deep = depth_of(found)
            return tabix_of(found, names, (0x10000, 1, 2, 3), deep > DEPTH, deep), ".csi" if deep > DEPTH else ".tbi"

        return File(columns, placed(line, lambda r: (r.u % 5, r.e * 10 + 1, r.e * 10 + 50 + r.e % 100)), order=["pmod(u, 5)", "e", "u"], index=told, **facts, **offset)
    orders = ["o_orderkey k", "o_custkey c"]
    if kind == "bcf":
        return File(orders, plain(lambda r: bcf_record(bcf_row(r.k, r.c)), "bgzf"), head=head(bcf_head(VCF_HEAD)), tail=tail)
    if kind.startswith("vcf"):
        line = lambda r: vcf_line(r.k, r.c).encode()
        facts = {"head": head(VCF_HEAD.encode()), "tail": tail}
        if stem != "sorted":
            return File(orders, plain(line, pack), **facts)

        def told_vcf(found, names=("chr1", "chr2", "chr3")):
            deep = depth_of(found)
            csi = kind.endswith(".bgz") or deep > DEPTH
            return tabix_of(found, names, (2, 1, 2, 0), csi, deep), ".csi" if csi else ".tbi"

        return File(orders, placed(line, lambda r: (r.c % 3, r.k, r.k + (r.k % 6 == 0))), order=["pmod(c, 3)", "k"], index=told_vcf, **facts, **offset)
    if kind in ("fa", "fasta", "fa.gz"):

        def fasta(rows):
            out, fai = [], []
            at = 0
            for n, bases, title, lines in map(fasta_record, rows):
                fai.append((n, bases, at + len(title), 20, 21))
                out += [title, lines]
                at += len(title) + len(lines)
            data = b"".join(out)
            return gzip.compress(data, mtime=0) if pack else data, fai

        told_fai = lambda found: ("".join("\t".join(map(str, r)) + "\n" for r in found).encode(), ".fai")
        own = {"join": lambda into, rows, by: add_rows(into, rows, by, 2), "index": told_fai} if kind == "fasta" else {}
        return File(["n_name n", "n_nationkey k"], fasta, (SEQUENCE.format("k") + " s",), **own)
    if kind.startswith("fastq"):
        line = lambda r: f"@read{r.k}{' ' + r.b + ' 1:N:0' if r.k % 3 else ''}\n{r.s}\n+\n{'@' * 32}\n".encode()
        return File(["p_partkey k", "p_brand b"], plain(line, pack), (SEQUENCE.format("100 + k" if "_R2_" in name else "k") + " s",), tail=tail)
    in_order = stem == "sorted"
    header = f"@HD\tVN:1.6\tSO:{'coordinate' if in_order else 'unsorted'}\n" + "".join(f"@SQ\tSN:{n}\tLN:{m}\n" for n, m in CONTIGS)
    # reads without a place are the last
    order = ["k % 13 = 0", "if(k % 13 = 0, 0, pmod(c, 3))", "k"] if in_order else None
    reads = {"columns": [*orders, "o_orderpriority p"], "late": (SEQUENCE.format("k") + " s",), "order": order}
    if kind == "sam":
        return File(encode=plain(lambda r: sam_line(read_row(r, False), CONTIGS).encode()), head=header.encode(), **reads)
    if kind == "cram":
        return File(encode=lambda rows: (pickle.dumps([read_row(r, True) for r in rows]), None), head=cram_head(header), tail=CRAM_END, join=lambda into, rows, by: add_rows(into, rows, by, 3), index=lambda found: (crai(found), ".crai"), **reads)
    facts = {"head": head(bam_head(header, CONTIGS)), "tail": tail}
    if not in_order:
        return File(encode=plain(lambda r: bam_read(read_row(r, False)), "bgzf"), **reads, **facts)
    place = lambda x: (x[2], x[3], x[3] + max(1, sum(n for n, o in x[5] if o == "M")) - 1)

    def told_bam(found):
        deep = depth_of(found)
        return bai_of(found, len(CONTIGS), deep > DEPTH, deep), ".csi" if deep > DEPTH else ".bai"

    return File(encode=placed(bam_read, place, lambda r: read_row(r, True)), index=told_bam, **reads, **facts, **offset)


PARTS = "part long, name string, size long, n long"


def part_batch(part: int, name: str, size: int, n: int) -> pa.RecordBatch:
    return pa.record_batch([pa.array([part]), pa.array([name]), pa.array([size]), pa.array([n])], names=["part", "name", "size", "n"])


def written(file: File, where: str, part: int, chunks: Iterable[tuple[int, bytes, object]]) -> pa.RecordBatch:
    """A part of a file, and beside it what it tells of the index, under names of this attempt's own."""
    name = f"{part}-{TaskContext.get().taskAttemptId()}"
    found, size, n = file.empty(), 0, 0
    with open(f"{where}/{name}", "wb") as f:
        for rows, data, more in chunks:
            if file.join and more is not None:
                file.join(found, more, size)
            f.write(data)
            size, n = size + len(data), n + rows
    if file.index:
        with open(f"{where}/{name}.index", "wb") as f:
            pickle.dump(found, f)
    return part_batch(part, name, size, n)


def parts(spark, table: str, file: File, where: str) -> list:
    """Makes the file's parts: in order their names, sizes and rows."""
    rows = spark.read.parquet(table).selectExpr(*file.columns)
    many = -(-rows.count() // PART) or 1
    keys = [f"__{i}" for i in range(len(file.order or [1]))]
    rows = rows.selectExpr("*", *[f"{e} AS {k}" for e, k in zip(file.order, keys, strict=True)]) if file.order else rows.withColumn("__0", F.monotonically_increasing_id())
    rows = (rows.repartitionByRange(many, *keys) if many > 1 else rows.coalesce(1)).sortWithinPartitions(*keys)
    rows = rows.selectExpr(*[c.split()[1] for c in file.columns], *file.late)
    names = rows.columns

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = map(namedtuple("Row", names)._make, (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)))
        chunks = iter(lambda: list(islice(each, HELD)), [])
        yield written(file, where, TaskContext.get().partitionId(), ((len(x), *file.encode(x)) for x in chunks))

    return sorted(rows.mapInArrow(make, PARTS).collect())


def sliced(spark, file: File, where: str, sorted_reads: list) -> list:
    """CRAM parts of parts that hold pickled reads: a container tells how many reads stand before it."""
    before = [0, *accumulate(p.n for p in sorted_reads)]

    def chunks(i: int):
        at = before[i]
        with open(f"{where}/{sorted_reads[i].name}", "rb") as f:
            for _ in range(-(-sorted_reads[i].n // HELD)):
                reads = pickle.load(f)
                yield len(reads), *cram_slices(CONTIGS, reads, earlier=at)
                at += len(reads)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                yield written(file, where, i, chunks(i))

    out = sorted(spark.range(0, len(sorted_reads), 1, len(sorted_reads)).mapInArrow(make, PARTS).collect())
    for p in sorted_reads:
        os.remove(f"{where}/{p.name}")
    return out


def put_together(spark, file: File, where: str, found: list) -> str | None:
    """Copies parts to their places in `where`/file, and makes `where`/index; its ending."""
    begins = list(accumulate([len(file.head), *(p.size for p in found)]))
    with open(f"{where}/file", "wb") as f:
        f.write(file.head)
        f.seek(begins[-1])
        f.write(file.tail)
        f.truncate(begins[-1] + len(file.tail))

    def copied(i: int) -> None:
        own = f"{where}/{found[i].name}"
        if os.path.getsize(own) != found[i].size:  # emptied: an earlier attempt has copied it
            if os.path.getsize(own):
                raise OSError(f"{own} was cut short")
            return
        with open(own, "rb") as f, open(f"{where}/file", "r+b") as to:
            to.seek(begins[i])
            shutil.copyfileobj(f, to, 1 << 20)
        os.truncate(own, 0)

    def indexed() -> str:
        whole = file.empty()
        for p, by in zip(found, begins, strict=False):
            with open(f"{where}/{p.name}.index", "rb") as f:
                file.join(whole, pickle.load(f), by)
        data, ending = file.index(whole)
        with open(f"{where}/index", "wb") as f:
            f.write(data)
        return ending

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                yield pa.record_batch([pa.array([copied(i) if i < len(found) else indexed()], pa.string())], names=["ending"])

    n = len(found) + bool(file.index)
    got = spark.range(0, n, 1, min(n, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(run, "ending string").filter("ending is not null").collect() if n else []
    return got[0].ending if got else None


def made(spark, sf_dir: str, name: str) -> str:
    """The path of a file, which is made, with its index, if it isn't there; see file_of()."""
    table = TABLES[name.split(".", 1)[0]]
    path = os.path.join(folder(spark, sf_dir, table), name)
    if os.path.exists(path):
        return path
    file, where = file_of(name), os.path.join(os.path.dirname(path), f".making-{uuid.uuid4().hex}")
    os.mkdir(where)
    try:
        found = parts(spark, f"{sf_dir}/{table}.parquet", file, where)
        if name.endswith(".cram"):
            found = sliced(spark, file, where, found)
        ending = put_together(spark, file, where, found)
        if ending:
            os.replace(f"{where}/index", path + ending)
        os.replace(f"{where}/file", path)
    finally:
        shutil.rmtree(where, ignore_errors=True)
    return path
