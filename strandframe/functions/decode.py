"""Records of the formats from lines or bytes; no Spark here."""

from __future__ import annotations

import re
import struct
from collections.abc import Container, Iterable, Iterator

import numpy as np

INTEGER = re.compile(r"[+-]?[0-9]+\Z")
CIGAR = re.compile(r"([0-9]+)([MIDNSHP=X])")
BASES = "=ACMGRSVTWYHKDBN"
OPS = "MIDNSHP=X"
ARRAYS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
#: A base for each half of a byte, and Phred+33 letters for qualities.
HEX = str.maketrans("0123456789abcdef", BASES)
PHRED = bytes(min(x + 33, 255) for x in range(256))
#: Numbers of the columns that may be left out.
ALL = range(13)


def integer(text: str, bits: int = 64) -> int | None:
    """A strict integer that fits, else None."""
    text = text.strip()
    if not INTEGER.match(text):
        return None
    n = int(text)
    return n if -(2 ** (bits - 1)) <= n < 2 ** (bits - 1) else None


def bed(line: str) -> tuple | None:
    if not line or line.startswith(("#", "track", "browser")):
        return None
    f = line.split("\t") if "\t" in line else line.split()
    if len(f) < 3:
        return None
    start, end = integer(f[1]), integer(f[2])
    if start is None or end is None:
        return None
    f += [""] * (12 - len(f))
    word = lambda x: None if x in ("", ".") else x
    trailing = lambda x: (x[:-1] if x.endswith(",") else x) or None
    rgb: str | None = f[8]
    if rgb in ("", "0", "."):
        rgb = None
    elif (n := integer(rgb)) is not None:
        rgb = f"{n >> 16 & 255},{n >> 8 & 255},{n & 255}"
    return f[0], start, end, word(f[3]), integer(f[4], 32), word(f[5]), integer(f[6]), integer(f[7]), rgb, integer(f[9], 32), trailing(f[10]), trailing(f[11])


def float32(value: float) -> str:
    """The shortest text of a single-precision number."""
    text = str(np.float32(value))
    return text[:-2] if text.endswith(".0") else text


def vcf(line: str, samples: list[str], want: Container[int] = ALL) -> tuple | None:
    """A row; INFO, FORMAT and genotypes are only parsed where they are wanted."""
    if not line or line.startswith("#"):
        return None
    f = line.split("\t") if 9 in want else line.split("\t", 9)
    if len(f) < 8 or (pos := integer(f[1], 32)) is None:
        return None
    word = lambda x: None if x in ("", ".") else x
    try:
        qual = float(f[5]) if word(f[5]) else None
    except ValueError:
        qual = None
    info = {}
    for part in f[7].split(";") if 7 in want and word(f[7]) else []:
        if part:
            key, eq, value = part.partition("=")
            info[key] = value if eq else "true"
    fmt = f[8] if len(f) > 8 else None
    own = dict(zip(samples, f[9:], strict=False)) if 9 in want and fmt and samples and len(f) > 9 else None
    return f[0], pos, word(f[2]), f[3], f[4].split(",") if word(f[4]) else None, qual, word(f[6]), info, fmt, own


def vcf_end(row: tuple, text: str | None = None) -> int:
    """The last base of a variant: INFO's END, or that of REF."""
    end = integer(text if text is not None else row[7].get("END", ""))
    return end if end is not None and end >= row[1] else row[1] + max(len(row[3]), 1) - 1


def samples_of(header: str) -> list[str]:
    """Sample names from the line with the columns' names."""
    return header.rstrip("\r\n").split("\t")[9:]


def sam(line: str) -> tuple | None:
    if not line or line.startswith("@"):
        return None
    f = line.split("\t")
    star = lambda x: None if x == "*" else x
    pos, mate = int(f[3]), int(f[7])
    tags = {x[:2]: x[3:] for x in f[11:]}
    for k, v in tags.items():
        if v[0] in "cCsSI":
            tags[k] = "i" + v[1:]
    return star(f[0]), int(f[1]), star(f[2]), pos or None, int(f[4]), star(f[5]), star(f[2]) if f[6] == "=" else star(f[6]), mate or None, int(f[8]), star(f[9]), star(f[10]), tags, pos - 1 if pos else None


def reference_length(cigar: str | None) -> int:
    """Bases of the reference that an alignment covers; one at least."""
    return max(1, sum(int(n) for n, op in CIGAR.findall(cigar or "") if op in "MDN=X"))


def fasta(lines: Iterable[str]) -> Iterator[tuple]:
    name, parts = None, []
    for line in lines:
        line = line.strip()
        if line.startswith(">"):
            if name is not None:
                yield name, "".join(parts), sum(map(len, parts))
            name, parts = (line[1:].split() or [""])[0], []
        elif name is not None and line:
            parts.append(line)
    if name is not None:
        yield name, "".join(parts), sum(map(len, parts))


def read_number(file: str) -> int | None:
    m = re.search(r"[._]R?0*([12])[._]", "_" + file, re.IGNORECASE)
    return int(m[1]) if m else None


def fastq(lines: Iterable[str], number: int | None) -> Iterator[tuple]:
    """Records of four lines; blank lines between them are passed over, a last record cut short is dropped."""
    it = iter(lines)
    for head in it:
        if not head.strip():
            continue
        if not head.startswith("@"):
            raise ValueError(f"not a FASTQ header: {head[:40]!r}")
        three = [next(it, None) for _ in range(3)]
        if None in three:
            return
        if not three[1].startswith("+") or len(three[0]) != len(three[2]):
            raise ValueError(f"not a FASTQ record: {head[:40]!r}")
        name, _, text = head[1:].partition(" ")
        yield name, three[0], three[2], text or None, number


def fastq_split(lines: Iterator[tuple[int, bytes]], owns) -> Iterator[str]:
    """Lines of the records whose first line is the split's. A record is known by @ and, two lines on, +: no quality line
    has a + there, as sequences hold none."""
    held: list[tuple[int, bytes]] = []
    for at, line in lines:
        held.append((at, line))
        if len(held) == 3:
            if held[0][1].startswith(b"@") and held[2][1].startswith(b"+"):
                break
            held.pop(0)
    else:
        return  # no record begins here

    def each() -> Iterator[tuple[int, bytes]]:
        yield from held
        yield from lines

    place = 0
    for at, line in each():
        if place == 0:
            if not line.strip():
                continue
            if not owns(at):
                return
        place = (place + 1) % 4
        yield line.decode()


def exactly(read, n: int) -> bytes:
    data = read(n)
    if len(data) != n:
        raise EOFError("BAM file cut short")
    return data


def bam_header(read) -> list[tuple[str, int]]:
    """Contigs and their lengths, from the start of an unpacked BAM stream up to its first record."""
    number = lambda: struct.unpack("<i", exactly(read, 4))[0]
    if exactly(read, 4) != b"BAM\1":
        raise ValueError("not a BAM file")
    exactly(read, number())
    out = []
    for _ in range(number()):
        name = exactly(read, number())[:-1].decode()
        out.append((name, number()))
    return out


def bam_records(read, names: list[str], more=lambda: True, want: Container[int] = ALL) -> Iterator[tuple]:
    while more() and (size := read(4)):
        yield bam_record(exactly(read, struct.unpack("<i", size)[0]), names, want)


def cigar_text(ops: Iterable[int]) -> str | None:
    return "".join([f"{x >> 4}{OPS[x & 15]}" for x in ops]) or None


def bam_record(b: bytes, names: list[str], want: Container[int] = ALL) -> tuple:
    """A row; name, CIGAR, sequence, qualities and tags are only decoded where they are wanted."""
    ref, pos, l_name, mapq, _, n_ops, flag, l_seq, mate_ref, mate, tlen = struct.unpack_from("<iiBBHHHiiii", b)
    at = 32 + l_name
    name = b[32 : at - 1].decode() if 0 in want else None
    ops = struct.unpack_from(f"<{n_ops}I", b, at) if 5 in want else ()
    at += 4 * n_ops
    half = (l_seq + 1) // 2
    seq = (b[at : at + half].hex().translate(HEX)[:l_seq] or None) if 9 in want else None
    at += half
    qual = None
    if 10 in want and l_seq and b[at] != 255:
        qual = b[at : at + l_seq].translate(PHRED).decode("latin-1")
    at += l_seq
    # more operations than a record can count are in tag CG, behind a clip of the whole read
    long = len(ops) == 2 and ops[0] == l_seq << 4 | 4 and ops[1] & 15 == 3
    found = tags(b, at, long) if 11 in want or long else None
    cigar = found.pop("CG") if found and long and "CG" in found else cigar_text(ops)
    contig = lambda i: names[i] if i >= 0 else None
    return None if name == "*" else name, flag, contig(ref), pos + 1 or None, mapq, cigar, contig(mate_ref), mate + 1 or None, tlen, seq, qual, found, pos if pos >= 0 else None


def tag_value(kind: str, b: bytes, at: int) -> tuple[str, int]:
    """A tag's text and the place behind it."""
    if kind in "ZH":
        end = b.index(0, at)
        return f"{kind}:{b[at:end].decode()}", end + 1
    if kind == "A":
        return f"A:{chr(b[at])}", at + 1
    if kind == "B":
        of, n = chr(b[at]), struct.unpack_from("<i", b, at + 1)[0]
        values = struct.unpack_from(f"<{n}{ARRAYS[of]}", b, at + 5)
        return ",".join([f"B:{of}", *(float32(v) if of == "f" else str(v) for v in values)]), at + 5 + n * struct.calcsize(ARRAYS[of])
    value = struct.unpack_from("<" + ARRAYS[kind], b, at)[0]
    return f"f:{float32(value)}" if kind == "f" else f"i:{value}", at + struct.calcsize(ARRAYS[kind])


def tags(b: bytes, at: int, cigar: bool = False) -> dict[str, str]:
    """Tags to the end of a record; with cigar, CG is the CIGAR's text."""
    out = {}
    while at < len(b):
        key, kind = b[at : at + 2].decode(), chr(b[at + 2])
        if cigar and key == "CG" and kind == "B":
            n = struct.unpack_from("<i", b, at + 4)[0]
            out[key] = cigar_text(struct.unpack_from(f"<{n}I", b, at + 8))
            at += 8 + 4 * n
            continue
        out[key], at = tag_value(kind, b, at + 3)
    return out


def bam_plausible(b: bytes, lengths: list[int]) -> bool:
    """Whether the bytes behind a record's size can be a record: every field in its range, the tags up to its end."""
    if len(b) < 33:
        return False
    ref, pos, l_name, _, _, n_ops, _, l_seq, mate_ref, mate, _ = struct.unpack_from("<iiBBHHHiiii", b)
    for r, p in ((ref, pos), (mate_ref, mate)):
        if not -1 <= r < len(lengths) or not -1 <= p <= (lengths[r] if r >= 0 else 2**31):
            return False
    at = 32 + l_name
    if l_name < 1 or l_seq < 0 or at + 4 * n_ops + (l_seq + 1) // 2 + l_seq > len(b):
        return False
    if b[at - 1] or not all(33 <= x <= 126 for x in b[32 : at - 1]):
        return False
    if any(x & 15 > 8 for x in struct.unpack_from(f"<{n_ops}I", b, at)):
        return False
    at += 4 * n_ops + (l_seq + 1) // 2 + l_seq
    try:
        while at < len(b):
            if not b[at : at + 2].isalnum():
                return False
            _, at = tag_value(chr(b[at + 2]), b, at + 3)
    except (KeyError, ValueError, IndexError, struct.error):
        return False
    return at == len(b)


def bam_guess(data: bytes, lengths: list[int], whole: bool, within: int, chain: int = 3) -> int | None:
    """The first of `within` bytes where records begin: `chain` of them follow one another, or fewer up to the end of the file.

    whole: the data reach the file's end. None if there is no such place; EOFError if the data end before it is known.
    """
    for start in range(min(within, len(data))):
        at, seen = start, 0
        while seen < chain:
            if at == len(data) and whole and seen:
                return start
            size = struct.unpack_from("<i", data, at)[0] if at + 4 <= len(data) else None
            if size is None or size >= 33 and at + 4 + size > len(data):
                if whole:
                    break
                if size is None or size < 1 << 28 and bam_head(data[at + 4 : at + 36], lengths, size):
                    raise EOFError
                break
            if size < 33 or not bam_head(data[at + 4 : at + 36], lengths, size) or not bam_plausible(data[at + 4 : at + 4 + size], lengths):
                break
            at += 4 + size
            seen += 1
        if seen == chain:
            return start
    return None


def bam_head(b: bytes, lengths: list[int], size: int) -> bool:
    """Whether a record's fixed fields are in their ranges and fit its size; of cut data what can be told."""
    if len(b) < 32:
        return True
    ref, pos, l_name, _, _, n_ops, _, l_seq, mate_ref, mate, _ = struct.unpack_from("<iiBBHHHiiii", b)
    fits = -1 <= ref < len(lengths) and -1 <= mate_ref < len(lengths) and pos >= -1 and mate >= -1
    return fits and l_name >= 1 and l_seq >= 0 and 32 + l_name + 4 * n_ops + (l_seq + 1) // 2 + l_seq <= size
