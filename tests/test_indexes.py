"""Indexes, splits and pushed filters against whole reads, without a session."""

import os
import random
import struct
import tempfile
import zlib

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan
from strandframe.functions import bgzf, cram, decode, index, storage
from strandframe.sources import fixtures
from strandframe.sources.files import PushingReader, Reader, schema_of

CONTIGS = ["chr1", "chr10", "chr2"]


def reader(kind: str, filters=(), **options) -> Reader:
    options = {k: str(v) for k, v in options.items()}
    if filters:
        options.setdefault("asked", os.path.join(tempfile.mkdtemp(), "asked.json"))
    made = (PushingReader if filters else Reader)(kind, schema_of(kind, options), options)
    if filters:
        assert list(made.pushFilters(list(filters))) == list(filters)  # Spark checks all of them again
    return made


def rows_of(r: Reader) -> list[dict]:
    return [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]


def read(kind: str, **options) -> list[dict]:
    return rows_of(reader(kind, **options))


REGIONS = ["chr1", "chr1:1-1", "chr1:16,000-17,000", "chr10:1-200,000", "chr2:999,000", "chr2:50,000-50,100", "none:1-5"]


def places(n: int) -> list[tuple[int, int, int]]:
    rng = random.Random(1)
    return sorted((rng.randrange(3), s := rng.randrange(1, 1_000_000), s + rng.choice([0, 9, 300, 100_000])) for _ in range(n))


def tabixed(tmp_path, kind: str, csi: bool, n: int = 800):
    rows = places(n)
    if kind == "vcf":
        # every third has its end in INFO
        rows = [(c, s, e if i % 3 == 0 else s) for i, (c, s, e) in enumerate(rows)]
    line = {"bed": lambda c, s, e, i: f"{CONTIGS[c]}\t{s - 1}\t{e}\tn{i}\n", "vcf": lambda c, s, e, i: f"{CONTIGS[c]}\t{s}\tn{i}\tA\t<DEL>\t.\t.\tDP={i}{f';END={e}' if e > s else ''}\tGT\t0/1\n"}[kind]
    head = b"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS\n" if kind == "vcf" else b"track x\n"
    data, spans = fixtures.packed([line(*r, i).encode() for i, r in enumerate(rows)], head, 700)
    path = tmp_path / f"x.{kind}.gz"
    path.write_bytes(data)
    own = tmp_path / "own"
    own.mkdir(exist_ok=True)
    there = own / f"x.{kind}.gz.{'csi' if csi else 'tbi'}"
    there.write_bytes(fixtures.tabix(rows, spans, CONTIGS, (2, 1, 2, 0) if kind == "vcf" else (0x10000, 1, 2, 3), csi))
    return path, own, there


@pytest.mark.parametrize("csi", [False, True])
@pytest.mark.parametrize("kind", ["bed", "vcf"])
def test_tabix_is_as_without_index(tmp_path, kind, csi):
    path, own, there = tabixed(tmp_path, kind, csi)
    whole = read(kind, path=path)
    assert len(whole) == 800
    for options in ({}, {"numPartitions": 2}, {"indexedSplitSize": 1000}):
        r = reader(kind, path=path, indexDir=own, **options)
        assert sorted(map(str, rows_of(r))) == sorted(map(str, whole))
        assert len(r.partitions()) == (2 if options.get("numPartitions") else 3) or len(r.partitions()) > 5
    for region in REGIONS:
        plain = read(kind, path=path, region=region)
        assert read(kind, path=path, region=region, indexDir=own) == plain
        assert read(kind, path=path, region=region, indexPath=there) == plain
        assert sorted(map(str, read(kind, path=path, region=region, indexPath=there, indexedSplitSize=500))) == sorted(map(str, plain))
        assert plain or region not in ("chr1", "chr10:1-200,000", "chr2:50,000-50,100")
    if kind == "vcf":
        assert whole[0]["genotypes"] == [("S", "0/1")]


def test_unreadable_tabix_is_a_full_scan(tmp_path):
    path, own, there = tabixed(tmp_path, "vcf", False)
    there.write_bytes(b"no index")
    assert len(read("vcf", path=path, indexDir=own)) == 800


@pytest.mark.parametrize("kind", ["bed", "vcf"])
def test_pushed_filters_choose_ranges(tmp_path, kind):
    path, own, _ = tabixed(tmp_path, kind, False)
    names = {"bed": ("chrom", "chromStart"), "vcf": ("chrom", "pos")}[kind]
    filters = [EqualTo((names[0].upper(),), "chr10"), GreaterThanOrEqual((names[1],), 300_000), LessThan((names[1],), 320_000)]
    wanted = lambda x: x[names[0]] == "chr10" and 300_000 <= x[names[1]] < 320_000
    r = reader(kind, filters, path=path, indexDir=own)
    got = rows_of(r)
    assert [x for x in got if wanted(x)] == [x for x in read(kind, path=path) if wanted(x)] != []
    assert len(got) < 100
    # without an index every row is read, so that Spark's own check decides
    assert len(rows_of(reader(kind, filters, path=path))) == 800
    assert len(rows_of(reader(kind, filters, path=path, indexDir=own, asked=""))) == 800
    # what a scan asked for before is in later plans of the same load
    asked = tmp_path / "asked"
    rows_of(reader(kind, filters, path=path, indexDir=own, asked=asked))
    again = rows_of(reader(kind, [EqualTo((names[0],), "chr10"), LessThan((names[1],), 9000)], path=path, indexDir=own, asked=asked))
    assert [x for x in again if wanted(x)] == [x for x in got if wanted(x)] and len({x["id" if kind == "vcf" else "name"] for x in again}) == len(again)
    assert len(rows_of(reader(kind, [LessThan((names[1],), 9000)], path=path, indexDir=own, asked=asked))) == 800
    assert len(rows_of(reader(kind, filters, path=path, indexDir=own, asked=asked))) == 800
    both = rows_of(reader(kind, [In((names[0],), ["chr1", "chr2", "none"])], path=path, indexDir=own))
    assert {x[names[0]] for x in both} == {"chr1", "chr2"} and len(both) == sum(x[names[0]] != "chr10" for x in read(kind, path=path))


def bam_file(tmp_path, n: int = 600, step: int = 700, long: int = 0):
    rows = [(c, s, s + 31) for c, s, _ in places(n)]
    reads = [(f"r{i}", 0, c, s, 60, [(32, "M")], -1, 0, 0, "ACGTNMRW" * 4, "I" * 32, [("NM", "i", i), ("ZZ", "Z", "x" * (i % 50))]) for i, (c, s, _) in enumerate(rows)]
    if long:
        reads[n // 2] = (*reads[n // 2][:5], [(long, "M")], -1, 0, 0, "A" * long, "I" * long, [])
        rows[n // 2] = (*rows[n // 2][:2], rows[n // 2][1] + long - 1)
    reads += [(f"u{i}", 4, -1, 0, 0, [], -1, 0, 0, "AC", "", []) for i in range(7)]
    rows += [(-1, 0, 0)] * 7
    header = [(c, 2_000_000) for c in CONTIGS]
    data, spans = fixtures.packed([fixtures.bam_read(r) for r in reads], fixtures.bam_head("@HD\tVN:1.6\n", header), step)
    path = tmp_path / "x.bam"
    path.write_bytes(data)
    return path, rows, spans


def test_bai_is_as_without_index(tmp_path):
    path, rows, spans = bam_file(tmp_path)
    whole = read("bam", path=path)
    assert len(whole) == 607 and whole[-1]["referenceName"] is None and whole[0]["sequence"] == "ACGTNMRW" * 4
    plain = {region: read("bam", path=path, region=region) for region in REGIONS}
    (tmp_path / "x.bam.bai").write_bytes(fixtures.bai(rows, spans, len(CONTIGS)))
    for region in REGIONS:
        assert read("bam", path=path, region=region) == plain[region]
        assert read("bam", path=path, region=region, useIndex="false") == plain[region]
    for options in ({}, {"numPartitions": 1}, {"numPartitions": 2}, {"indexedSplitSize": 2000}, {"indexedSplitSize": 1, "numPartitions": 1000}):
        got = rows_of(r := reader("bam", path=path, **options))
        assert sorted(x["readName"] for x in got) == sorted(x["readName"] for x in whole)
    assert len(r.partitions()) > 50
    meta = read("bam", path=path, metadata="true")
    assert meta[0]["_metadata"]["index_path"].endswith(".bai")
    filters = [EqualTo(("referenceName",), "chr2"), GreaterThanOrEqual(("start",), 900_000)]
    got = rows_of(reader("bam", filters, path=path))
    wanted = [x for x in whole if x["referenceName"] == "chr2" and x["start"] >= 900_000]
    assert [x for x in got if x in wanted] == wanted and len(got) < 200
    assert rows_of(reader("bam", [EqualTo(("referenceName",), "none")], path=path)) == []
    assert [x["qname"] for x in rows_of(reader("bam", [EqualTo(("rname",), "chr2")], path=path, columnNames="sam"))] == [x["readName"] for x in whole if x["referenceName"] == "chr2"]


def test_heavy_contig_is_cut(tmp_path):
    rows = [(0, 10 * i + 1, 10 * i + 50) for i in range(6000)] + [(c, 1, 50) for c in range(1, 12) for _ in range(5)]
    reads = [(f"r{i}", 0, c, s, 60, [(50, "M")], -1, 0, 0, "A" * 50, "I" * 50, []) for i, (c, s, _) in enumerate(rows)]
    data, spans = fixtures.packed([fixtures.bam_read(r) for r in reads], fixtures.bam_head("", [(f"c{i}", 1 << 20) for i in range(12)]), 4096)
    (tmp_path / "x.bam").write_bytes(data)
    (tmp_path / "x.bam.bai").write_bytes(fixtures.bai(rows, spans, 12))
    r = reader("bam", path=tmp_path / "x.bam", numPartitions=4)
    parts = [[x for b in r.read(p) for x in b.to_pylist()] for p in r.partitions()]
    assert sum(map(len, parts)) == 6055 and len({x["readName"] for p in parts for x in p}) == 6055
    assert len(parts) == 5 and sum(any(x["referenceName"] == "c0" for x in p) for p in parts) >= 2


@pytest.mark.parametrize("size", [300, 1000, 5000, 17_001, 1 << 20])
@pytest.mark.parametrize("long", [0, 40_000])
def test_unindexed_bam_splits_lose_nothing(tmp_path, size, long):
    path, _, _ = bam_file(tmp_path, 300, 700, long)
    r = reader("bam", path=path, bgzfSplitSize=size)
    assert [x["readName"] for x in rows_of(r)] == [f"r{i}" for i in range(300)] + [f"u{i}" for i in range(7)]


def test_bam_start_guess_at_every_byte(tmp_path):
    path, _, _ = bam_file(tmp_path, 60)
    with open(path, "rb") as f:
        blocks = bgzf.Blocks(f, 0)
        lengths = [n for _, n in decode.bam_header(blocks.read)]
        data = blocks.read(1 << 30)
    starts, at = [], 0
    while at < len(data):
        starts.append(at)
        at += 4 + struct.unpack_from("<i", data, at)[0]
    for i in range(len(data)):
        want = next((s for s in starts if s >= i), None)
        got = decode.bam_guess(data[i:], lengths, True, len(data) - i)
        assert got == (want - i if want is not None else None)


@pytest.mark.parametrize("size", [1, 100, 777, 5000])
@pytest.mark.parametrize("ends", [b"\n", b"\r\n"])
def test_packed_line_splits_lose_nothing(tmp_path, size, ends):
    lines = [f"chr1\t{i}\t{i + 1}\t{'x' * (i % 70)}".encode() for i in range(200)]
    for step, last in ((40, b""), (100, ends), (4096, ends)):
        blocks = [fixtures.bgzf_block(part) for at in range(0, 10**6, step) if (part := (ends.join(lines) + last)[at : at + step])]
        # an empty block in the middle, as files put together have
        (tmp_path / "x.bed.gz").write_bytes(b"".join(blocks[:3]) + fixtures.BGZF_END + b"".join(blocks[3:]) + fixtures.BGZF_END)
        got = read("bed", path=tmp_path / "x.bed.gz", bgzfSplitSize=size)
        assert [x["chromStart"] for x in got] == list(range(200))


@pytest.mark.parametrize("size", [1, 37, 300, 2000])
@pytest.mark.parametrize("suffix", ["fastq", "fastq.gz"])
def test_fastq_splits_lose_nothing(tmp_path, size, suffix):
    text = "\n".join(f"@r{i} d\n{'ACGT' * (i % 9)}\n+{'x' * (i % 3)}\n{'@' * (4 * (i % 9))}" + ("\n" if i % 5 == 0 else "") for i in range(150)).encode()
    path = tmp_path / f"a_R2_1.{suffix}"
    path.write_bytes(fixtures.bgzf(text, 150) if suffix.endswith("gz") else text)
    got = read("fastq", path=path, minSplitBytes=size, bgzfSplitSize=size)
    assert [x["readName"] for x in got] == [f"r{i}" for i in range(150)] and {x["readNumber"] for x in got} == {2}
    assert len(reader("fastq", path=path, minSplitBytes=size, bgzfSplitSize=size, numPartitions=3).partitions()) <= 3


def test_fastq_faults_raise():
    for lines in (["@a", "AC", "x", "II"], ["@a", "AC", "+", "III"]):
        with pytest.raises(ValueError):
            list(decode.fastq(lines, None))


@pytest.mark.parametrize("groups", [1, 2, 200])
@pytest.mark.parametrize("gap", [0, 128])
def test_fai_contigs(tmp_path, groups, gap):
    path = tmp_path / "x.fa"
    made, entries = b"", []
    for name, seq in [("a", "ACGTacgtNN"), ("b", "G"), ("c", ""), ("d", "ACGTAC")]:
        made += f">{name} text\r\n".encode()
        entries.append(f"{name}\t{len(seq)}\t{len(made)}\t3\t5")
        made += b"".join(seq[i : i + 3].encode() + b"\r\n" for i in range(0, len(seq), 3))
    path.write_bytes(made)
    plain = read("fasta", path=path)
    (tmp_path / "x.fa.fai").write_text("\n".join(entries) + "\n\n")
    assert read("fasta", path=path, numPartitions=groups, maxMergeGap=gap) == plain and len(plain) == 4
    assert [r["name"] for r in read("fasta", path=path, region="b")] == ["b"]
    assert [r["name"] for r in rows_of(reader("fasta", [In(("name",), ["b", "d"])], path=path))] == ["b", "d"]
    assert read("fasta", path=path, region="none") == []
    path.write_bytes(made[:-5])
    with pytest.raises(ValueError):
        read("fasta", path=path)
    (tmp_path / "x.fa.fai").write_text("a\t3\n")
    with pytest.raises(ValueError):
        read("fasta", path=path)


# CRAM

REFERENCE = {"c1": "".join(random.Random(2).choice("ACGT") for _ in range(5000)), "c2": "ACGTN" * 400}


def cram_reads(n: int = 40) -> list[tuple]:
    r = random.Random(4)
    out = []
    for i in range(n):
        c, pos = (0, 20 + 100 * i) if i < n * 3 // 4 else (1, 5 * i)
        bases = list(REFERENCE[["c1", "c2"][c]][pos - 1 : pos + 49])
        cigar = [(50, "M")]
        if i % 4 == 1:
            bases[7] = "ACGTN".replace(bases[7], "")[i % 4]
        if i % 4 == 2:
            bases = list("TTT") + bases[:20] + list("GG") + bases[20:30] + bases[35:]
            cigar = [(3, "S"), (20, "M"), (2, "I"), (10, "M"), (5, "D"), (15, "M")]
        seq = "".join(bases)
        out.append((f"q{i}", 16 if i % 3 == 0 else 0, c, pos, i, cigar, -1, 0, 0, seq, "".join(chr(33 + r.randrange(40)) for _ in seq) if i % 5 else "", [("NM", "i", i), ("ZA", "A", "x")]))
    # mates as neighbours: the one behind starts later
    pairs = []
    for i in range(0, 6, 2):
        a, b = out[i], out[i + 1]
        span = b[3] + 49 - a[3] + 1 + (5 if i == 0 and False else 0)
        pairs.append((f"p{i}", 1 | 64, a[3], b[3], span))
        out[i] = (f"p{i}", 1 | 64, *a[2:])
        out[i + 1] = (f"p{i}", 1 | 128 | 16, *b[2:])
    out.append(("lost", 4, -1, 0, 0, [], -1, 0, 0, "ACGTT", "IIIII", []))
    out.append(("bare", 4, -1, 0, 0, [], -1, 0, 0, "", "", []))
    return out


def cigar_of(read: tuple) -> str | None:
    return "".join(f"{n}{o}" for n, o in read[5]) or None


@pytest.mark.parametrize("each", [1000, 10])
@pytest.mark.parametrize("names", [True, False])
def test_cram_round_trip(tmp_path, each, names):
    contigs = [(n, len(s)) for n, s in REFERENCE.items()]
    header = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{m}\n" for n, m in contigs)
    fa, fai = b"", ""
    for n, s in REFERENCE.items():
        fa += f">{n}\n".encode()
        fai += f"{n}\t{len(s)}\t{len(fa)}\t60\t61\n"
        fa += b"".join(s[i : i + 60].encode() + b"\n" for i in range(0, len(s), 60))
    (tmp_path / "r.fa").write_bytes(fa)
    reads = cram_reads()
    data, rows = fixtures.cram(header, contigs, reads, each, REFERENCE, names)
    path = tmp_path / "x.cram"
    path.write_bytes(data)
    for indexed in (False, True):
        if indexed:
            (tmp_path / "r.fa.fai").write_text(fai)
        got = read("cram", path=path, referenceFile=tmp_path / "r.fa", numPartitions=3)
        assert len(got) == len(reads)
        for x, r in zip(got, reads, strict=True):
            assert names is False or x["readName"] == r[0]
            assert (x["cigar"], x["sequence"], x["baseQualities"]) == (cigar_of(r), r[9] or None, r[10] or None)
            assert (x["referenceName"], x["start"], x["mappingQuality"]) == (contigs[r[2]][0] if r[2] >= 0 else None, r[3] or None, r[4])
            assert dict(x["attributes"]).get("NM") == (f"i:{r[11][0][2]}" if r[11] else None)
        for i in range(0, 6, 2):
            a, b = got[i], got[i + 1]
            assert a["readName"] == b["readName"] and a["mateStart"] == b["start"] and b["mateStart"] == a["start"]
            end = b["start"] + decode.reference_length(b["cigar"]) - 1
            assert a["insertSize"] == end - a["start"] + 1 == -b["insertSize"]
            assert a["flags"] & 32 and not b["flags"] & 32
    bare = read("cram", path=path, referenceMode="none")
    assert bare[0]["sequence"] == "N" * 50 and bare[0]["cigar"] == "50M"
    plain = [x["readName"] for x in read("cram", path=path, region="c1:1000-2000")]
    (tmp_path / "x.cram.crai").write_bytes(fixtures.crai(rows))
    assert [x["readName"] for x in read("cram", path=path, region="c1:1000-2000")] == plain != []
    assert read("cram", path=path, region="c1:4900-4901") == []
    if each == 10:
        assert len(reader("cram", path=path).partitions()) > 3
        assert len(reader("cram", [EqualTo(("referenceName",), "c2")], path=path).partitions()) < len(reader("cram", path=path).partitions())


def test_reference_modes():
    with pytest.raises(ValueError):
        cram.mode("md5")


def rans_encoded(data: bytes, order: int) -> bytes:
    """rANS 4x8 of data, by the format's rules."""
    n, quarter = len(data), len(data) >> 2
    streams = [list(range(k, n, 4)) for k in range(4)] if order == 0 else [list(range(k * quarter, (k + 1) * quarter)) for k in range(3)] + [list(range(3 * quarter, n))]
    context = lambda s, j: 0 if order == 0 or j == 0 else data[s[j - 1]]
    counts: dict = {}
    for s in streams:
        for j, i in enumerate(s):
            own = counts.setdefault(context(s, j), {})
            own[data[i]] = own.get(data[i], 0) + 1
    tables, head = {}, b""

    def listed(symbols, body):
        # neighbours are told by a run
        out, i = b"", 0
        while i < len(symbols):
            run = 0
            while i + run + 1 < len(symbols) and symbols[i + run + 1] == symbols[i + run] + 1:
                run += 1
            out += bytes([symbols[i]]) + body(symbols[i])
            if run:
                out += bytes([symbols[i + 1], run - 1]) + body(symbols[i + 1])
                for j in range(2, run + 1):
                    out += body(symbols[i + j])
            i += run + 1
        return out + b"\0"

    for c, own in counts.items():
        total = sum(own.values())
        freq = {x: max(1, k * 4095 // total) for x, k in own.items()}
        while sum(freq.values()) > 4095:
            freq[max(freq, key=freq.get)] -= 1
        freq[max(freq, key=freq.get)] += 4095 - sum(freq.values())
        before, at = {}, 0
        for x in sorted(freq):
            before[x], at = at, at + freq[x]
        tables[c] = freq, before
    number = lambda f: bytes([f]) if f < 128 else bytes([128 | f >> 8, f & 255])
    one = lambda c: listed(sorted(tables[c][0]), lambda x: number(tables[c][0][x]))
    head = one(0) if order == 0 else listed(sorted(tables), one)
    # backwards, in the opposite order of decoding
    if order == 0:
        steps = [(i & 3, i // 4) for i in range(n)]
    else:
        steps = [(k, j) for j in range(quarter) for k in range(4)] + [(3, j) for j in range(quarter, len(streams[3]))]
    state, tail = [1 << 23] * 4, bytearray()
    for k, j in reversed(steps):
        freq, before = tables[context(streams[k], j)]
        x = data[streams[k][j]]
        while state[k] >= freq[x] << 19:
            tail.append(state[k] & 255)
            state[k] >>= 8
        state[k] = state[k] // freq[x] * 4096 + state[k] % freq[x] + before[x]
    body = head + struct.pack("<4I", *state) + bytes(reversed(tail))
    return bytes([order]) + struct.pack("<ii", len(body), n) + body


@pytest.mark.parametrize("order", [0, 1])
def test_rans(order):
    r = random.Random(1)
    for data in (b"a", b"abcabcabcabd" * 40, bytes(r.choice(b"ACGT\x01\x02\x03~") for _ in range(999)), bytes(range(1, 200)) * 3, b"\0\0\0\1" * 9):
        assert cram.rans(rans_encoded(data, order)) == data


def test_cram_numbers():
    for x in (0, 1, 127, 128, 16_383, 16_384, 2_097_151, 2_097_152, 268_435_455, 268_435_456, 2**31 - 1, -1, -2):
        assert cram.Bytes(fixtures.itf8(x)).itf8() == x
    for raw, want in ((b"\x05", 5), (b"\x81\x00", 256), (b"\xff" + b"\xff" * 8, -1), (b"\xfe" + bytes([1] + [0] * 6), 1 << 48)):
        assert cram.Bytes(raw).ltf8() == want
    s = cram.Slice(bytes([0b01011010, 0b11000000]), {})
    # gamma 010 -> 2, beta of 3 bits 110 -> 6, subexponential with k = 1: 10 then one bit 1 -> 3
    kinds = [cram.Encoding(cram.GAMMA, [0]), cram.Encoding(cram.BETA, [0, 3]), cram.Encoding(cram.SUBEXP, [0, 1])]
    assert [k.number(s) for k in kinds] == [2, 6, 3]
    huffman = cram.encoding(cram.Bytes(fixtures.itf8(3) + fixtures.itf8(8) + bytes([3, 65, 66, 67, 3, 1, 2, 2])))
    s = cram.Slice(bytes([0b01011000]), {})
    assert [huffman.number(s) for _ in range(3)] == [65, 66, 67]


# stores


def test_paths(tmp_path, monkeypatch):
    assert storage.local("dbfs:/a/b") == "/dbfs/a/b" and storage.local("file:///a") == "/a" and storage.local("s3://a/b") is None
    for p in ("http://a/b", "ftp://a/b", "adl://a", "wasb://a"):
        with pytest.raises(ValueError):
            storage.opened(p)
    from pyarrow import fs

    monkeypatch.setattr(storage, "remote", lambda path: (fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem()), path.partition("://")[2].rstrip("/")))
    path, rows, spans = bam_file(tmp_path)
    (tmp_path / "x.bam.bai").write_bytes(fixtures.bai(rows, spans, len(CONTIGS)))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "y.bam").write_bytes(path.read_bytes())
    assert read("bam", path="s3://x.bam", region="chr2") == read("bam", path=path, region="chr2")
    assert len(read("bam", path="s3://deep")) == len(read("bam", path="s3://deep/*.bam")) == 607
    assert read("bam", path="s3://deep/y.bam", metadata="true")[0]["_metadata"]["file_name"] == "y.bam"
    with pytest.raises(FileNotFoundError):
        read("bam", path="s3://none.bam")


def test_region_reads_fewer_bytes(tmp_path, monkeypatch):
    path, rows, spans = bam_file(tmp_path, 5000, 4096)
    seen = []
    opened = storage.opened

    def counted(p):
        f = opened(p)

        class Counting:
            def read(self, *n):
                out = f.read(*n)
                seen.append(len(out))
                return out

            def __getattr__(self, name):
                return getattr(f, name)

            def __enter__(self):
                return self

            def __exit__(self, *_):
                f.close()

        return Counting()

    monkeypatch.setattr(storage, "opened", counted)
    read("bam", path=path)
    whole, seen[:] = sum(seen), []
    (tmp_path / "x.bam.bai").write_bytes(fixtures.bai(rows, spans, len(CONTIGS)))
    got = rows_of(reader("bam", [EqualTo(("referenceName",), "chr2"), GreaterThanOrEqual(("start",), 990_000)], path=path))
    assert got and sum(seen) < whole / 3


def test_long_cigar_and_floats():
    ops = [(1, "M"), (1, "I")] * 40_000
    seq = "A" * 80_000
    body = fixtures.bam_read(("r", 0, 0, 1, 0, [(80_000, "S"), (40_000, "N")], -1, 0, 0, seq, "I" * 80_000, [("CG", "B", ("I", [n << 4 | "MIDNSHP=X".index(o) for n, o in ops])), ("FF", "f", 0.1)]))
    row = decode.bam_record(body[4:], ["c"])
    assert row[5] == "1M1I" * 40_000 and row[11] == {"FF": "f:0.1"}


def test_block_checks():
    block = fixtures.bgzf_block(b"abc" * 100)
    assert bgzf.block_size(block) == len(block) and bgzf.inflated(block) == b"abc" * 100
    with pytest.raises((ValueError, zlib.error)):
        bgzf.inflated(block[:20] + bytes([block[20] ^ 1]) + block[21:])


def test_bins_match_chunks():
    contig = index.Contig({fixtures.bin_of(5, 5): [(1, 2)], fixtures.bin_of(0, 1 << 20): [(3, 4)]})
    assert contig.chunks(6, 6) == [(1, 2), (3, 4)] and contig.chunks(1 << 24, 1 << 25) == []
