"""Spark data sources for BED, VCF, BCF, FASTA, FASTQ, SAM, BAM and CRAM files.

Plain lines are split by bytes: a split owns the lines that start in it. BGZF text, BAM and BCF are split at blocks, CRAM
at containers. With a BAI, CSI or TBI index, tasks get ranges of virtual offsets: all of a file in groups of nearly equal
bytes, or the chunks of a region. FASTA with a FAI index has one range of contigs a task. Plain gzip and FASTA without
an index are read by one task a file. Filters pushed down only choose contigs and ranges by an index; Spark checks all
of them again. `region` keeps records that overlap it, with or without an index.
"""

from __future__ import annotations

import gzip
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strandframe.functions import bcf, bgzf, cram, decode, index, schemas, storage
from strandframe.operators.regions import Region

ROWS = 8192
BATCH_BYTES = 64 << 20
SPLIT = 128 << 20
#: BCF packs some ten times its bytes into a block's, and its records take longest to decode.
BCF_SPLIT = 16 << 20
LAST = 2**31 - 1
#: Suffixes by format.
SUFFIXES = {"bed": (".bed", ".bed.gz", ".bed.bgz", ".bed.bgzf"), "vcf": (".vcf", ".vcf.gz", ".vcf.bgz", ".vcf.bgzf", ".bcf"), "fasta": (".fa", ".fasta", ".fna", ".fa.gz", ".fasta.gz"), "fastq": (".fq", ".fastq", ".fq.gz", ".fastq.gz", ".fastq.bgz"), "bam": (".bam", ".sam"), "cram": (".cram",)}
PACKED = (".gz", ".bgz", ".bgzf")
#: Endings of indexes that are read, added to the file's name.
INDEXES = {"bed": (".tbi", ".csi"), "vcf": (".tbi", ".csi"), "bam": (".bai", ".csi"), "cram": (".crai",), "fasta": (".fai",), "fastq": ()}
LINE_SPLIT = {"bed": "bedSplitSize", "vcf": "vcfSplitSize", "bam": "samSplitSize"}
#: The columns of a format by which an index finds records: the contig, and where a record begins and ends.
PLACES = {"bam": ("referencename", "start", None), "cram": ("referencename", "start", None), "vcf": ("chrom", "pos", None), "bed": ("chrom", "chromstart", "chromend"), "fasta": ("name", None, None), "fastq": (None, None, None)}
SAM_PLACES = ("rname", "pos", None)


@dataclass
class Span(InputPartition):
    """What one task reads: bytes of a file (end None: to its end), ranges of virtual offsets, contigs, or containers."""

    path: str
    start: int = 0
    end: int | None = None
    ranges: tuple = ()
    contigs: tuple = ()
    index: str | None = None
    how: str = "lines"


@dataclass
class Pushed:
    """What filters say of the records: their contigs (None: any), and the least and greatest first base, from 0 or 1 as the format has it."""

    contigs: set | None = None
    low: int = 0
    high: int = LAST

    def add(self, f, places: tuple) -> None:
        contig, start, end = places
        name = f.attribute[0].lower() if len(getattr(f, "attribute", ())) == 1 else None
        if name is None:
            return
        if name == contig and isinstance(f, (EqualTo, EqualNullSafe, In)):
            values = set(f.value if isinstance(f, In) else [f.value])
            if all(isinstance(x, str) for x in values):
                self.contigs = values if self.contigs is None else self.contigs & values
        value = getattr(f, "value", None)
        if name in (start, end) and isinstance(value, int) and not isinstance(value, bool):
            if name == start and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                self.low = max(self.low, value + isinstance(f, GreaterThan))
            if isinstance(f, (LessThan, LessThanOrEqual)) or name == start and isinstance(f, EqualTo):
                # a record ends no earlier than it begins
                self.high = min(self.high, value - isinstance(f, LessThan))

    def regions(self, kind: str) -> list[tuple[str, int, int]] | None:
        """(contig, first, last), 1-based; None if no contig is named."""
        if self.contigs is None:
            return None
        low, high = (self.low + 1, self.high + 1) if kind == "bed" else (self.low, self.high)
        # an interval of no length is found by the base before or behind it
        low, high = max(low - (kind == "bed"), 1), min(high + (kind == "bed"), LAST)
        return [(c, low, high) for c in sorted(self.contigs)] if low <= high else []


def listed(options: dict, kind: str) -> list[str]:
    """Files of paths, globs and folders, in order, each once."""
    given = json.loads(options["paths"]) if options.get("paths") else [options.get("path")]
    out: list[str] = []
    for p in given:
        if not p:
            raise ValueError("no path")
        p = storage.local(p) or p
        what = storage.info(p)[0]
        if what == "folder":
            out += [f for f in storage.children(p) if f.lower().endswith(SUFFIXES[kind])]
        elif what == "file":
            out.append(p)
        elif found := storage.matching(p):
            out += [f for f in found if not f.lower().endswith(tuple(e for x in INDEXES.values() for e in x))]
        else:
            raise FileNotFoundError(p)
    return list(dict.fromkeys(out))


def positive(options: dict, name: str, default: int) -> int:
    n = int(options.get(name, default))
    if n <= 0:
        raise ValueError(f"{name} must be positive")
    return n


def base_name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def index_of(path: str, kind: str, options: dict, alone: bool) -> str | None:
    """The file's index: indexPath (of one file only), then in indexDir, then beside the file."""
    low, ends = path.lower(), INDEXES[kind]
    if options.get("useIndex", "true").lower() == "false" or not ends:
        return None
    if low.endswith(".sam") or kind in ("bed", "vcf") and not low.endswith((*PACKED, ".bcf")) or kind == "fasta" and low.endswith(PACKED):
        return None
    own = lambda p: storage.local(p) or p
    tried = [own(options["indexPath"])] if alone and options.get("indexPath") else []
    if options.get("indexDir"):
        tried += [f"{own(options['indexDir']).rstrip('/')}/{base_name(path)}{e}" for e in ends]
    tried += [path + e for e in ends] + ([path[:-4] + ".bai"] if low.endswith(".bam") else [])
    return next((x for x in tried if x.lower().endswith(ends) and storage.is_file(x)), None)


class Reader(DataSourceReader):
    def __init__(self, kind: str, schema: StructType, options: dict):
        self.kind, self.schema, self.options = kind, schema, options
        self.region = Region.parse(options["region"]) if options.get("region") else None
        self.pushed, self.told = Pushed(), None
        self.files = listed(options, kind)
        self.groups = positive(options, "numPartitions", 200)
        self.line_split = positive(options, LINE_SPLIT.get(kind, "lineSplitSize"), SPLIT)
        self.block_split = positive(options, "bgzfSplitSize", SPLIT)
        self.index_split = positive(options, "indexedSplitSize", SPLIT)
        self.least_split = positive(options, "minSplitBytes", SPLIT // 2)
        self.merge_gap = int(options.get("maxMergeGap", 128))
        self.reference = options.get("referenceFile") if cram.mode(options.get("referenceMode", "file")) == "file" else None
        names = [n for n in schema.names if n != "_metadata"]
        whole = schema_of(kind, options, pruned=False).names
        self.want = {whole.index(n) for n in names if n in whole}
        if self.region:
            self.want |= {"bam": {2, 3, 5}, "cram": {2, 3, 5}, "vcf": {0, 1, 3, 7}}.get(kind, set())

    # what is wanted of an index

    def regions(self) -> list[tuple[str, int, int]] | None:
        if self.region:
            return [(self.region.contig, self.region.start, min(self.region.end, LAST))]
        return self.asked()

    def asked(self) -> list[tuple[str, int, int]] | None:
        """Regions named by filters; None: all records."""
        return None

    def partitions(self) -> list[Span]:
        out = []
        for p in self.files:
            out += self.planned(p, index_of(p, self.kind, self.options, len(self.files) == 1))
        return out or [Span("")]

    def planned(self, p: str, found: str | None) -> list[Span]:
        n, low = storage.size(p), p.lower()
        regions = self.regions()
        if self.kind == "fasta":
            if not found:
                return [Span(p)]
            wanted = {r[0] for r in regions} if regions is not None else None
            contigs = [c for c in index.fai(found) if wanted is None or c.name in wanted]
            each = -(-len(contigs) // self.groups) or 1
            return [Span(p, contigs=tuple(contigs[i : i + each]), index=found, how="contigs") for i in range(0, len(contigs), each)]
        if self.kind == "cram":
            return self.planned_cram(p, n, found, regions)
        if found:
            try:
                contigs = index.read(found, [c for c, _ in self.bam_header(p)] if self.kind == "bam" else self.bcf_names(p) if low.endswith(".bcf") else None)
            except (ValueError, OSError, EOFError):
                if regions is not None or self.kind == "bam":
                    raise
                contigs = None  # an unreadable index: the whole file
            if contigs is not None:
                groups, end = index.planned(contigs, regions, self.groups, self.index_split)
                out = [Span(p, ranges=tuple(g), index=found, how="ranges") for g in groups]
                if self.kind == "bam" and regions is None:
                    # reads without a place stand behind all others
                    out.append(Span(p, ranges=((end or self.bam_begin(p), None),), index=found, how="ranges"))
                return out
        if low.endswith(".bcf") and not self.packed(p):
            return [Span(p, how="records")]
        if low.endswith((".bam", ".bcf")):
            each = positive(self.options, "bgzfSplitSize", BCF_SPLIT) if low.endswith(".bcf") else self.block_split
            return [Span(p, s, s + each, how="records") for s in range(0, n, each)]
        if self.kind == "fastq":
            if not low.endswith(PACKED):
                return self.shares(p, n, min(self.groups, max(1, n // self.least_split)))
            if self.packed(p):
                return self.shares(p, n, min(self.groups, -(-n // self.block_split)))
            return [Span(p)]
        if low.endswith(PACKED):
            return self.shares(p, n, -(-n // self.block_split)) if self.packed(p) else [Span(p)]
        return self.shares(p, n, -(-n // self.line_split), self.line_split)

    @staticmethod
    def shares(p: str, n: int, parts: int, each: int | None = None) -> list[Span]:
        each = each or -(-n // max(parts, 1)) or 1
        starts = list(range(0, n, each))
        return [Span(p, s, s + each if s != starts[-1] else None) for s in starts]

    def planned_cram(self, p: str, n: int, found: str | None, regions) -> list[Span]:
        """Containers in up to numPartitions groups of neighbours; by a CRAI only those that a region may need."""
        with storage.opened(p) as f:
            head = cram.header(f)
            if found:
                rows = index.crai(found)
                if regions is not None:
                    numbers = {c: i for i, (c, _) in enumerate(head.contigs)}
                    near = [(numbers[c], a, b) for c, a, b in regions if c in numbers]
                    # slices of several contigs stand under -2 where the index doesn't split them
                    rows = [r for r in rows if r[0] == -2 or any(r[0] == c and r[1] <= b and r[1] + r[2] > a for c, a, b in near)]
                places = sorted({r[3] for r in rows})
            else:
                places = list(cram.containers(f, head.end, n))
        each = -(-len(places) // self.groups) or 1
        return [Span(p, contigs=tuple(places[i : i + each]), index=found, how="containers") for i in range(0, len(places), each)]

    # reading

    @staticmethod
    def packed(path: str) -> bool:
        with storage.opened(path) as f:
            return bgzf.is_bgzf(f)

    @staticmethod
    def bam_header(path: str) -> list[tuple[str, int]]:
        with storage.opened(path) as f:
            return decode.bam_header(bgzf.Blocks(f, 0).read)

    @staticmethod
    def bam_begin(path: str) -> int:
        with storage.opened(path) as f:
            blocks = bgzf.Blocks(f, 0)
            decode.bam_header(blocks.read)
            return blocks.tell()

    @staticmethod
    def bcf_names(path: str) -> list[str]:
        with storage.opened(path) as f:
            contigs = bcf.header(bgzf.Blocks(f, 0).read).contigs
        return [contigs.get(i, "") for i in range(max(contigs, default=-1) + 1)]

    def lines(self, f, span: Span):
        """((place, line) ..., whether a place is the split's)."""
        if not span.path.lower().endswith(PACKED):
            return bgzf.plain_lines(f, span.start, span.end)
        if bgzf.is_bgzf(f):
            return bgzf.packed_lines(f, span.start, span.end)
        f.seek(0)
        return ((i, x.rstrip(b"\r\n")) for i, x in enumerate(gzip.GzipFile(fileobj=f))), lambda _: True

    def samples(self, path: str) -> list[str]:
        """Names of the samples of a VCF file."""
        if self.kind != "vcf" or 9 not in self.want:
            return []
        with storage.opened(path) as f:
            for _, x in self.lines(f, Span(path))[0]:
                if x.lower().startswith(b"#chrom"):
                    return decode.samples_of(x.decode())
                if not x.startswith(b"#"):
                    break
        return []

    def parser(self, path: str):
        """A row, or None, from a line."""
        if self.kind == "bed":
            return decode.bed
        if self.kind == "vcf":
            names = self.samples(path)
            return lambda x: decode.vcf(x, names, self.want)
        return decode.sam

    def rows(self, span: Span) -> Iterator[tuple]:
        low = span.path.lower()
        with storage.opened(span.path) as f:
            if span.how == "contigs":
                for c in span.contigs:
                    yield c.name, self.sequence(f, c), c.bases
            elif span.how == "containers":
                head = cram.header(f)
                with cram.Reference(self.reference) as reference:
                    for at in span.contigs:
                        yield from cram.records(f, at, head, reference, self.want)
            elif span.how == "ranges":
                yield from self.indexed(f, span)
            elif low.endswith(".bam"):
                yield from self.bam_split(f, span)
            elif low.endswith(".bcf") and span.end is not None:
                yield from self.bcf_split(f, span)
            elif low.endswith(".bcf"):
                yield from bcf.records(f.read, bcf.header(f.read), want=self.want)
            else:
                lines, owns = self.lines(f, span)
                if self.kind == "fastq":
                    text = decode.fastq_split(lines, owns) if span.start or span.end else (x.decode() for _, x in lines)
                    yield from decode.fastq(text, decode.read_number(base_name(span.path)))
                elif self.kind == "fasta":
                    yield from decode.fasta(x.decode() for _, x in lines)
                else:
                    parse = self.parser(span.path)
                    for at, x in lines:
                        if not owns(at):
                            break
                        if row := parse(x.decode()):
                            yield row

    def indexed(self, f, span: Span) -> Iterator[tuple]:
        """Rows of ranges of virtual offsets."""
        head = None
        if self.kind == "bam":
            names = [c for c, _ in decode.bam_header(bgzf.Blocks(f, 0).read)]
        elif span.path.lower().endswith(".bcf"):
            head = bcf.header(bgzf.Blocks(f, 0).read)
        else:
            parse = self.parser(span.path)
        for begin, end in span.ranges:
            blocks = bgzf.Blocks(f, begin)
            more = lambda blocks=blocks, end=end: end is None or blocks.tell() < end
            if self.kind == "bam":
                yield from decode.bam_records(blocks.read, names, more, self.want)
            elif head:
                yield from bcf.records(blocks.read, head, more, self.want)
            else:
                for at, x in blocks.lines():
                    if at >= end:
                        break
                    if row := parse(x.decode()):
                        yield row

    def bam_split(self, f, span: Span) -> Iterator[tuple]:
        """Records that begin in blocks of the split; where it begins in the middle, the first one is guessed and checked."""
        blocks = bgzf.Blocks(f, 0)
        contigs = decode.bam_header(blocks.read)
        names, lengths = [c for c, _ in contigs], [n for _, n in contigs]
        if span.start:
            begin = bgzf.first_block(f, span.start)
            guess = lambda data, whole, inside: decode.bam_guess(data, lengths, whole, inside)
            place = self.first_record(f, begin, span.end, guess) if begin is not None and begin < span.end else None
            if place is None:
                return
            blocks = bgzf.Blocks(f, place)
        yield from decode.bam_records(blocks.read, names, lambda: blocks.tell() >> 16 < span.end, self.want)

    def bcf_split(self, f, span: Span) -> Iterator[tuple]:
        """As bam_split()."""
        blocks = bgzf.Blocks(f, 0)
        head = bcf.header(blocks.read)
        if span.start:
            begin = bgzf.first_block(f, span.start)
            guess = lambda data, whole, inside: bcf.guess(data, head, whole, inside)
            place = self.first_record(f, begin, span.end, guess) if begin is not None and begin < span.end else None
            if place is None:
                return
            blocks = bgzf.Blocks(f, place)
        yield from bcf.records(blocks.read, head, lambda: blocks.tell() >> 16 < span.end, self.want)

    @staticmethod
    def first_record(f, begin: int, end: int, guess) -> int | None:
        """The virtual offset of the first record that begins in a block from begin on, if that is before end."""
        blocks = bgzf.Blocks(f, begin << 16)
        data, marks, wanted, whole = b"", [], 1 << 18, False
        while True:
            while len(data) < wanted and not whole:
                if blocks.data:
                    marks.append((len(data), blocks.here))
                    data += blocks.data
                whole = not blocks.load()
            try:
                inside = next((at for at, here in marks if here >= end), len(data))
                found = guess(data, whole, inside)
            except EOFError:
                found = None
                wanted = len(data) * 2
                continue
            if found is not None:
                at, here = max(m for m in marks if m[0] <= found)
                return here << 16 | found - at
            if whole or inside < len(data):
                return None
            wanted = len(data) * 2

    def sequence(self, f, c: index.Sequence) -> str:
        """A contig's bases: read at once where little stands between lines, else line by line."""
        if c.width - c.per_line <= self.merge_gap or c.bases <= c.per_line:
            f.seek(c.offset)
            got = b"".join(f.read(c.bytes).split())
        else:
            parts, left, at = [], c.bases, c.offset
            while left > 0:
                f.seek(at)
                parts.append(f.read(min(left, c.per_line)))
                left -= c.per_line
                at += c.width
            got = b"".join(parts)
        if len(got) != c.bases:
            raise ValueError(f"contig {c.name} has {len(got)} bases, its index {c.bases}")
        return got.decode()

    def overlaps(self, row: tuple) -> bool:
        r = self.region
        if self.kind in ("bam", "cram"):
            return row[2] == r.contig and row[3] is not None and row[3] <= r.end and row[3] + decode.reference_length(row[5]) - 1 >= r.start
        if self.kind == "vcf":
            return row[0] == r.contig and row[1] <= r.end and decode.vcf_end(row) >= r.start
        if self.kind == "bed":
            return row[0] == r.contig and row[1] + 1 <= r.end and max(row[2], row[1] + 1) >= r.start
        return row[0] == r.contig

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        if not span.path:
            return
        arrow = to_arrow_schema(self.schema)
        extra: tuple = ()
        if "_metadata" in self.schema.names:
            _, size, changed = storage.info(span.path)
            extra = ({"file_path": span.path, "file_name": base_name(span.path), "file_size": size, "file_modification_time": changed, "index_path": span.index},)
        whole = schema_of(self.kind, self.options, pruned=False)
        at = [whole.names.index(n) for n in self.schema.names]
        maps = [f.dataType.typeName() == "map" for f in self.schema]
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [[r[i] for r in held] for i in at]
            columns = [[list(x.items()) if x is not None else None for x in c] if m else c for c, m in zip(columns, maps, strict=True)]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        texts = [i for i in {"fasta": [1], "fastq": [1, 2], "bam": [9, 10], "cram": [9, 10]}.get(self.kind, []) if i in self.want]
        bytes_held = 0
        for row in self.rows(span):
            if self.region and not self.overlaps(row):
                continue
            held.append(row + extra)
            bytes_held += sum(len(row[i] or "") for i in texts)
            if len(held) >= ROWS or bytes_held > BATCH_BYTES:
                yield batch()
                held, bytes_held = [], 0
        if held:
            yield batch()


class PushingReader(Reader):
    """Chooses contigs and ranges by filters where files have an index; Spark still checks every filter.

    Spark keeps one plan of partitions for a loaded DataFrame, the last one made, and all its scans use it, those
    without filters and those planned before too. So a plan must hold what every scan so far has asked for: that is
    written down in the file named by the option `asked`, which api.read() sets, and without the option filters choose
    nothing. api.read() also puts a filter that is always true above the source, without which Spark wouldn't tell
    of a scan that has none.
    """

    def pushFilters(self, filters):
        places = SAM_PLACES if self.options.get("columnNames", "").lower() == "sam" else PLACES[self.kind]
        for f in filters:
            self.pushed.add(f, places)
            yield f
        own = self.pushed.regions(self.kind)
        self.told = self.noted([list(r) for r in own] if own is not None else None)

    def noted(self, own: list | None) -> list | None:
        """The regions that all scans so far asked for; None for everything."""
        path = self.options.get("asked")
        if not path:
            return None
        before: list | None = []
        if os.path.exists(path):
            with open(path) as f:
                before = json.load(f)
        every = None if own is None or before is None else [*before, *(r for r in own if r not in before)]
        with open(f"{path}.{os.getpid()}", "w") as f:
            json.dump(every, f)
        os.replace(f"{path}.{os.getpid()}", path)
        return every

    def asked(self) -> list[tuple[str, int, int]] | None:
        return [tuple(r) for r in self.told] if self.told is not None else None


def schema_of(kind: str, options: dict, pruned: bool = True) -> StructType:
    out: StructType = _parse(getattr(schemas, "BAM" if kind == "cram" else kind.upper()))
    if kind in ("bam", "cram") and options.get("columnNames", "").lower() == "sam":
        for field_, name in zip(out.fields, schemas.SAM_NAMES, strict=True):
            field_.name = name
        out.names = list(schemas.SAM_NAMES)
    if options.get("metadata", "false").lower() == "true":
        out = StructType([*out.fields, METADATA])
    wanted = [c.strip() for c in options.get("columns", "").split(",") if c.strip()]
    return out if not wanted or not pruned else StructType([out[c] for c in wanted])


TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "map<string,string>": T.MapType(T.StringType(), T.StringType()), "array<string>": T.ArrayType(T.StringType())}
METADATA = T.StructField("_metadata", T.StructType([T.StructField("file_path", T.StringType()), T.StructField("file_name", T.StringType()), T.StructField("file_size", T.LongType()), T.StructField("file_modification_time", T.TimestampType()), T.StructField("index_path", T.StringType())]))


def _parse(text: str) -> StructType:
    """A struct from `name type [not null]`, without a session, as planning workers have none."""
    fields = [x.split() for x in text.split(", ")]
    return StructType([T.StructField(x[0], TYPES[x[1]], len(x) == 2) for x in fields])


class Files(DataSource):
    kind = ""
    reads = Reader

    @classmethod
    def name(cls) -> str:
        return cls.kind

    def schema(self) -> StructType:
        return schema_of(self.kind, self.options)

    def reader(self, schema: StructType) -> Reader:
        return self.reads(self.kind, schema, self.options)


SOURCES = [type(f"{k.title()}Source", (Files,), {"kind": k}) for k in SUFFIXES]
PUSHING = [type(f"{k.title()}PushingSource", (Files,), {"kind": k, "reads": PushingReader}) for k in SUFFIXES]
