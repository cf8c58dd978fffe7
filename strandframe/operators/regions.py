"""Genomic intervals: 1-based, both ends included."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Region:
    contig: str
    start: int = 1
    end: int = 2**31 - 1

    def __post_init__(self):
        if self.start <= 0 or self.end < self.start:
            raise ValueError(f"no such region: {self}")

    @classmethod
    def parse(cls, text: str) -> Region:
        """chr1, chr1:100 or chr1:1,000-2,000."""
        contig, colon, span = text.rpartition(":")
        if not colon or not span.replace(",", "").replace("-", "").isdigit():
            return cls(text)
        first, dash, last = span.replace(",", "").partition("-")
        return cls(contig, int(first), int(last) if dash else 2**31 - 1)

    def __str__(self) -> str:
        return f"{self.contig}:{self.start}-{self.end}"

    @classmethod
    def whole(cls, contig: str) -> Region:
        """All of a contig."""
        return cls(contig)

    def overlaps(self, other: Region) -> bool:
        return self.contig == other.contig and self.start <= other.end and other.start <= self.end

    def to_column(self, contig: str = "referenceName", start: str = "start") -> Column:
        """Whether a record starts in the region."""
        return (F.col(contig) == self.contig) & F.col(start).between(self.start, self.end)


def overlap_join(left: DataFrame, right: DataFrame, keys: tuple[str, str], left_span: tuple[str, str], right_span: tuple[str, str], width: int | None = 1 << 14) -> DataFrame:
    """Pairs whose half-open spans overlap on one contig. Column names must differ.

    With a width, both sides are dealt to bins and meet on (contig, bin), so that a contig is no single key;
    a pair counts in the first bin that both share. Without, contigs are joined whole.
    """
    (a, b), (s, e), (t, u) = keys, left_span, right_span
    meet = (F.col(s) < F.col(u)) & (F.col(t) < F.col(e))
    if width is None:
        return left.join(right, (F.col(a) == F.col(b)) & meet)
    bins = lambda x, y: F.explode(F.sequence(F.floor(F.col(x) / width), F.floor((F.greatest(F.col(y), F.col(x) + 1) - 1) / width)))
    dealt = left.withColumn("__l", bins(s, e)).join(right.withColumn("__r", bins(t, u)), (F.col(a) == F.col(b)) & (F.col("__l") == F.col("__r")) & meet)
    return dealt.filter(F.col("__l") == F.floor(F.greatest(s, t) / width)).drop("__l", "__r")


def outside(left: DataFrame, right: DataFrame, keys: tuple[str, str], point: str, right_span: tuple[str, str], width: int = 1 << 14) -> DataFrame:
    """Rows of left whose point lies in no half-open span of right on its contig; a null point or contig lies in none.

    Spans are dealt to bins and points meet those of their bin only, so that a contig is no single key.
    """
    (a, b), (t, u) = keys, right_span
    bins = F.explode(F.sequence(F.floor(F.col(t) / width), F.floor((F.col(u) - 1) / width)))
    spans = right.filter(F.col(t) < F.col(u)).select(F.col(b).alias("__b"), F.col(t).alias("__t"), F.col(u).alias("__u"), bins.alias("__r"))
    meet = (F.col(a) == F.col("__b")) & (F.floor(F.col(point) / width) == F.col("__r")) & (F.col(point) >= F.col("__t")) & (F.col(point) < F.col("__u"))
    return left.join(spans, meet, "left_anti")


def reference_end(cigar: str = "cigar", start0: str = "start0") -> Column:
    """The 0-based place behind an alignment: its start and the bases of M, D, N, = and X."""
    sizes = F.regexp_extract_all(F.col(cigar), F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    return F.col(start0) + F.greatest(F.aggregate(sizes, F.lit(0).cast("long"), lambda s, x: s + x.cast("long")), F.lit(1))
