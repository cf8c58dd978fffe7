"""Registration and reader helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandframe.operators.regions import Region
from strandframe.sources.files import PUSHING, SOURCES

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register_all(spark: SparkSession, pushdown: bool = True) -> None:
    """Registers the formats bed, vcf, fasta, fastq, bam and cram; with pushdown, filters choose contigs and ranges by an index.

    Spark hands filters to Python sources only while the setting PUSHDOWN is on, and refuses such sources while it is off,
    so this turns it on; call it with pushdown=False to leave the setting alone.
    """
    if pushdown:
        spark.conf.set(PUSHDOWN, "true")
    for source in PUSHING if pushdown else SOURCES:
        spark.dataSource.register(source)


#: A column of each format that is never null, and the least it can be.
ALWAYS = {"bam": ("flags", -(2**31)), "cram": ("flags", -(2**31)), "vcf": ("chrom", ""), "bed": ("chrom", ""), "fasta": ("name", "")}


def read(spark: SparkSession, kind: str, path, **options) -> DataFrame:
    """Loads files. Filters on the contig and the start choose what is read of files that have an index."""
    register_all(spark)
    reader = spark.read.format(kind)
    if kind not in ALWAYS or options.get("region"):
        return reader.options(**options).load(path)
    # see PushingReader: the file is the driver's alone
    options["asked"] = os.path.join(tempfile.mkdtemp(prefix="strandframe-asked-"), "regions.json")
    column, least = ALWAYS[kind]
    if column == "flags" and options.get("columnNames", "").lower() == "sam":
        column = "flag"
    wanted = [c.strip() for c in options.get("columns", "").split(",") if c.strip()]
    if wanted and column not in wanted:
        options["columns"] = ",".join([*wanted, column])
    out = reader.options(**options).load(path).filter(F.col(column) >= F.lit(least))
    return out.select(*wanted) if wanted else out


def view(spark: SparkSession, name: str, kind: str, path, **options) -> None:
    """A temporary view of files for SQL; as read(), its filters choose what is read."""
    read(spark, kind, path, **options).createOrReplaceTempView(name)


def read_bam(spark, path, **options) -> DataFrame:
    return read(spark, "bam", path, **options)


def read_sam(spark, path, **options) -> DataFrame:
    return read(spark, "bam", path, **options)


def read_cram(spark, path, **options) -> DataFrame:
    return read(spark, "cram", path, **options)


def read_bam_region(spark, path, region: Region, **options) -> DataFrame:
    """Reads that start in the region; those alone that overlap it are read where there is an index."""
    names = ("rname", "pos") if options.get("columnNames", "").lower() == "sam" else ("referenceName", "start")
    return read_bam(spark, path, region=str(region), **options).filter(region.to_column(*names))


def read_vcf(spark, path, **options) -> DataFrame:
    return read(spark, "vcf", path, **options)


def read_bed(spark, path, **options) -> DataFrame:
    return read(spark, "bed", path, **options)


def read_fasta(spark, path, **options) -> DataFrame:
    return read(spark, "fasta", path, **options)


def read_fastq(spark, path, **options) -> DataFrame:
    return read(spark, "fastq", path, **options)
