"""Queries by name, and their SQL over the tables that the files were made from."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from strandframe.operators.regions import Region, outside, overlap_join, reference_end
from strandframe.sources import api
from strandframe.sources.fixtures import SEQUENCE, made

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
BED_SQL = "(SELECT 'chr' || (user_id % 5 + 1) AS chrom, event_id * 10 AS s, event_id * 10 + 50 + event_id % 100 AS e, event_type AS name, event_id FROM events)"
READ_SQL = "(SELECT 'r' || o_orderkey AS n, CASE WHEN o_orderkey % 11 = 0 THEN 4 WHEN o_orderkey % 2 = 1 THEN 99 ELSE 147 END AS flags, 'chr' || (o_custkey % 3 + 1) AS ref, o_orderkey * 10 + 1 AS pos, 31 - o_orderkey % 10 AS span, o_orderkey % 61 AS mapq, o_orderkey AS k, o_orderpriority AS rg FROM orders)"
#: As READ_SQL, of the sorted files: reads without a place, and more tags.
SORTED_SQL = f"(SELECT *, k % 13 = 0 AS lost, {SEQUENCE.format('k')} AS seq FROM {READ_SQL})"
VARIANT_SQL = "(SELECT 'chr' || (o_custkey % 3 + 1) AS chrom, CAST(o_orderkey AS INTEGER) AS pos, o_orderkey AS k FROM orders)"
CONTIG_SQL = f"(SELECT n_name AS name, 20 + n_nationkey % 12 AS bases, substr(CASE WHEN n_nationkey % 3 = 0 THEN lower({SEQUENCE.format('n_nationkey')}) ELSE {SEQUENCE.format('n_nationkey')} END, 1, 20 + n_nationkey % 12) AS s FROM nation)"


def query(sql: str, *names: str):
    """Registers a function (spark, sf_dir) under its name, or (spark, sf_dir, argument) under each name=argument."""

    def keep(f):
        for n in names or (f.__name__,):
            key, has, given = n.partition("=")
            QUERIES[key] = (lambda spark, sf_dir, given=given: f(spark, sf_dir, given)) if has else (lambda spark, sf_dir: f(spark, sf_dir))
            ORACLE_SQL[key] = sql
        return f

    return keep


def load(spark, sf_dir, name, **options):
    kind = name.split(".", 1)[1].split(".")[0]
    return api.read(spark, {"fa": "fasta", "sam": "bam", "bcf": "vcf"}.get(kind, kind), made(spark, sf_dir, name), **options)


# BED


@query(f"SELECT chrom, s AS chromStart, e AS chromEnd, name FROM {BED_SQL}", "scan_bed=events.bed", "scan_bed_gz=events.bed.gz")
def scan_bed(spark, sf_dir, file):
    return load(spark, sf_dir, file).select("chrom", "chromStart", "chromEnd", "name")


@query(f"SELECT chrom, s AS chromStart, e AS chromEnd, name, CAST(event_id % 1000 AS INTEGER) AS score, CASE event_id % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' END AS strand, s AS thickStart, s + 5 AS thickEnd, CASE event_id % 3 WHEN 1 THEN '1,0,0' WHEN 2 THEN '2,0,0' END AS itemRgb, CAST(2 AS INTEGER) AS blockCount, '1,2' AS blockSizes, '0,' || (event_id % 9) AS blockStarts FROM {BED_SQL}")
def bed_fields(spark, sf_dir):
    return load(spark, sf_dir, "events.bed")


@query(f"SELECT chrom, s AS chromStart FROM {BED_SQL}", "bed_split=events.bed", "bed_bgzf_split=events.bed.gz")
def bed_split(spark, sf_dir, file):
    return load(spark, sf_dir, file, bedSplitSize=1 << 17, bgzfSplitSize=1 << 15).select("chrom", "chromStart")


@query(f"SELECT chrom, count(*) AS n FROM {BED_SQL} GROUP BY chrom")
def intervals_per_chrom(spark, sf_dir):
    return load(spark, sf_dir, "events.bed").groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT chrom, s AS chromStart, e AS chromEnd FROM {BED_SQL} WHERE chrom = 'chr2' AND s + 1 <= 5000 AND e >= 1000")
def bed_region_option(spark, sf_dir):
    return load(spark, sf_dir, "peaks.bed.gz", region="chr2:1,000-5,000").select("chrom", "chromStart", "chromEnd")


@query(f"SELECT chrom, s AS chromStart FROM {BED_SQL} WHERE chrom = 'chr2' AND s >= 500 AND e < 90000")
def bed_region(spark, sf_dir):
    return load(spark, sf_dir, "peaks.bed.gz").filter("chrom = 'chr2' AND chromStart >= 500 AND chromEnd < 90000").select("chrom", "chromStart")


# VCF and BCF

VCF_FIELDS = "chrom, pos, CASE WHEN k % 6 = 0 THEN 'AT' ELSE 'A' END AS ref, CASE WHEN k % 5 = 0 THEN 'G,T' ELSE 'C' END AS alt, 'GT:DP' AS format"


@query(f"SELECT {VCF_FIELDS} FROM {VARIANT_SQL}", "scan_vcf=orders.vcf", "scan_vcf_gz=orders.vcf.gz", "scan_bcf=orders.bcf")
def scan_vcf(spark, sf_dir, file):
    return load(spark, sf_dir, file).select("chrom", "pos", "ref", F.concat_ws(",", "alt").alias("alt"), "format")


@query(f"SELECT chrom, pos FROM {VARIANT_SQL}", "vcf_split=orders.vcf", "vcf_bgzf_split=orders.vcf.gz", "vcf_tabix_scan=sorted.vcf.gz", "vcf_csi_scan=sorted.vcf.bgz")
def vcf_split(spark, sf_dir, file):
    return load(spark, sf_dir, file, vcfSplitSize=1 << 18, bgzfSplitSize=1 << 16, numPartitions=2).select("chrom", "pos")


@query(f"SELECT pos, CASE WHEN k % 8 <> 0 THEN CAST(k % 60 AS VARCHAR) END AS dp, CASE WHEN k % 8 <> 0 AND k % 2 = 1 THEN 'true' END AS somatic, CASE WHEN k % 8 <> 0 THEN CASE WHEN k % 5 = 0 THEN '1,2' ELSE '1' END END AS ac, CAST(CASE WHEN k % 8 = 0 THEN 0 WHEN k % 2 = 1 THEN 3 ELSE 2 END AS INTEGER) AS n FROM {VARIANT_SQL}", "vcf_info=orders.vcf", "bcf_info=orders.bcf")
def vcf_info(spark, sf_dir, file):
    return load(spark, sf_dir, file).select("pos", F.element_at("info", "DP").alias("dp"), F.element_at("info", "SOMATIC").alias("somatic"), F.element_at("info", "AC").alias("ac"), F.size("info").alias("n"))


@query(f"SELECT pos, '0/' || (k % 2) || ':' || (k % 30) AS s1, '1|1:' || (k % 20) AS s2 FROM {VARIANT_SQL}", "vcf_genotypes=orders.vcf", "bcf_genotypes=orders.bcf")
def vcf_genotypes(spark, sf_dir, file):
    return load(spark, sf_dir, file).select("pos", F.element_at("genotypes", "S1").alias("s1"), F.element_at("genotypes", "S2").alias("s2"))


@query(f"SELECT pos, CASE WHEN k % 4 <> 0 THEN 'rs' || k END AS id, CASE WHEN k % 7 <> 0 THEN CAST(k % 90 AS DOUBLE) END AS qual, CASE k % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'q10' END AS filter FROM {VARIANT_SQL}", "vcf_nulls=orders.vcf", "bcf_nulls=orders.bcf")
def vcf_nulls(spark, sf_dir, file):
    return load(spark, sf_dir, file).select("pos", "id", "qual", "filter")


@query(f"SELECT chrom, count(*) AS n FROM {VARIANT_SQL} GROUP BY chrom")
def variants_per_chrom(spark, sf_dir):
    return load(spark, sf_dir, "orders.vcf", columns="chrom").groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT pos FROM {VARIANT_SQL} WHERE chrom = 'chr1' AND pos <= 900 AND pos + CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END >= 100")
def vcf_region_option(spark, sf_dir):
    return load(spark, sf_dir, "sorted.vcf.gz", region="chr1:100-900").select("pos")


@query(f"SELECT pos FROM {VARIANT_SQL} WHERE chrom = 'chr1' AND pos BETWEEN 100 AND 900")
def vcf_region(spark, sf_dir):
    return load(spark, sf_dir, "sorted.vcf.gz").filter("chrom = 'chr1' AND pos BETWEEN 100 AND 900").select("pos")


@query(f"SELECT pos FROM {VARIANT_SQL} WHERE k % 8 <> 0 AND k % 60 > 30")
def vcf_info_filter(spark, sf_dir):
    return load(spark, sf_dir, "orders.vcf").filter(F.element_at("info", "DP").cast("int") > 30).select("pos")


@query(f"SELECT pos FROM {VARIANT_SQL} WHERE k % 2 = 1")
def vcf_het_calls(spark, sf_dir):
    return load(spark, sf_dir, "orders.vcf").filter(F.split(F.element_at("genotypes", "S1"), ":")[0].isin("0/1", "1/0")).select("pos")


# FASTA


@query(f"SELECT name, s AS sequence, CAST(bases AS BIGINT) AS length FROM {CONTIG_SQL}", "scan_fasta=nation.fa", "scan_fasta_gz=nation.fa.gz", "fasta_fai=nation.fasta")
def scan_fasta(spark, sf_dir, file):
    return load(spark, sf_dir, file, numPartitions=4)


@query(f"SELECT name, s AS sequence FROM {CONTIG_SQL} WHERE name = 'NATION_7'")
def fasta_region(spark, sf_dir):
    return load(spark, sf_dir, "nation.fasta").filter("name = 'NATION_7'").select("name", "sequence")


@query(f"SELECT name, bases - length(replace(replace(upper(s), 'G', ''), 'C', '')) AS gc FROM {CONTIG_SQL}")
def gc_content(spark, sf_dir):
    return load(spark, sf_dir, "nation.fa").select("name", F.length(F.regexp_replace(F.upper("sequence"), "[^GC]", "")).cast("long").alias("gc"))


@query(f"SELECT name, upper(s) AS bases FROM {CONTIG_SQL}")
def unmask_upper(spark, sf_dir):
    return load(spark, sf_dir, "nation.fa").select("name", F.upper("sequence").alias("bases"))


@query(f"SELECT name, CAST(bases AS BIGINT) AS length FROM {CONTIG_SQL} ORDER BY bases DESC, name LIMIT 10")
def contigs_by_length(spark, sf_dir):
    return load(spark, sf_dir, "nation.fa").orderBy(F.desc("length"), "name").limit(10).select("name", "length")


# FASTQ


def fastq_sql(columns: str, where: str = "") -> str:
    return f"SELECT {columns} FROM (SELECT 'read' || p_partkey AS readName, {SEQUENCE.format('p_partkey')} AS s, {SEQUENCE.format('100 + p_partkey')} AS s2, CASE WHEN p_partkey % 3 <> 0 THEN p_brand || ' 1:N:0' END AS description FROM part) {where}"


@query(fastq_sql("readName, s AS sequence, repeat('@', 32) AS baseQualities, description"), "scan_fastq=fastq", "scan_fastq_gz=fastq.gz", "scan_fastq_bgzf=fastq.bgz")
def scan_fastq(spark, sf_dir, kind):
    return load(spark, sf_dir, f"part_R1_001.{kind}").select("readName", "sequence", "baseQualities", "description")


@query(fastq_sql("readName, s AS sequence"), "fastq_split=fastq", "fastq_bgzf_split=fastq.bgz")
def fastq_split(spark, sf_dir, kind):
    return load(spark, sf_dir, f"part_R1_001.{kind}", minSplitBytes=1 << 14, bgzfSplitSize=1 << 13).select("readName", "sequence")


@query(fastq_sql("readName, CAST(unnest([1, 2]) AS INTEGER) AS readNumber"))
def fastq_read_number(spark, sf_dir):
    files = [made(spark, sf_dir, f"part_R{i}_001.fastq") for i in (1, 2)]
    return api.read_fastq(spark, files).select("readName", "readNumber")


@query(fastq_sql("readName, s AS s1, s2"))
def fastq_pair_join(spark, sf_dir):
    one, two = (load(spark, sf_dir, f"part_R{i}_001.fastq").select("readName", F.col("sequence").alias(f"s{i}")) for i in (1, 2))
    return one.join(two, "readName")


@query(fastq_sql("readName, count(*) AS n", "CROSS JOIN (SELECT unnest([1, 2]) AS i) GROUP BY readName"))
def fastq_paired_dir(spark, sf_dir):
    folder = os.path.dirname([made(spark, sf_dir, f"part_R{i}_001.fastq") for i in (1, 2)][0])
    return api.read_fastq(spark, f"{folder}/part_R?_001.fastq").groupBy("readName").agg(F.count(F.lit(1)).alias("n"))


@query(fastq_sql("readName", "WHERE description LIKE '%1:N:0%'"))
def fastq_illumina_filter(spark, sf_dir):
    return load(spark, sf_dir, "part_R1_001.fastq").filter(F.col("description").like("%1:N:0%")).select("readName")


@query(fastq_sql("CAST(length(s) AS INTEGER) AS length, count(*) AS n", "GROUP BY 1"))
def read_length(spark, sf_dir):
    return load(spark, sf_dir, "part_R1_001.fastq").groupBy(F.length("sequence").alias("length")).agg(F.count(F.lit(1)).alias("n"))


# SAM, BAM, CRAM


@query(f"SELECT n AS readName, CAST(flags AS INTEGER) AS flags, ref AS referenceName, pos AS start, CAST(mapq AS INTEGER) AS mappingQuality, (32 - span) || 'S' || span || 'M' AS cigar, 'i:' || (k % 8) AS nm, 'Z:' || rg AS rg, pos - 1 AS start0 FROM {READ_SQL}", "scan_sam=orders.sam", "scan_bam=orders.bam", "sam_split=orders.sam", "bam_unindexed_split=orders.bam")
def scan_bam(spark, sf_dir, file):
    return load(spark, sf_dir, file, samSplitSize=1 << 18, bgzfSplitSize=1 << 17).select("readName", "flags", "referenceName", "start", "mappingQuality", "cigar", F.element_at("attributes", "NM").alias("nm"), F.element_at("attributes", "RG").alias("rg"), "start0")


PLACED = "SELECT n AS readName, CAST(CASE WHEN lost THEN 4 ELSE flags END AS INTEGER) AS flags, CASE WHEN NOT lost THEN ref END AS referenceName, CASE WHEN NOT lost THEN pos END AS start, CASE WHEN NOT lost THEN (32 - span) || 'S' || span || 'M' END AS cigar, CASE WHEN NOT lost THEN ref END AS mateReferenceName, CASE WHEN NOT lost THEN k * 10 + 200 END AS mateStart, CAST(CASE WHEN lost THEN 0 ELSE 231 END AS INTEGER) AS insertSize, seq AS sequence, repeat('I', 32) AS baseQualities"


@query(f"{PLACED} FROM {SORTED_SQL}", "bam_indexed_scan=", "bam_vfo_split=split", "bam_skew_split=skew")
def bam_indexed_scan(spark, sf_dir, how=""):
    options = {"split": {"indexedSplitSize": 1 << 15}, "skew": {"numPartitions": 2}}.get(how, {})
    return load(spark, sf_dir, "sorted.bam", **options).select("readName", "flags", "referenceName", "start", "cigar", "mateReferenceName", "mateStart", "insertSize", "sequence", "baseQualities")


@query(f"{PLACED} FROM {SORTED_SQL} WHERE NOT (flags = 4 AND NOT lost)", "scan_cram=", "cram_container_split=split")
def scan_cram(spark, sf_dir, how=""):
    options = {"useIndex": "false", "numPartitions": 3} if how else {}
    rows = load(spark, sf_dir, "sorted.cram", **options).filter("referenceName IS NULL OR (flags & 4) = 0")
    return rows.select("readName", "flags", "referenceName", "start", "cigar", "mateReferenceName", "mateStart", "insertSize", "sequence", "baseQualities")


@query(f"SELECT n AS readName FROM {SORTED_SQL} WHERE ref = 'chr2' AND pos BETWEEN 1000 AND 20000 AND NOT lost", "cram_region=filter")
def cram_region(spark, sf_dir, _):
    return load(spark, sf_dir, "sorted.cram", columns="readName,referenceName,start").filter("referenceName = 'chr2' AND start BETWEEN 1000 AND 20000").select("readName")


@query(f"SELECT n AS readName, 'i:' || (k % 8) AS nm, 'Z:' || rg AS rg, 'A:P' AS xa, CASE WHEN k % 8 = 0 THEN 'f:0' ELSE 'f:' || CAST((k % 8) / 8.0 AS DOUBLE) END AS xf, 'B:i,1,' || k AS xb FROM {SORTED_SQL}", "bam_tags=sorted.bam", "cram_tags=sorted.cram")
def bam_tags(spark, sf_dir, file):
    tag = lambda k: F.element_at("attributes", k).alias(k.lower())
    return load(spark, sf_dir, file, columns="readName,attributes").select("readName", *map(tag, ["NM", "RG", "XA", "XF", "XB"]))


@query(f"SELECT ref AS rname, count(*) AS n FROM {READ_SQL} GROUP BY ref")
def reads_per_reference(spark, sf_dir):
    return load(spark, sf_dir, "orders.bam", columnNames="sam", columns="rname").groupBy("rname").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT n AS readName, CAST(mapq AS INTEGER) AS mappingQuality FROM {READ_SQL}")
def column_pruning(spark, sf_dir):
    api.register_all(spark)
    return spark.read.format("bam").schema("readName string, mappingQuality int").load(made(spark, sf_dir, "orders.bam"))


@query(f"SELECT n AS readName FROM {READ_SQL} WHERE (flags & 4) = 0")
def flag_filter(spark, sf_dir):
    return load(spark, sf_dir, "orders.bam", columns="readName,flags").filter(F.col("flags").bitwiseAND(4) == 0).select("readName")


@query(f"SELECT n AS readName FROM {READ_SQL} WHERE (flags & 64) <> 0")
def first_of_pair(spark, sf_dir):
    return load(spark, sf_dir, "orders.bam", columns="readName,flags").filter(F.col("flags").bitwiseAND(64) != 0).select("readName")


@query(f"SELECT ref AS referenceName, count(*) AS n, avg(mapq) AS mean FROM {READ_SQL} WHERE (flags & 4) = 0 AND mapq >= 30 GROUP BY ref")
def hq_reads_chain(spark, sf_dir):
    reads = load(spark, sf_dir, "orders.bam", columns="referenceName,flags,mappingQuality")
    good = reads.filter(F.col("flags").bitwiseAND(4) == 0).filter("mappingQuality >= 30")
    return good.groupBy("referenceName").agg(F.count(F.lit(1)).alias("n"), F.avg("mappingQuality").alias("mean"))


@query(f"SELECT n AS readName FROM {SORTED_SQL} WHERE ref = 'chr2' AND pos <= 20000 AND pos + span - 1 >= 1000 AND NOT lost", "bam_region_option=", "index_path_option=indexPath", "index_dir_option=indexDir", "region_unindexed=useIndex")
def bam_region_option(spark, sf_dir, option=""):
    path = made(spark, sf_dir, "sorted.bam")
    value = {"indexPath": path + ".bai", "indexDir": os.path.dirname(path), "useIndex": "false"}.get(option)
    return api.read_bam(spark, path, region="chr2:1000-20000", **({option: value} if option else {})).select("readName")


@query(f"SELECT n AS readName FROM {SORTED_SQL} WHERE ref = 'chr2' AND pos > 1000 AND pos <= 20000 AND NOT lost", "bam_region=", "bam_region_split=split")
def bam_region(spark, sf_dir, how=""):
    options = {"indexedSplitSize": 1 << 12} if how else {}
    return load(spark, sf_dir, "sorted.bam", **options).filter("referenceName = 'chr2' AND start > 1000 AND start <= 20000").select("readName")


@query(f"SELECT n AS readName FROM {SORTED_SQL} WHERE ref = 'chr2' AND pos BETWEEN 1000 AND 20000 AND NOT lost")
def bam_region_helper(spark, sf_dir):
    return api.read_bam_region(spark, made(spark, sf_dir, "sorted.bam"), Region("chr2", 1000, 20000)).select("readName")


@query(f"SELECT n AS readName FROM {READ_SQL} WHERE (ref = 'chr1' AND pos BETWEEN 500 AND 900) OR ref = 'chr3'")
def region_overlap(spark, sf_dir):
    either = Region("chr1", 500, 900).to_column() | Region.whole("chr3").to_column()
    return load(spark, sf_dir, "orders.bam").filter(either).select("readName")


@query(f"SELECT n AS readName FROM {SORTED_SQL} WHERE ref = 'chr3' AND pos > 500 AND NOT lost")
def sql_view_region(spark, sf_dir):
    api.register_all(spark)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW strandframe_reads USING bam OPTIONS (path '{made(spark, sf_dir, 'sorted.bam')}')")
    return spark.sql("SELECT readName FROM strandframe_reads WHERE referenceName = 'chr3' AND start > 500")


@query(f"SELECT readName, count(*) AS n FROM (SELECT n AS readName FROM {SORTED_SQL} WHERE ref = 'chr3' AND pos > 500 AND NOT lost UNION ALL SELECT n FROM {SORTED_SQL} WHERE ref = 'chr1' AND NOT lost) GROUP BY readName")
def sql_view_pushdown(spark, sf_dir):
    """Two scans of one view, each with its own filter."""
    api.view(spark, "strandframe_sorted", "bam", made(spark, sf_dir, "sorted.bam"))
    both = spark.sql("SELECT readName FROM strandframe_sorted WHERE referenceName = 'chr3' AND start > 500 UNION ALL SELECT readName FROM strandframe_sorted WHERE referenceName = 'chr1'")
    return both.groupBy("readName").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT n AS readName, ref AS referenceName, pos AS start FROM {READ_SQL} ORDER BY ref, pos, n LIMIT 200")
def sorted_scan(spark, sf_dir):
    return load(spark, sf_dir, "orders.bam", columns="readName,referenceName,start").orderBy("referenceName", "start", "readName").limit(200)


@query("SELECT least(count(*), 1200) AS n FROM orders")
def limit_scan(spark, sf_dir):
    return load(spark, sf_dir, "sorted.bam", columns="readName", numPartitions=20).limit(1200).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT n AS readName, s AS chromStart, name FROM {READ_SQL} r JOIN {BED_SQL} b ON r.ref = b.chrom AND r.pos - 1 < b.e AND b.s < r.pos - 1 + r.span", "bam_bed_overlap=plain", "bam_bed_overlap_binned=binned")
def bam_bed_overlap(spark, sf_dir, how):
    reads = load(spark, sf_dir, "orders.bam", columns="readName,referenceName,start0,cigar").withColumn("end0", reference_end())
    # bins narrow by default: a contig that holds a third of the reads is many keys
    return overlap_join(reads, load(spark, sf_dir, "events.bed"), ("referenceName", "chrom"), ("start0", "end0"), ("chromStart", "chromEnd"), 1 << 12 if how == "binned" else 1 << 14).select("readName", "chromStart", "name")


@query(f"SELECT n AS readName FROM {READ_SQL} r WHERE NOT EXISTS (SELECT 1 FROM {BED_SQL} b WHERE r.ref = b.chrom AND r.pos - 1 >= b.s AND r.pos - 1 < b.e)")
def reads_outside_peaks(spark, sf_dir):
    reads = load(spark, sf_dir, "orders.bam", columns="readName,referenceName,start0")
    return outside(reads, load(spark, sf_dir, "events.bed"), ("referenceName", "chrom"), "start0", ("chromStart", "chromEnd"), 1 << 12).select("readName")


@query(f"SELECT count(DISTINCT n) AS n FROM {READ_SQL}")
def distinct_read_names(spark, sf_dir):
    return load(spark, sf_dir, "orders.sam").select("readName").distinct().agg(F.count(F.lit(1)).alias("n"))


# several files, and what is told of them


@query("SELECT 'peaks.bed.gz' AS file_name, 'peaks.bed.gz.tbi' AS index_name, count(*) AS n FROM events")
def metadata_column(spark, sf_dir):
    rows = load(spark, sf_dir, "peaks.bed.gz", metadata="true").filter("_metadata.file_size > 0 AND _metadata.file_modification_time > '2020-01-01'")
    return rows.groupBy("_metadata.file_name", F.substring_index("_metadata.index_path", "/", -1).alias("index_name")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 2 * count(*) AS n FROM events")
def scan_multi_file(spark, sf_dir):
    files = [made(spark, sf_dir, "events.bed"), made(spark, sf_dir, "events.bed.gz")]
    return api.read_bed(spark, [*files, files[0]]).agg(F.count(F.lit(1)).alias("n"))
