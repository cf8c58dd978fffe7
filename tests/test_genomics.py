"""Decoders by hand-made lines, and every query against its SQL."""

import duckdb
import pytest

from strandframe.functions import decode
from strandframe.operators.regions import Region, outside
from strandframe.plans.registry import ORACLE_SQL, QUERIES
from strandframe.sources import api

SF = "/root/testdata/sf0.001"
TABLES = ["events", "orders", "nation", "part"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted(cur.fetchall(), key=key)


def test_bed_fields():
    assert decode.bed("chr1\t1.5\t2") is None
    assert decode.bed("chr1\t1") is None
    assert decode.bed("#x") is None
    row = decode.bed("chr1\t1\t9\t.\t0\t.\t1\t2\t16711680\t2\t1,2,\t0,3,")
    assert row == ("chr1", 1, 9, None, 0, None, 1, 2, "255,0,0", 2, "1,2", "0,3")


def test_vcf_nulls():
    row = decode.vcf("1\t5\t.\tA\t.\tx\t.\tDB;;DP=3;DP=4", [])
    assert row == ("1", 5, None, "A", None, None, None, {"DB": "true", "DP": "4"}, None, None)


def test_sam_unplaced_is_null():
    row = decode.sam("r\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*\tXX:B:c,1,2")
    assert row[2:6] == (None, None, 0, None) and row[11] == {"XX": "B:c,1,2"} and row[12] is None


def test_fastq_drops_cut_record_and_takes_at_in_quality():
    rows = list(decode.fastq(["", "@a x", "AC", "+", "@@", "@b", "A", "+"], None))
    assert rows == [("a", "AC", "@@", "x", None)]


def test_region():
    assert Region.parse("chr1:1,000-2,000") == Region("chr1", 1000, 2000)
    assert Region("a", 1, 5).overlaps(Region("a", 5, 9)) and not Region("a", 1, 4).overlaps(Region("a", 5, 9))
    with pytest.raises(ValueError):
        Region("a", 0, 1)


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_line_splits_lose_nothing(spark, tmp_path, size):
    p = tmp_path / "x.bed"
    p.write_bytes(b"chr1\t1\t2\r\nchr1\t3\t4\n\nchr10\t5\t60")
    assert sorted(r.chromStart for r in api.read_bed(spark, str(p), bedSplitSize=size).collect()) == [1, 3, 5]


def test_vcf_end_and_pruned_fields():
    row = decode.vcf("1\t5\t.\tA\t<DEL>\t.\t.\tEND=90\tGT\t0/1", ["S"])
    assert decode.vcf_end(row) == 90 and decode.vcf_end(decode.vcf("1\t5\t.\tACG\tA\t.\t.\t.", [])) == 7
    assert decode.vcf("1\t5\t.\tA\tC\t.\t.\tDP=1\tGT\t0/1", ["S"], {0, 1})[7:] == ({}, "GT", None)


def test_folders_globs_and_lists(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    for n in ("a_R1_.fastq", "a_R2_.fastq", "sub/b.fastq"):
        (tmp_path / "d" / n).write_text(f"@{n[:4]}\nA\n+\nI\n")
    (tmp_path / "d" / "notes.txt").write_text("x")
    (tmp_path / "none").mkdir()
    d = str(tmp_path / "d")
    assert sorted((r.readName, r.readNumber) for r in api.read_fastq(spark, d).collect()) == [("a_R1", 1), ("a_R2", 2)]
    assert api.read_fastq(spark, f"{d}/*_R?_.fastq").count() == 2
    assert api.read_fastq(spark, [f"{d}/sub", f"{d}/a_R1_.fastq", f"{d}/a_R1_.fastq"]).count() == 2
    assert api.read_fastq(spark, str(tmp_path / "none")).count() == 0
    sam = "@SQ\tSN:c\tLN:9\n\nr\t0\tc\t1\t9\t1M\t*\t0\t0\tA\tI\n"
    for n in ("x.sam", "y.sam"):
        (tmp_path / "d" / n).write_text(sam)
    assert api.read_sam(spark, d).count() == api.read_sam(spark, f"{d}/?.sam").count() == 2


def test_pushed_filters_reach_the_reader_and_are_checked(spark, tmp_path):
    p = tmp_path / "x.fa"
    p.write_text(">a\nAC\n>b\nG\n>c\nT\n")
    (tmp_path / "x.fa.fai").write_text("a\t2\t3\t2\t3\nb\t1\t9\t1\t2\nc\t1\t14\t1\t2\n")
    df = api.read_fasta(spark, str(p), numPartitions=3)
    one = df.filter("name = 'b' AND length > 0")
    assert one.rdd.getNumPartitions() == 1 and [r.sequence for r in one.collect()] == ["G"]
    # scans of one DataFrame share their plan in Spark: none may lose rows by another's filter
    assert df.filter("name = 'a'").union(df.filter("name = 'b'")).count() == 2
    assert df.filter("name = 'a'").alias("x").crossJoin(df.alias("y")).count() == 3
    assert df.count() == 3 and df.limit(5).count() == 3 and [r.name for r in one.collect()] == ["b"]
    assert api.read_fasta(spark, str(p), useIndex="false").filter("name = 'b'").count() == 1
    plain = spark.read.format("fasta").load(str(p))
    assert plain.filter("name = 'b'").count() == 1 and plain.count() == 3
    pruned = api.read_fasta(spark, str(p), columns="length")
    assert pruned.columns == ["length"] and pruned.count() == 3


def test_schema_prunes(spark, tmp_path):
    p = tmp_path / "x.bed"
    p.write_text("c\t1\t2\tn\n")
    api.register_all(spark)
    assert [tuple(r) for r in spark.read.format("bed").schema("name string, chrom string").load(str(p)).collect()] == [("n", "c")]


def test_overlap_and_outside_with_nulls(spark):
    reads = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, None, 5), (4, "a", 30_000), (5, "b", 5)], "n long, c string, p long")
    spans = spark.createDataFrame([("a", 0, 6), ("a", 7, 7), ("a", 10, 50_000), (None, 0, 9)], "k string, s long, e long")
    assert sorted(r.n for r in outside(reads, spans, ("c", "k"), "p", ("s", "e")).collect()) == [2, 3, 5]


def test_bad_options_raise(spark, tmp_path):
    p = tmp_path / "x.bed"
    p.write_text("")
    assert api.read_bed(spark, str(p)).count() == 0
    with pytest.raises(Exception):  # noqa: B017
        api.read_bed(spark, str(p), bedSplitSize=0).count()
    with pytest.raises(Exception):  # noqa: B017
        api.read_bed(spark, str(tmp_path / "none.bed")).count()
