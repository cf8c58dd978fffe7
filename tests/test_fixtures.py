"""Files made in parts by tasks: no rows in the driver, the same records and places as in one piece."""

import gzip
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from strandframe.functions import cram
from strandframe.plans.registry import ORACLE_SQL, QUERIES
from strandframe.sources import fixtures

TABLES = ["events", "orders", "nation", "part"]
#: Queries that read every kind of file that is made, in families of one table.
FILES = {
    "bed": ["bed_fields", "bed_bgzf_split", "bed_region", "bed_region_option", "metadata_column", "scan_multi_file"],
    "vcf": ["scan_vcf", "vcf_bgzf_split", "vcf_tabix_scan", "vcf_region", "vcf_csi_scan", "scan_bcf"],
    "fasta": ["scan_fasta", "scan_fasta_gz", "fasta_region"],
    "fastq": ["scan_fastq", "scan_fastq_gz", "fastq_bgzf_split", "fastq_pair_join"],
    "bam": ["sam_split", "scan_bam", "bam_indexed_scan", "bam_region", "bam_region_option", "bam_tags", "scan_cram", "cram_region", "cram_tags"],
}


@pytest.fixture
def tables(tmp_path):
    """Tables of 1,000 to 1,500 rows and 25 nations, and what their rows are."""
    for t in TABLES:
        os.symlink(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


def same_as_sql(spark, sf: str, name: str) -> None:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in QUERIES[name](spark, sf).select(*names).collect()), key=key) == sorted(cur.fetchall(), key=key), name


@pytest.mark.parametrize("family", FILES)
def test_made_in_parts(spark, tables, monkeypatch, family):
    monkeypatch.setattr(fixtures, "PART", 7 if family == "fasta" else 90, raising=False)
    sent = []
    kind = type(spark.range(1))
    for name in ("collect", "toLocalIterator"):

        def seen(self, *a, f=getattr(kind, name), **b):
            for r in (got := list(f(self, *a, **b))):
                sent.append(r)
            return got if f.__name__ == "collect" else iter(got)

        monkeypatch.setattr(kind, name, seen)
    plans = [QUERIES[name](spark, tables) for name in FILES[family]]  # makes the files
    # names and sizes of at most 17 parts, twice for CRAM, of at most 7 files of over 1,000 rows or, of nations, 25
    assert len(plans) == len(FILES[family]) and len(sent) < (25 if family == "fasta" else 250)
    monkeypatch.undo()
    for name in FILES[family]:
        same_as_sql(spark, tables, name)


def test_cram_tells_reads_before(spark, tables, monkeypatch):
    monkeypatch.setattr(fixtures, "PART", 200)
    path = fixtures.made(spark, tables, "sorted.cram")
    with open(path, "rb") as f:
        places = list(cram.containers(f, cram.header(f).end, os.path.getsize(path)))
    with gzip.open(path + ".crai", "rt") as f:
        assert sorted({int(x.split("\t")[3]) for x in f}) == places and len(places) > 5
    assert not [x for x in os.listdir(os.path.dirname(path)) if x.startswith(".making")]


@pytest.mark.parametrize("name", ["bam_indexed_scan", "bam_region_option", "index_path_option", "sql_view_pushdown", "vcf_tabix_scan", "bam_bed_overlap"])
def test_places_over_what_bai_and_tbi_tell(spark, tmp_path, name):
    """Ten bases an order: 54 million orders end behind 2**29, which BAI and TBI have no bins for."""
    n = 3000
    keys = [53_685_000 + 3 * i for i in range(n)] + list(range(300))
    pq.write_table(pa.table({"o_orderkey": keys, "o_custkey": [i * 7 for i in range(n + 300)], "o_orderpriority": ["1-URGENT"] * (n + 300)}), tmp_path / "orders.parquet")
    pq.write_table(pa.table({"event_id": keys, "user_id": [i * 7 for i in range(n + 300)], "event_type": ["x"] * (n + 300)}), tmp_path / "events.parquet")
    same_as_sql(spark, str(tmp_path), name)
