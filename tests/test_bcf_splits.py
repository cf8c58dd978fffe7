"""BCF without an index in splits against whole reads, without a session."""

import random

import pytest
from strandframe.functions import bcf
from strandframe.sources import fixtures
from strandframe.sources.files import Reader, schema_of


def read(path, **options) -> tuple[list[str], int]:
    options = {"path": str(path)} | {k: str(v) for k, v in options.items()}
    r = Reader("vcf", schema_of("vcf", options), options)
    return [str(x) for p in r.partitions() for b in r.read(p) for x in b.to_pylist()], len(r.partitions())


def rows(n: int) -> list[tuple]:
    rng = random.Random(2)
    out = []
    for i in range(n):
        row = list(fixtures.bcf_row(i, rng.randrange(9)))
        row[2] = "x" * rng.choice([3, 14, 20, 900]) if i % 9 == 0 else row[2]
        if i % 7 == 0:
            row[8] = []
        out.append(tuple(row))
    return out


@pytest.mark.parametrize("step", [97, 700, 1 << 14])
@pytest.mark.parametrize("n", [0, 1, 3, 900])
def test_bcf_splits_lose_nothing(tmp_path, step, n):
    data = fixtures.bcf(fixtures.VCF_HEAD, rows(n))
    (tmp_path / "x.bcf").write_bytes(fixtures.bgzf(data, step))
    (tmp_path / "plain.bcf").write_bytes(data)
    whole, one = read(tmp_path / "plain.bcf")
    assert len(whole) == n and one == 1
    for size in (50, 333, 5000, 1 << 20):
        got, parts = read(tmp_path / "x.bcf", bgzfSplitSize=size)
        assert got == whole
    assert n < 900 or read(tmp_path / "x.bcf", bgzfSplitSize=5000)[1] > 1


def test_bcf_guess_takes_no_place_inside_a_record():
    made = [fixtures.bcf_record(r) for r in rows(60)]
    head = bcf.Header(fixtures.VCF_HEAD)
    data, begins = b"".join(made), set()
    for i in range(len(made)):
        begins.add(sum(map(len, made[:i])))
    for at in range(len(data)):
        want = next((b - at for b in sorted(begins) if b >= at), None)
        assert bcf.guess(data[at:], head, True, len(data)) == want
