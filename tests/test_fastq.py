"""Byte ranges of FASTQ files: every record once, wherever the cuts fall."""

import gzip
import random

import pytest

from helixframe.sources import fastq


def plain(rows):
    return "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in rows)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(f"r{i}", "".join(rng.choices("ACGT", k=n)), "".join(rng.choices("@+I#", k=n))) for i, n in enumerate(rng.choices([0, 1, 3, 40], k=60))]
    return out + [("all", "ACGT", "@@@@"), ("plus", "ACGT", "++++"), ("both", "AC", "@+")]


def got(frame, *by):
    return [(r["name"], r["seq"], r["qual"]) for r in frame.orderBy(*by).collect()]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_records_across_cuts(spark, tmp_path, rows, size):
    sub = rows if size > 1 else rows[-6:]
    (tmp_path / "a.fastq").write_text(plain(sub))
    frame = fastq.read_fastq(spark, str(tmp_path / "a.fastq"), 2, size).cache()
    assert got(frame, "ordinal") == sub and [r["ordinal"] for r in frame.orderBy("ordinal").collect()] == list(range(len(sub)))
    assert {r["mate"] for r in frame.collect()} == {2}


def test_every_cut_of_a_file_in_plain_readers(tmp_path, rows):
    path = tmp_path / "a.fastq"
    path.write_text(plain(rows))
    for size in range(1, 130):
        reader = fastq.FastqReader({"path": str(path), "rangebytes": str(size)})
        found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        assert [(r["name"], r["seq"], r["qual"]) for r in found] == rows


def test_folders_packed_files_and_line_ends(spark, tmp_path, rows):
    (tmp_path / "a.fastq").write_bytes(plain(rows).replace("\n", "\r\n").encode())
    (tmp_path / "b.fastq.gz").write_bytes(gzip.compress(plain(rows).encode()))
    (tmp_path / "c.fastq").write_text(plain(rows).removesuffix("\n"))
    (tmp_path / "d.fastq").write_text("@last\n\n+\n")
    (tmp_path / "empty.fastq").write_text("")
    (tmp_path / "_SUCCESS").write_text("")
    for path in (str(tmp_path), tmp_path.as_uri()):
        spark.dataSource.register(fastq.FastqSource)
        assert got(spark.read.format("fastq").option("rangeBytes", "50").load(path), "file", "start") == rows * 3 + [("last", "", "")]
    numbers = sorted(r["ordinal"] for r in fastq.read_fastq(spark, str(tmp_path), 1, 50).collect())
    assert numbers == sorted([*range(len(rows))] * 3 + [0])
    only = tmp_path / "none"
    only.mkdir()
    assert got(fastq.read_fastq(spark, str(only), 1), "ordinal") == []


@pytest.mark.parametrize("text", ["ACGT\n", "@a\nAC\n+\n", "@a\nAC\n+\nII\nAC\n@b\nAC\n+\n", "@a\nAC\nII\n@b\n"])
def test_broken_text_is_an_error(tmp_path, text):
    (tmp_path / "a.fastq").write_text(text)
    reader = fastq.FastqReader({"path": str(tmp_path / "a.fastq")})
    with pytest.raises(ValueError):
        [list(reader.read(p)) for p in reader.partitions()]


def test_missing_path_is_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        fastq.FastqReader({"path": str(tmp_path / "no")}).partitions()
