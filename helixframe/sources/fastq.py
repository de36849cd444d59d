"""FASTQ as a data source that plans byte ranges and finds where records start in them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from helixframe.operators.scratch import kept_table

#: Bytes of a range, unless the option rangeBytes says otherwise; text of a batch; bytes that are read ahead.
RANGE_BYTES, BATCH_CHARS, AHEAD = 64 << 20, 4 << 20, 1 << 20
SCHEMA = "file string, range_start long, place long, start long, name string, seq string, qual string"
#: Ranges up to which what comes before them is sent to all tasks.
BROADCAST_RANGES = 1 << 19
PACKED = (".gz", ".bz2", ".zst")


@dataclass
class ByteRange(InputPartition):
    """Records whose first byte is in [start, end) of a file; end -1: a compressed file, which can't be cut."""

    file: str
    start: int
    end: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _lines(stream, at: int) -> Iterator[tuple[int, bytes]]:
    """(first byte, line without its end) from a stream that stands at byte `at`."""
    rest = b""
    while block := stream.read(AHEAD):
        *whole, rest = (rest + block).split(b"\n")
        for line in whole:
            yield at, line.removesuffix(b"\r")
            at += len(line) + 1
    if rest:
        yield at, rest.removesuffix(b"\r")


def _records(lines: Iterator[tuple[int, bytes]], aligned: bool, path: str) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(first byte, name, seq, qual). Where the lines may begin inside a record, a header is a line with `@` whose next but one
    begins with `+`: two lines after a quality line stands a sequence, which does not."""
    held: list[tuple[int, bytes]] = []
    for item in lines:
        held.append(item)
        if len(held) < 4:
            continue
        if held[0][1][:1] == b"@" and held[2][1][:1] == b"+":
            aligned = True
            yield held[0][0], held[0][1][1:], held[1][1], held[3][1]
            held = []
        elif aligned:
            raise ValueError(f"{path}: no record at byte {held[0][0]}")
        else:
            held.pop(0)
    if aligned and any(line for _, line in held):
        if len(held) == 3 and held[0][1][:1] == b"@" and held[2][1][:1] == b"+" and not held[1][1]:
            yield held[0][0], held[0][1][1:], b"", b""  # the last record, empty and without an end of line
        else:
            raise ValueError(f"{path}: the record at byte {held[0][0]} isn't complete")


class FastqReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("rangebytes", RANGE_BYTES))
        if self.size < 1:
            raise ValueError("rangeBytes is 1 or more")

    def partitions(self) -> list[ByteRange]:
        """The ranges of all files at the path; files whose name begins with `_` or `.` are left out."""
        system, path = _opened(self.path)
        prefix = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        found = []
        for f in sorted(files, key=lambda f: f.path):
            if not f.is_file or f.base_name[:1] in "_." or not f.size:
                continue
            if f.path.endswith(PACKED):
                found.append(ByteRange(prefix + f.path, 0, -1))
            else:
                found += [ByteRange(prefix + f.path, a, min(a + self.size, f.size)) for a in range(0, f.size, self.size)]
        return found or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        system, path = _opened(partition.file)
        a = partition.start
        if partition.end < 0:
            stream = system.open_input_stream(path)  # decompressed by the name's ending
        else:
            stream = system.open_input_file(path)
            stream.seek(max(a - 1, 0))
        with stream:
            lines = _lines(stream, max(a - 1, 0))
            if a:
                next(lines, None)  # the line that ends before the range, or runs into it
            columns: list[list] = [[], [], [], []]
            size = place = 0
            for at, *fields in _records(lines, a == 0, path):
                if 0 <= partition.end <= at:
                    break
                for column, value in zip(columns, (at, *(f.decode("utf-8") for f in fields))):
                    column.append(value)
                size += sum(map(len, fields))
                if size >= BATCH_CHARS:
                    yield self._batch(partition, columns, place)
                    place, size, columns = place + len(columns[0]), 0, [[], [], [], []]
            if columns[0]:
                yield self._batch(partition, columns, place)

    @staticmethod
    def _batch(partition: ByteRange, columns: list[list], place: int) -> pa.RecordBatch:
        n = len(columns[0])
        own = [pa.array([partition.file] * n, pa.string()), pa.array([partition.start] * n, pa.int64()), pa.array(range(place, place + n), pa.int64())]
        return pa.record_batch([*own, pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:])], names=[f.split()[0] for f in SCHEMA.split(", ")])


class FastqSource(DataSource):
    """spark.read.format("fastq").load(path): a row a record of four lines, in ranges of about option rangeBytes.

    A record belongs to the range that holds its first byte. start is that byte (of the decompressed text where the file is packed),
    range_start and place say which range and which record of it. Empty files give no rows; a record that isn't complete, or text
    that is none, is an error. The path is one that all executors can read.
    """

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


def read_fastq(spark: SparkSession, path: str, mate: int, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(ordinal, name, seq, qual, mate): ordinals count the records of a file from 0. No text is shuffled, unless there are over
    BROADCAST_RANGES ranges: what comes before a range is a sum over the ranges."""
    spark.dataSource.register(FastqSource)
    found = spark.read.format("fastq").option("rangeBytes", str(range_bytes)).load(path)
    ranges = kept_table(found.groupBy("file", "range_start").agg(F.count("*").alias("n")), "ranges")
    before = F.sum("n").over(Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1))
    bases = ranges.select("file", "range_start", F.coalesce(before, F.lit(0)).alias("base"))
    if ranges.count() <= BROADCAST_RANGES:
        bases = F.broadcast(bases)
    return found.join(bases, ["file", "range_start"]).select((F.col("base") + F.col("place")).alias("ordinal"), "name", "seq", "qual", F.lit(mate).alias("mate"))
