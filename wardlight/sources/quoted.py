"""CSV files with quoted line breaks, read by many tasks each.

Whether a line break ends a record depends on all quotes before it, so a file cannot simply be cut. One pass counts
the quotes of every byte range; summed up along the file they tell whether a range begins inside a quoted field. A
second pass then reads each range from the first record that begins in it: a Python data source with one
partition for each range.
"""

from __future__ import annotations

import csv
import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 64 << 20
CHUNK = 1 << 20
ROWS = 4_096
#: A quote in the middle of a field that is not quoted; the counts of quotes would tell nothing then.
STRAY = re.compile(rb'[^,"\r\n]"[^,"\r\n]')

# Tasks get the functions of this module with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lines(file, start: int) -> Iterator[bytes]:
    """The lines from a byte on, with their line feeds; only a line at a time is held."""
    file.seek(start)
    held: list[bytes] = []
    while chunk := file.read(CHUNK):
        *whole, rest = chunk.split(b"\n")
        for line in whole:
            yield b"".join([*held, line, b"\n"])
            held = []
        held.append(rest)
    if last := b"".join(held):
        yield last


def records(file, start: int, end: int, inside: bool) -> Iterator[list[str]]:
    """The records that begin behind `start` and up to `end`; from the first byte on if start is 0.

    inside says whether `start` lies within quotes.
    """
    source, at = lines(file, start), start
    if start:
        for line in source:
            at += len(line)
            inside ^= bool(line.count(b'"') & 1)
            if not inside:
                break
        else:
            return

    def texts() -> Iterator[str]:
        nonlocal at
        for line in source:
            if STRAY.search(line):
                raise ValueError(f"a quote within a field that is not quoted, near byte {at}; read the file with multi_line=True")
            at += len(line)
            yield line.decode("utf-8", "replace")

    csv.field_size_limit((1 << 31) - 1)
    reader = csv.reader(texts())
    while at <= end:
        record = next(reader, None)
        if record is None:
            return
        if record:  # blank lines are no records
            yield record


def _open(path: str):
    files, name = pyarrow.fs.FileSystem.from_uri(path)
    return files.open_input_file(name)


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int
    inside: bool
    header: list[str]


class QuotedCsv(DataSource):
    """Options: ranges, a JSON list of the fields of ByteRange. All columns are text."""

    @classmethod
    def name(cls) -> str:
        return "quoted_csv"

    def reader(self, schema) -> DataSourceReader:
        return QuotedCsvReader(schema.fieldNames(), json.loads(self.options["ranges"]))


class QuotedCsvReader(DataSourceReader):
    def __init__(self, names: list[str], ranges: list[list]):
        self.names, self.ranges = names, ranges

    def partitions(self) -> list[ByteRange]:
        return [ByteRange(*r) for r in self.ranges]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        """Short records are filled up with nulls, what is left over at the end of long ones is dropped."""
        places = [partition.header.index(n) if n in partition.header else None for n in self.names]
        with _open(partition.path) as file:
            found = records(file, partition.start, partition.end, partition.inside)
            if not partition.start:
                next(found, None)  # the header
            done = False
            while not done:
                rows = []
                for record in found:
                    rows.append(record)
                    if len(rows) == ROWS:
                        break
                done = len(rows) < ROWS
                columns = [pa.array([r[p] if p is not None and p < len(r) else None for r in rows], pa.string()) for p in places]
                yield pa.RecordBatch.from_arrays(columns, names=self.names)


def _files(spark: SparkSession, paths: list[str]) -> list[tuple[str, int]]:
    """(uri, size) of all files below the paths, but for hidden ones."""
    found = []
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for top in system.globStatus(target) or []:
            for status in [top] if top.isFile() else system.listStatus(top.getPath()):
                if status.isFile() and status.getLen() and not status.getPath().getName().startswith(("_", ".")):
                    uri = status.getPath().toUri().toString()
                    found.append((f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri, status.getLen()))
    return sorted(found)


def read_quoted_csv(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All columns as text, by the names in the header of each file; columns that a file lacks are null.

    Every file is cut into ranges of range_bytes that are read side by side. Quotes are doubled within quoted
    fields, and stand nowhere else but around fields; a file that breaks this is refused. Lines end with
    a line feed, with or without a carriage return. A few numbers for each range reach the driver.
    """
    sizes = _files(spark, [path] if isinstance(path, str) else list(path))
    if not sizes:
        raise ValueError(f"no CSV file with a header below {path}")
    cut = [(p, s, min(s + range_bytes, n)) for p, n in sizes for s in range(0, n, range_bytes)]
    todo = spark.createDataFrame(cut, "path string, start bigint, end bigint")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, start, end in batch.itertuples(index=False):
                quotes, left = 0, end - start
                with _open(name) as file:
                    header = next(records(file, 0, 0, False), []) if start == 0 else None
                    file.seek(start)
                    while left and (chunk := file.read(min(CHUNK, left))):
                        quotes += chunk.count(b'"')
                        left -= len(chunk)
                out.append((name, start, end, quotes, header))
            yield pd.DataFrame(out, columns=["path", "start", "end", "quotes", "header"])

    tasks = min(len(cut), 4 * spark.sparkContext.defaultParallelism)
    counted = todo.repartition(tasks).mapInPandas(count, "path string, start bigint, end bigint, quotes bigint, header array<string>").collect()
    ranges, names, inside, header = [], {}, False, []
    for r in sorted(counted, key=lambda r: (r["path"], r["start"])):
        if r["start"] == 0:
            if inside:
                raise ValueError(f"quotes do not pair up in {ranges[-1][0]}; read it with multi_line=True")
            header = [h.removeprefix("﻿") for h in r["header"]]
            names.update(dict.fromkeys(header))
        ranges.append([r["path"], r["start"], r["end"], inside, header])
        inside ^= bool(r["quotes"] & 1)
    if inside:
        raise ValueError(f"quotes do not pair up in {ranges[-1][0]}; read it with multi_line=True")
    spark.dataSource.register(QuotedCsv)
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    return spark.read.format("quoted_csv").schema(schema).option("ranges", json.dumps(ranges)).load()
