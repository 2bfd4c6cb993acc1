"""Delimited members of archives as a Spark data source: streamed, with filters applied while reading.

    spark.dataSource.register(ArchiveMembers)
    spark.read.format("archive_members").schema("ACCESSION_NUMBER string, CUSIP string, _line long").options(
        path="/shared/13f", member="INFOTABLE.tsv", upper="CUSIP").load().filter(F.col("CUSIP").isin("037833100"))

One task reads one archive's member, a block at a time, so neither an archive nor a member must fit into memory (a
compressed member can't be split).  Cells are trimmed, a missing cell is empty, header names count in any case.
``_archive`` and ``_line`` (1 for the first row after the header) may stand in the schema.  Equality and IN
filters on columns of text arrive at the reader (with ``spark.sql.python.filterPushdown.enabled``) and drop rows
before they become rows of Spark.  An archive without the member, with two of its name, or without a column of the schema raises.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

PLACES = {"_archive", "_line"}


@dataclass
class _Member(InputPartition):
    archive: str
    member: str


def _open(path: str):
    """A seekable file of any file system that Arrow knows; a path without a scheme is local."""
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inside)


def _archives(path: str) -> list[str]:
    """The archives below a folder, or the one named, in order."""
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    found = system.get_file_info(inside)
    files = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inside, recursive=True))
    head = path[: len(path) - len(inside)] if "://" in path and path.endswith(inside) else ""
    return sorted(head + f.path for f in files if f.type == fs.FileType.File and f.path.lower().endswith(".zip"))


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, dict(options)
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        texts = {f.name for f in self.schema.fields if isinstance(f.dataType, T.StringType)} - PLACES
        for f in filters:
            if not isinstance(f, (EqualTo, In)) or len(f.attribute) != 1 or f.attribute[0] not in texts:
                yield f
                continue
            asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
            name = f.attribute[0]
            self.wanted[name] = self.wanted[name] & asked if name in self.wanted else asked

    def partitions(self) -> list[InputPartition]:
        base = self.options["member"].lower()
        found = []
        for path in _archives(self.options["path"]):
            with _open(path) as f, zipfile.ZipFile(f) as z:  # reads the directory at its end only
                names = [m for m in z.namelist() if m.rsplit("/", 1)[-1].lower() == base]
            if len(names) != 1:
                raise ValueError(f"{path}: {len(names)} members named {self.options['member']}")
            found.append(_Member(path, names[0]))
        return found

    def read(self, partition: _Member) -> Iterator[tuple]:
        upper = {c.strip().upper() for c in self.options.get("upper", "").split(",")}
        with _open(partition.archive) as f, zipfile.ZipFile(f) as z, z.open(partition.member) as m:
            rows = csv.reader(io.TextIOWrapper(m, "utf-8-sig", newline=""), delimiter=self.options.get("sep", "\t"))
            at = {name.strip().upper(): i for i, name in enumerate(next(rows, []))}
            fields = [x.name for x in self.schema.fields]
            lacking = [x for x in fields if x not in PLACES and x.upper() not in at]
            if lacking:
                raise ValueError(f"{partition.archive}: {partition.member} lacks {lacking}")
            for line, row in enumerate((r for r in rows if r), 1):
                out = []
                for name in fields:
                    if name in PLACES:
                        out.append(partition.archive if name == "_archive" else line)
                        continue
                    i = at[name.upper()]
                    cell = row[i].strip() if i < len(row) else ""
                    cell = cell.upper() if name.upper() in upper else cell
                    if name in self.wanted and cell not in self.wanted[name]:
                        break
                    out.append(cell)
                else:
                    yield tuple(out)


class ArchiveMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options)


def key_faults(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, fault: blank keys and keys of several rows.  Read it from all rows, before any filter."""
    blank = F.greatest(*[(F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))) == "").cast("int") for k in keys], F.lit(0)) == 1
    found = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return found.select(*keys, F.when(blank, "blank_key").when(F.col("_n") > 1, "duplicate_key").alias("fault")).filter("fault IS NOT NULL")


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """df, if its keys are filled and unique; else that raises, naming one key."""
    bad = key_faults(df, keys).head(1)
    if bad:
        raise ValueError(f"{bad[0].fault}: {tuple(bad[0][k] for k in keys)}")
    return df
