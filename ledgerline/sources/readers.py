"""Sources: every reader gives string columns as they are; casts come later and are tried."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def guarded(spark: SparkSession, paths: list[str], forbidden: tuple[str, ...] = ("fixture", "sample", "demo")) -> str:
    """The first path that exists; a forbidden word in it raises, and so does finding none."""
    for p in paths:
        if any(w in p.lower() for w in forbidden):
            raise ValueError(f"forbidden input: {p}")
        if exists(spark, p):
            return p
    raise FileNotFoundError(f"none of {paths}")


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, encoding: str = "UTF-8", missing_ok: bool = False, sep: str = ",", line_feeds: bool = False) -> DataFrame:
    """CSV with a header, no inference, byte order mark dropped; a file is split among tasks.

    line_feeds: quoted values may hold line feeds; then a file is one task.
    """
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or []]))
    df = spark.read.csv(path, header=True, inferSchema=False, encoding=encoding, multiLine=line_feeds, escape='"', sep=sep)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    return df.select(*columns) if columns else df


def encoding_of(spark: SparkSession, path: str) -> str:
    """UTF-8 if the whole file decodes as such, else Latin-1; decided where the file is read."""
    row = spark.read.format("binaryFile").load(path).agg(F.bool_and(F.is_valid_utf8(F.col("content").cast("string"))).alias("valid")).first()
    return "ISO-8859-1" if row.valid is False else "UTF-8"


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows, and the lines that can't be parsed."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    # lines are parsed here, not by the reader, which refuses to be asked about broken lines alone
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = spark.read.text(path).select("value", F.from_json("value", full, options).alias("r"))
    fine = parsed.filter("r._corrupt_record IS NULL").select("r.*").drop("_corrupt_record")
    return fine, parsed.filter("r._corrupt_record IS NOT NULL").select(F.col("value").alias("line"))


def flatten(df: DataFrame, mark: str = ".") -> DataFrame:
    """Nested structs as columns with dotted names."""
    def fields(kind: T.StructType, path: list[str]):
        for f in kind.fields:
            if isinstance(f.dataType, T.StructType):
                yield from fields(f.dataType, [*path, f.name])
            else:
                yield [*path, f.name]

    return df.select(*[F.col(".".join(f"`{x}`" for x in p)).alias(mark.join(p)) for p in fields(df.schema, [])])


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True)
    return (reader.schema(schema) if schema else reader).load(path)


def read_excel(spark: SparkSession, path: str, header_words: list[str], sheet: str | None = None, preview: int = 30) -> DataFrame:
    """Workbooks as string rows; the header is the first row of the preview that holds all words.

    Runs over binaryFile rows, so the driver opens nothing; needs a workbook reader on the executors.
    """
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("row", T.LongType()), T.StructField("cells", T.MapType(T.StringType(), T.StringType()))])
    wanted = {w.lower() for w in header_words}

    def run(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                for frame in pd.read_excel(io.BytesIO(content), sheet_name=sheet, header=None, dtype=str).values() if sheet is None else [pd.read_excel(io.BytesIO(content), sheet_name=sheet, header=None, dtype=str)]:
                    head = next((i for i in range(min(preview, len(frame))) if wanted <= {str(x).strip().lower() for x in frame.iloc[i]}), None)
                    if head is None:
                        continue
                    names = [str(x).strip() for x in frame.iloc[head]]
                    body = frame.iloc[head + 1 :]
                    yield pd.DataFrame({"path": name, "row": range(head + 1, head + 1 + len(body)), "cells": [{k: None if pd.isna(v) else str(v) for k, v in zip(names, r, strict=True)} for r in body.itertuples(index=False)]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def read_zip_members(spark: SparkSession, path: str, member: str, sep: str = "\t") -> DataFrame:
    """path, member, line number and cells of delimited members of archives, streamed line by line."""
    schema = "path string, member string, line long, cells array<string>"

    def run(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for m in z.namelist():
                        if m.endswith(member):
                            rows = []
                            for i, line in enumerate(io.TextIOWrapper(z.open(m), "utf-8", errors="replace")):
                                rows.append((name, m, i, line.rstrip("\r\n").split(sep)))
                                if len(rows) == 10_000:
                                    yield pd.DataFrame(rows, columns=["path", "member", "line", "cells"])
                                    rows = []
                            yield pd.DataFrame(rows, columns=["path", "member", "line", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """path, length, modified, sha256 and format of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    ending = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    return files.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), ending.alias("format"))


def new_files(files: DataFrame, consumed: DataFrame) -> DataFrame:
    """The files whose content hash hasn't been consumed; of equal ones the first path."""
    fresh = files.join(consumed.select("sha256").distinct(), "sha256", "left_anti")
    return fresh.groupBy("sha256").agg(F.min_by(F.struct("path", "length", "modified", "format"), "path").alias("f")).select("sha256", "f.*")


class Adapters:
    """Source name -> function of a query that gives a DataFrame; unknown names have a manual-only outcome."""

    def __init__(self) -> None:
        self._known: dict[str, Callable[[SparkSession, dict], DataFrame]] = {}

    def register(self, name: str, fetch: Callable[[SparkSession, dict], DataFrame]) -> None:
        self._known[name] = fetch

    def run(self, spark: SparkSession, query: dict, sources: list[str] | None = None) -> tuple[DataFrame | None, list[dict]]:
        """The tagged union of what the sources give, and an outcome for each source; one failing source fails no other."""
        frames, outcomes = [], []
        for name in sources or list(self._known):
            if name not in self._known:
                outcomes.append({"source": name, "status": "manual_only", "error": None})
                continue
            try:
                frames.append(self._known[name](spark, query).withColumn("source_id", F.lit(name)))
                outcomes.append({"source": name, "status": "ok", "error": None})
            except Exception as e:  # reported, by design
                outcomes.append({"source": name, "status": "error", "error": str(e)[:200]})
        union = None
        for f in frames:
            union = f if union is None else union.unionByName(f, allowMissingColumns=True)
        return union, outcomes


def first_column(df: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate that the table has, whatever its case."""
    have = {c.lower(): c for c in df.columns}
    return next((have[c.lower()] for c in candidates if c.lower() in have), None)


def conform(df: DataFrame, mapping: dict[str, list[str]]) -> DataFrame:
    """Canonical columns, each the first candidate column that exists, else empty."""
    found = {name: first_column(df, c) for name, c in mapping.items()}
    return df.select(*[(F.col(f"`{c}`").cast("string") if c else F.lit("")).alias(n) for n, c in found.items()])
