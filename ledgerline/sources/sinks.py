"""Sinks: fixed columns, sorted where bytes must repeat, manifests beside them."""

from __future__ import annotations

from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import exists


def write(df: DataFrame, path: str, fmt: str = "parquet", columns: list[str] | None = None, force: bool = True, partition_by: list[str] | None = None) -> bool:
    """Write as parquet (zstd), csv (header) or json; False if it was there and force is off."""
    if not force and exists(df.sparkSession, path):
        return False
    out = df.select(*columns) if columns else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.option("compression", "zstd").parquet(path)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)
    return True


def write_stream_sorted(df: DataFrame, path: str, key: str) -> None:
    """JSON lines in order of a key: range-partitioned, so files follow one another and no task holds all."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").json(path)


def manifest(df: DataFrame, name: str) -> DataFrame:
    """One row: row count, schema fingerprint and a content hash that doesn't depend on order."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    schema = ",".join(f"{n}:{t}" for n, t in df.dtypes)
    return df.agg(F.count("*").alias("n_rows"), F.hex(F.bit_xor(row)).alias("xor_hash"), F.sum(row.cast("decimal(20,0)")).cast("string").alias("sum_hash")).select(
        F.lit(name).alias("artifact"), "n_rows", F.sha2(F.lit(schema), 256).alias("schema_hash"), F.sha2(F.concat_ws("|", "n_rows", "xor_hash", "sum_hash"), 256).alias("content_hash")
    )


def graph_tables(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node and edge tables with bulk-load headers."""
    n = nodes.select(F.col("node").alias("id:ID"), F.col("name").alias("name"), F.col("kind").alias(":LABEL"))
    e = edges.select(F.col("src").alias(":START_ID"), F.col("dst").alias(":END_ID"), F.col("verb").alias(":TYPE"), F.col("weight").alias("weight:double"))
    return n, e


def graphml(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The lines of a GraphML document in order (column ``part`` then ``line``)."""
    q = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(c).cast("string"), "&", "&amp;"), "<", "&lt;"), '"', "&quot;")
    spark = nodes.sparkSession
    head = '<?xml version="1.0" encoding="UTF-8"?><graphml><key id="w" for="edge" attr.name="weight" attr.type="double"/><graph edgedefault="directed">'
    ends = spark.createDataFrame([(0, head), (3, escape("") + "</graph></graphml>")], "part int, line string")
    n = nodes.select(F.lit(1).alias("part"), F.concat(F.lit('<node id="'), q("node"), F.lit('"/>')).alias("line"))
    e = edges.select(
        F.lit(2).alias("part"),
        F.concat(F.lit('<edge source="'), q("src"), F.lit('" target="'), q("dst"), F.lit('"><data key="w">'), F.col("weight").cast("string"), F.lit("</data></edge>")).alias("line"),
    )
    return ends.unionByName(n).unionByName(e).orderBy("part", "line")


def markdown(title: str, sections: dict[str, DataFrame], most: int = 10) -> str:
    """A report: each section is a table of its first rows."""
    out = [f"# {title}", ""]
    for name, df in sections.items():
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in df.limit(most).collect()] + [""]
    return "\n".join(out)
