"""Readers and writers of the shapes that corpora come in."""

from __future__ import annotations

import io as bytes_io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def jsonl_objects(spark: SparkSession, path: str) -> DataFrame:
    """``value, source`` of each line that holds a JSON object; other lines disappear."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("source"))
    return lines.where(F.expr("startswith(schema_of_variant(try_parse_json(value)), 'OBJECT')"))


def jsonl_strings(spark: SparkSession, path: str) -> DataFrame:
    """``text, source`` of each line that holds a JSON string; other lines disappear."""
    lines = spark.read.text(path).select(F.expr("try_parse_json(value)").alias("v"), F.col("_metadata.file_name").alias("source"))
    return lines.where(F.expr("schema_of_variant(v) = 'STRING'")).select(F.expr("CAST(v AS STRING)").alias("text"), "source")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Elements of files that hold one array each; elements that are JSON text themselves are parsed too."""
    whole = spark.read.text(path, wholetext=True)
    items = whole.select(F.explode(F.from_json("value", "array<string>")).alias("item"))
    return items.select(F.from_json("item", schema).alias("r")).select("r.*")


def csv_without_last(spark: SparkSession, path: str, drop: int = 2) -> DataFrame:
    df = spark.read.csv(path, header=True)
    return df.select(df.columns[: len(df.columns) - drop])


def legacy_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("encoding", "ISO-8859-1").csv(path, sep="\x01", quote="", escape="", schema="value string")


def npy_matrix(spark: SparkSession, path: str) -> DataFrame:
    """``path, embedding`` of one-vector ``.npy`` files."""
    @F.pandas_udf("array<float>")
    def vector(content: pd.Series) -> pd.Series:
        return content.map(lambda b: np.load(bytes_io.BytesIO(b)).astype(np.float32).ravel())

    return spark.read.format("binaryFile").load(path).select("path", vector("content").alias("embedding"))


def json_string(text: Column) -> Column:
    """A JSON string scalar with everything but ASCII escaped."""
    quoted = F.to_json(F.struct(text.alias("t")))
    body = F.substring(quoted, F.lit(6), F.length(quoted) - 6)
    units = F.hex(F.encode(body, "UTF-16BE"))

    def escaped(i: Column) -> Column:
        unit = F.substring(units, (i * 4 + 1).cast("int"), F.lit(4))
        return F.when(unit < "0080", F.decode(F.unhex(F.substring(unit, 3, 2)), "US-ASCII")).otherwise(F.concat(F.lit("\\u"), F.lower(unit)))

    return F.array_join(F.transform(F.sequence(F.lit(0), (F.length(units) / 4 - 1).cast("int")), escaped), "")


def write_strings(df: DataFrame, path: str, text: str = "text") -> None:
    df.where(F.col(text).isNotNull()).select(json_string(F.col(text)).alias("value")).write.mode("overwrite").text(path)


def write_objects(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_blocks(df: DataFrame, path: str, rows: int) -> None:
    """Token blocks as compressed Parquet of at most ``rows`` a file."""
    df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows).parquet(path)


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items that an earlier run has not written."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def arrow_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of Arrow stream files; each file is one task, read batch by batch."""

    def run(batches):
        for b in batches:
            for content in b.column("content"):
                with pa.ipc.open_stream(pa.py_buffer(content.as_buffer())) as reader:
                    yield from reader

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def head_of_files(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """``value, source`` of the first lines of text files, for a look at them; Spark stops reading when it has enough."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("source")).limit(rows)


def read_blocks(spark: SparkSession, *paths: str) -> DataFrame:
    """Token blocks of several folders with the folder's place in the list (``shard``); a missing folder is an error."""
    parts = [spark.read.parquet(p).withColumn("shard", F.lit(k)) for k, p in enumerate(paths)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def by_suffix(paths: list[str]) -> list[str]:
    """Folders in the order of the number behind their last ``-``; others first, by name."""

    def place(p: str) -> tuple[int, str]:
        end = p.rstrip("/").rsplit("-", 1)[-1]
        return (int(end) if end.isdigit() else -1, p)

    return sorted(paths, key=place)


def merge_blocks(spark: SparkSession, paths: list[str], out: str, rows: int) -> None:
    """Folders of blocks as one, in the order of their numeric suffixes; nothing is shuffled."""
    write_blocks(read_blocks(spark, *by_suffix(paths)), out, rows)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_reports(docs: DataFrame, clusters: DataFrame, path: str) -> None:
    """Members of each cluster of several documents as CSV, and all rows of these documents as JSON lines."""
    from corpusforge.operators.near_dup import cluster_rows, report

    pairs = report(clusters).select(F.col("cluster").alias("Cluster"), F.concat(F.lit("["), F.array_join("members", ", "), F.lit("]")).alias("Duplicate Pair"))
    pairs.write.mode("overwrite").csv(f"{path}/duplicates_pair", header=True)
    cluster_rows(docs, clusters).withColumnRenamed("cluster", "__cluster__").write.mode("overwrite").json(f"{path}/duplicates_cluster")


def write_parts(df: DataFrame, path: str, order: list[str], rows: int) -> None:
    """JSON lines in folders ``part=k`` of ``rows`` rows each in the given order."""
    from corpusforge.operators.ordering import with_index

    placed = with_index(df, order, "_i").withColumn("part", F.floor(F.col("_i") / rows)).drop("_i")
    placed.repartitionByRange("part").write.mode("overwrite").partitionBy("part").json(path)


def mark_done(df: DataFrame, path: str, key: str) -> None:
    """Adds the keys of finished items to the manifest that ``not_done`` reads."""
    df.select(F.col(key).cast("string").alias("key")).distinct().write.mode("append").parquet(path)


def not_done(items: DataFrame, path: str, key: str) -> DataFrame:
    """Items that the manifest does not name; all of them while there is none."""
    spark = items.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return items
    done = spark.read.parquet(path).select(F.col("key").alias("_done")).distinct()
    return items.join(done, F.col(key).cast("string") == F.col("_done"), "left_anti")


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes`` of files, without reading them."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
