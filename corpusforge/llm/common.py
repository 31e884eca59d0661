"""Column expressions and plumbing that the operators of this subpackage share.

A *word* is a maximal run of characters outside ``\\x20`` and ``\\x09-\\x0D`` everywhere here.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.checkpoint import cut, lean_batches, shared_dir

__all__ = ["BLANKS", "GAP", "Scratch", "WORD", "ascii_lower", "bucket_digits", "cut", "lean_batches", "let", "packed", "release", "shared_dir", "small", "table", "unpacked", "words"]

WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"
#: The six characters that separate words.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of a narrow side that may be broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 200_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(docs: DataFrame) -> DataFrame:
    """The whole rows as one struct ``__row__``, so that no column of theirs can clash with one of ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row__"))


def unpacked(df: DataFrame, **new: Column) -> DataFrame:
    """The rows that ``packed`` took, some columns replaced."""
    return df.select(*[new.get(c, F.col(f"__row__.`{c}`")).alias(c) for c in df.schema["__row__"].dataType.names])


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


class Scratch:
    """Intermediate tables as Parquet in the shared folder, each dropped as soon as its reader is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
        lean_batches(spark)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, name: str, schema: str) -> DataFrame:
        """A table that was kept before."""
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of frames nobody holds any more."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a materialised narrow frame of at most ``rows`` rows, else the frame itself."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bucket_digits(n_rows: int, per_bucket: int = 20_000) -> int:
    """Leading hex digits of a digest that split ``n_rows`` into buckets of about ``per_bucket`` rows."""
    digits = 0
    while n_rows > per_bucket * 16**digits:
        digits += 1
    return digits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
