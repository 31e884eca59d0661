"""MinHash, LSH buckets, clusters, and what is reported of them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.checkpoint import cut, lean_batches
from corpusforge.functions.numeric import band_shape, minhash, permutations
from corpusforge.operators.components import components

_split = re.compile(r"\W")


def _grams(text: str, n: int, min_length: int) -> set[bytes]:
    """Distinct lower-cased grams as UTF-8. Tokens hold no blank, so lower-casing all of them at once changes none."""
    toks = _split.split(text)
    if len(toks) < min_length:
        return set()
    whole = " ".join(toks).lower().encode()
    if len(toks) < n:
        return {whole}
    blanks = np.flatnonzero(np.frombuffer(whole, dtype=np.uint8) == 32)
    starts, ends = [0, *(blanks + 1).tolist()], [*blanks.tolist(), len(whole)]
    return {whole[s:e] for s, e in zip(starts, ends[n - 1 :])}


def _hasher(hash_func: str, bits: int):
    """Hashes of grams; 64-bit signatures take 32 bits of SHA-1, as the permutations' values do."""
    size = min(bits, 32) // 8
    if hash_func == "sha1":
        sha1 = hashlib.sha1

        def digests(grams: set[bytes]) -> np.ndarray:
            first = np.frombuffer(b"".join([sha1(g).digest() for g in grams]), dtype=np.uint8).reshape(-1, 20)[:, :size]
            return np.ascontiguousarray(first).view(f"<u{size}").ravel()

        return digests
    if hash_func != "xxh3":
        raise ValueError(f"unknown hash {hash_func}")
    import xxhash

    return lambda grams: np.array([xxhash.xxh3_64_intdigest(g) & ((1 << 8 * size) - 1) for g in grams], dtype=f"<u{size}")


def signatures(docs: DataFrame, num_perm: int = 256, n: int = 5, min_length: int = 5, hash_func: str = "sha1", bits: int = 64, seed: int = 42) -> DataFrame:
    """``doc_id, sig`` of every document; a null text counts as empty."""
    lean_batches(docs.sparkSession)
    a, b = permutations(num_perm, bits, seed)
    hashed = _hasher(hash_func, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = np.empty((batch.num_rows, num_perm), dtype=np.int64)
            for i, t in enumerate(batch.column("text")):
                sigs[i] = minhash(hashed(_grams(t.as_py() or "", n, min_length)), a, b, bits)
            at = pa.array(np.arange(0, sigs.size + 1, num_perm, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(at, pa.array(sigs.ravel()))], names=["doc_id", "sig"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, sig array<long>")


def bucket_edges(sigs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Edges from each member of a bucket to its least member."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.xxhash64(k, F.slice("sig", k * rows + 1, rows)))
    seats = cut(sigs.select(F.col("doc_id").alias("u"), F.explode(keys).alias("key")))  # read twice; signatures are dear
    least = seats.groupBy("key").agg(F.min("u").alias("v"), F.max("u").alias("top")).where("v <> top").select("key", "v")
    return seats.join(least, "key").where("u <> v").select("u", "v").distinct()


def cluster(docs: DataFrame, threshold: float = 0.7, num_perm: int = 256, n: int = 5, min_length: int = 5, shape: tuple[int, int] | None = None, **hashing) -> DataFrame:
    """``doc_id, cluster``: the least doc_id that a chain of shared buckets connects. ``hashing`` goes to ``signatures``."""
    bands, rows = shape or band_shape(threshold, num_perm)
    labels = components(bucket_edges(signatures(docs, num_perm, n, min_length, **hashing), bands, rows))
    return docs.select("doc_id").join(labels.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left").select("doc_id", F.coalesce("label", "doc_id").alias("cluster"))


def representatives(clusters: DataFrame) -> DataFrame:
    return clusters.where("cluster = doc_id").select("doc_id")


def report(clusters: DataFrame) -> DataFrame:
    """Members of each cluster of several documents."""
    members = clusters.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("cluster"))).where("n > 1")
    return members.groupBy("cluster").agg(F.sort_array(F.collect_list("doc_id")).alias("members"))


def cluster_rows(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """All columns of the documents in clusters of several, with ``cluster``; counts are combined before the shuffle."""
    many = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cluster")
    return docs.join(clusters.join(many, "cluster", "left_semi"), "doc_id")


def rows_of_cluster(docs: DataFrame, clusters: DataFrame, cluster_id: int) -> DataFrame:
    return docs.join(clusters.where(F.col("cluster") == cluster_id), "doc_id")
