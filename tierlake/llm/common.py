"""Helpers shared by the training-data operators: words, shingles, folds, materialised steps, components."""

from __future__ import annotations

import sys
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.session import checkpoint_dir

BATCH_ROWS = 1_000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Set the shared checkpoint folder, keep Arrow batches of long texts small, and send this
    package's functions to the executors by value, so that they need not have it installed."""
    checkpoint_dir(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, with its lineage cut there."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder: as ``saved``, in less space for wide or repetitive rows."""
    spark = df.sparkSession
    prepare(spark)
    path = f"{checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: str, buckets: int) -> DataFrame:
    """``df`` written once as ``stored``, in ``buckets`` of ``by``: joins by it move only the other side."""
    spark = df.sparkSession
    prepare(spark)
    name = f"bucketed_{uuid.uuid4().hex}"
    table = f"spark_catalog.default.{name}"  # buckets are a table's; its files stay when its name goes
    df.write.format("parquet").bucketBy(buckets, by).option("path", f"{checkpoint_dir(spark)}/{name}").saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` rows, else as it is (a shuffle join).

    ``df`` should be materialised: it is counted here.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; a null id falls in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fresh(names: list[str], want: str) -> str:
    """A column name starting with ``want`` that is not in ``names`` (case ignored)."""
    taken = {n.lower() for n in names}
    while want.lower() in taken:
        want += "_"
    return want


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; both work on bytes for those sets."""
    return text.lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_sets(words: list[list[bytes]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of each word list, as 64-bit hashes.

    Returns (list index, hash) sorted by both, and the set size of each list.
    A list of 1 to k - 1 words has its whole sequence as one shingle.
    """
    n = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(n.sum()))
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    who = np.repeat(np.arange(len(words)), size)
    if not len(who):
        return who, np.zeros(0, np.uint64), size
    at = np.arange(len(who)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(np.cumsum(n) - n, size)
    length = np.minimum(n, k)[who]
    h = np.zeros(len(who), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            inside = j < length
            word = flat[np.where(inside, at + j, 0)]
            h = np.where(inside, mix(h * np.uint64(0x9E3779B97F4A7C15) + word), h)
    order = np.lexsort((h, who))
    who, h = who[order], h[order]
    first = np.ones(len(who), bool)
    first[1:] = (who[1:] != who[:-1]) | (h[1:] != h[:-1])
    who, h = who[first], h[first]
    return who, h, np.bincount(who, minlength=len(words))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: long): one row (node, root) per node that
    has an edge, ``root`` the smallest node of its component.

    Alternating large-star and small-star steps, one shuffle each: the edges of
    a node are neighbours in a sorted partition, which Spark spills, and their
    least end is a window over them. Each round ends in the shared checkpoint
    folder.
    """
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")))
    while True:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        both = both.repartition("u").dropDuplicates(["u", "v"])
        least = F.least("u", F.min("v").over(Window.partitionBy("u")))
        large = both.withColumn("m", least).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.repartition("hi").dropDuplicates(["hi", "lo"])
        small = large.withColumn("m", F.min("lo").over(Window.partitionBy("hi")))
        e = saved(small.select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo")))
        ends = e.select(F.col("hi").alias("n"), F.col("lo").alias("up")).union(e.select("lo", F.lit(None).cast("long")))
        if ends.groupBy("n").agg(F.min("up").alias("least"), F.max("up").alias("most"), F.count_if(F.col("up").isNull()).alias("down")).where(
                "least < most or (least is not null and down > 0)").isEmpty():
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(e.select("lo", "lo")).distinct()
