"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.session import scratch_dir

#: ASCII white space, 0x09 to 0x0D and 0x20: what separates words.
SPACES = "\t\n\x0b\x0c\r "
#: Bytes of one Arrow batch between a task and its Python worker.
BATCH_BYTES = 4 * 1024 * 1024


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def frozen(df: DataFrame, prefix: str) -> DataFrame:
    """``df`` written once as Parquet below the shared scratch folder and read again.

    Cuts the lineage: what follows sees the same rows however often it reads
    them, also after executors are lost.
    """
    path = scratch_dir(df.sparkSession, prefix)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> None:
    """Sets the session of ``df`` to hand rows to Python in batches of about ``BATCH_BYTES``.

    The usual bound is on rows alone, and so many texts may have any size. The
    setting counts when a query starts, so it stays on.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Hands freed memory of this process back to the system.

    A Python worker lives on after a task; without this, what one task needed
    counts beside all that later stages need.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(function):
    """``function`` of an Arrow table that leaves no freed memory in its worker."""

    def call(table: pa.Table) -> pa.Table:
        result = function(table)
        release_memory()
        return result

    return call


def lean_pair(function):
    """As ``lean``, for a function of two tables."""

    def call(left: pa.Table, right: pa.Table) -> pa.Table:
        result = function(left, right)
        release_memory()
        return result

    return call


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Array of the runs of characters other than ASCII white space; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def windows(items: Column, n: int) -> Column:
    """64-bit hashes of all windows of ``n`` neighbouring items, in order.

    ``items`` should be a column of its own, not an expression. Items are
    fetched one by one: ``slice`` inside a lambda would copy the whole array.
    """
    last = F.size(items) - n
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(items, i + k) for k in range(n)])),
    ).otherwise(F.array().cast("array<bigint>"))


def bucket_count(total_bytes: int, bucket_bytes: int, least: int) -> int:
    """Number of buckets so that each holds about ``bucket_bytes`` of uniformly dealt rows."""
    return max(least, math.ceil(total_bytes / bucket_bytes))


def text_bytes(docs: DataFrame, text: str) -> int:
    """Total UTF-8 bytes of a text column; one scan of that column."""
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves remainder 2 modulo 4.

    A null id counts as an empty text.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def components(edges: DataFrame, prefix: str) -> DataFrame:
    """Connected components of ``edges`` (u, v): one row (u, root), root the smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) on
    tables written between rounds. A star's centre may have very many
    neighbours: minima are merged map-side, and the join that hands them back
    reads two plain shuffles, which adaptive execution can split. Nodes without
    an edge are not in the result.
    """

    def linked(pairs: DataFrame) -> DataFrame:
        return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = frozen(linked(edges), prefix)
    before, after = None, state(now)
    while before != after and after[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = frozen(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), prefix)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = frozen(linked(large), prefix)
        least = frozen(large.groupBy("u").agg(F.min("v").alias("m")), prefix)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = frozen(linked(small.unionByName(least.withColumnRenamed("m", "v"))), prefix)
        before, after = after, state(now)
    stars = now.groupBy("u").agg(F.min("v").alias("root"))
    return stars.unionByName(now.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
