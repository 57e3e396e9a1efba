"""Random shards by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets that fit in memory, by a
seeded hash of each record's place in the input. Pass two shuffles every
bucket with Fisher-Yates (what Spark's ``shuffle`` of an array does) and
writes it. Read one after another, the buckets are one random order of all
records; shards are equal runs of it, so their counts differ by one at most
and a bucket's file serves one shard or two.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.common import bucket_count, frozen, text_bytes

#: Buckets whose offsets are broadcast (two longs each); more are joined by a shuffle.
BROADCAST_BUCKETS = 100_000


def shuffled_buckets(docs: DataFrame, seed: int, buckets: int) -> DataFrame:
    """(bucket, position, record): the rows of ``docs`` scattered and shuffled; written once.

    The scatter key is the row's number in the input and not a column, so equal
    rows, hot sources and groups of copies spread like any others. A bucket is
    sorted by that number before it is shuffled: the same input files and
    settings give the same order.
    """
    row = F.monotonically_increasing_id()
    placed = docs.select(row.alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(buckets)).cast("int"))
    scattered = placed.repartitionById(buckets, "bucket")  # one bucket a task, and grouping needs no other shuffle
    in_memory = scattered.groupBy("bucket").agg(F.collect_list(F.struct("row", "record")).alias("rows"))
    ordered = F.array_sort("rows", lambda a, b: F.when(a["row"] < b["row"], -1).otherwise(1))
    mixed = in_memory.select("bucket", F.shuffle(ordered, F.lit(seed)).alias("rows"))
    listed = mixed.select("bucket", F.posexplode("rows").alias("position", "item"))
    return frozen(listed.select("bucket", F.col("position").cast("long"), "item.record"), "shuffled-buckets")


def shard(
    docs: DataFrame, shards: int, seed: int = 42, bucket_bytes: int = 32 << 20, text: str = "text"
) -> DataFrame:
    """(shard, slot, record): every row of ``docs`` once, in ``shards`` random shards of equal counts.

    ``slot`` is the record's place in its shard, from 0 without gaps; ``record``
    is the whole row as a struct, whatever its columns are called or hold.
    ``bucket_bytes`` is the memory one bucket may take. With fewer rows than
    shards the last shards are empty; an empty table gives no rows.
    """
    buckets = bucket_count(text_bytes(docs, text), bucket_bytes, least=shards)
    mixed = shuffled_buckets(docs, seed, buckets)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = mixed.groupBy("bucket").agg(F.count("*").alias("n"))  # one row per bucket
    offsets = counts.select(
        "bucket",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    place = F.col("first") + F.col("position")
    small = F.expr(f"total div {shards}")
    longer = F.col("total") % shards  # so many first shards hold one record more
    edge = longer * (small + 1)
    placed = mixed.join(offsets, "bucket").withColumns(
        {"place": place, "small": small, "longer": longer, "edge": edge}
    )
    ahead = F.col("place") < F.col("edge")
    return placed.select(
        F.when(ahead, F.expr("place div (small + 1)")).otherwise(F.expr("longer + (place - edge) div greatest(small, 1)")).cast("int").alias("shard"),
        F.when(ahead, F.expr("place % (small + 1)")).otherwise(F.expr("(place - edge) % greatest(small, 1)")).alias("slot"),
        "record",
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its records in order of slot within each file."""
    flat = sharded.select("shard", "slot", "record").sortWithinPartitions("shard", "slot")
    flat.write.mode("overwrite").partitionBy("shard").parquet(path)
