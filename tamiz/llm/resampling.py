"""Importance resampling towards a target distribution, by bit-sliced sums.

Words and runs of words are hashed into buckets. A bucket's gain says how much
likelier it is in the target texts than in the corpus. A document's weight is
the mean gain of its features. The sum behind it is worked out on bits: the
document's bucket counts become planes of one bit per bucket, the gains planes
in two's complement. For count plane i and gain plane j,
``popcount(count_i & gain_j) << (i + j)`` is their part of the sum; the sign
plane counts negatively. All of it is integer arithmetic, so weights are exact.

Gumbel noise from a hash of the id is added to each weight; the highest scores
are a draw without replacement in proportion to exp(weight / 1000).

Defined results: null text is empty; a text without words has no features and
weight 0; a null id hashes as an empty text and ranks before other ids; rows
that tie in score and id rank in the order of the table. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tamiz.llm.common import bounded_batches, frozen, release_memory

BUCKETS = 10_000
#: Encoded features that a worker remembers, in each of two generations.
REMEMBERED = 200_000
#: Texts whose counts are sliced at a time.
AT_ONCE = 64
#: A-Z to lower case; all other ASCII characters but letters and digits part words.
_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes(c if c >= 0x80 or c in _KEEP else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class _Buckets(dict):
    """Bucket of a feature; forgets the older half once it holds ``REMEMBERED``."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets, self.older = buckets, {}

    def __missing__(self, feature: bytes) -> int:
        bucket = self.older.get(feature)
        if bucket is None:
            bucket = zlib.crc32(feature) % self.buckets
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[feature] = bucket
        return bucket


def features(text: bytes | None, longest: int) -> tuple[int, list[bytes]]:
    """Number of words of a text, and all its runs of 1 to ``longest`` words."""
    words = (text or b"").translate(_PLAIN).split()
    runs = list(words)
    for n in range(2, longest + 1):
        runs.extend(b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return len(words), runs


def bucket_counts(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any.

    A task adds its texts up in one array and sends one row per bucket.
    """

    def count(batches):
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                _, runs = features(text.as_py(), longest)
                if runs:
                    total += np.bincount(np.fromiter(map(known.__getitem__, runs), np.int64, len(runs)), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    bounded_batches(docs)
    counted = docs.select(F.col("text").cast("binary")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket, in thousandths of a log ratio of smoothed shares, floored.

    One number per bucket reaches the driver, whatever the input.
    """
    spark = docs.sparkSession
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    here, there = (
        bucket_counts(df, longest, buckets).withColumnRenamed("n", name) for df, name in ((docs, "s"), (target, "t"))
    )
    both = every.join(here, "bucket", "left").join(there, "bucket", "left").fillna(0)
    rows = sorted(both.select("bucket", "s", "t").collect())
    whole_s, whole_t = (float(sum(r[name] for r in rows) + buckets) for name in ("s", "t"))
    return [math.floor(1000 * math.log(((r["t"] + 1.0) * whole_s) / ((r["s"] + 1.0) * whole_t))) for r in rows]


def padded(buckets: int) -> int:
    """Length of a plane: whole 64-bit words."""
    return -(-buckets // 64) * 64


def bit_plane(values: np.ndarray, bit: int) -> np.ndarray:
    """Bit ``bit`` of integers (..., n) as 64-bit words (..., n / 64); negative ones in two's complement."""
    return np.packbits((values & (1 << bit)) != 0, axis=-1).view(np.uint64)


def gain_planes(gain: list[int]) -> list[np.ndarray]:
    """The planes of signed gains, lowest bit first; the last one is the sign."""
    table = np.zeros(padded(len(gain)), np.int64)
    table[: len(gain)] = gain
    return [bit_plane(table, bit) for bit in range(int(np.abs(table).max(initial=0)).bit_length() + 1)]


def sliced_sums(counts: np.ndarray, planes: list[np.ndarray]) -> np.ndarray:
    """Sum of count times gain per row of ``counts``, by AND, popcount and powers of two."""
    total = np.zeros(len(counts), np.int64)
    for i in range(int(counts.max(initial=0)).bit_length()):
        held = bit_plane(counts, i)
        for j, plane in enumerate(planes):
            part = np.bitwise_count(held & plane).sum(axis=1, dtype=np.int64) << (i + j)
            total += -part if j == len(planes) - 1 else part
    return total


def with_weight(
    docs: DataFrame, gain: list[int], longest: int = 1, doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; the weight is the floored mean gain."""
    buckets = len(gain)
    planes = gain_planes(gain)
    schema = StructType(
        [StructField("doc_id", docs.schema[doc_id].dataType)]
        + [StructField(c, LongType()) for c in ("n_words", "n_features", "weight")]
    )

    def weigh(batches):
        known = _Buckets(buckets)
        for batch in batches:
            texts, sizes, weights = batch.column(1), [], []
            for at in range(0, len(texts), AT_ONCE):
                part = texts[at : at + AT_ONCE]
                counts = np.zeros((len(part), padded(buckets)), np.int32)
                many = np.zeros(len(part), np.int64)
                for k, text in enumerate(part):
                    n_words, runs = features(text.as_py(), longest)
                    sizes.append(n_words)
                    many[k] = len(runs)
                    if runs:
                        held = np.fromiter(map(known.__getitem__, runs), np.int64, len(runs))
                        counts[k, :buckets] = np.bincount(held, minlength=buckets)
                mean = sliced_sums(counts, planes) // np.maximum(many, 1)
                weights.append(np.stack([many, mean]))
            both = np.concatenate(weights, axis=1) if weights else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(both[0]), pa.array(both[1])],
                names=["doc_id", "n_words", "n_features", "weight"],
            )
        release_memory()

    bounded_batches(docs)
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        weigh, schema
    )


def noise(doc_id: Column, seed: int = 2024) -> Column:
    """Gumbel noise in thousandths, floored: the same for an id in every run."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (10, 100),
    least_words: int = 20,
    seed: int = 2024,
    longest: int = 1,
    buckets: int = BUCKETS,
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row.

    Of the N rows with ``least_words`` words or more the highest
    ``floor(share * N)`` scores are drawn and ranked from 1; others have no
    rank. The rows, without their texts, are sorted once over all tasks; a
    row's rank is its place in its part of the order plus the rows in the parts
    before, so no task ranks more than its share, however many tie.
    """
    gain = gains(docs, target, longest, buckets)
    weighed = with_weight(docs, gain, longest, doc_id)
    scored = frozen(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resampling-scores")
    fit = scored.where(F.col("n_words") >= least_words).withColumn("row", F.monotonically_increasing_id())
    ordered = fit.orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "row").drop("row")
    placed = frozen(ordered.withColumn("place", F.monotonically_increasing_id()), "resampling-order")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    parts = sorted(placed.groupBy(part.alias("part")).count().collect())
    before, total = {}, 0
    for p, n in parts:  # one row per task of the sort
        before[p], total = total, total + n
    drawn = total * share[0] // share[1]
    offset = placed.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    ranked = placed.withColumn("part", part).join(F.broadcast(offset), "part").withColumn(
        "rank", F.col("before") + within + 1
    )
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < least_words)
    return ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        rest.select(*columns, F.lit(None).cast("long").alias("rank"))
    )
