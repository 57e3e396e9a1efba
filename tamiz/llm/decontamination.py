"""Benchmark items found inside documents: size-partitioned MinHash containment search.

An item counts as contained if at least ``CONTAINED`` of its distinct shingles
occur in the document. Shingles that no item has cannot change that, so a
document is represented by those it shares with the benchmark. These sets and
the items are partitioned by size; from the sizes of two partitions follows
the least Jaccard similarity that such containment can have (Zhu et al., LSH
Ensemble, 2016), and from that the number of rows per band at which MinHash
misses a pair with probability below ``MISS``. Where the document's set is so
much larger that no banding reaches this, the item's rarest shingles make
candidates: an item of n shingles that is contained has at most
``n - ceil(CONTAINED * n)`` of them missing, so one of any one more is in the document.
A phrase that many items and documents share is thus no candidate's reason.
All candidates are verified by counting shared shingles.

DataFrame functions only. Shingles are compared by 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.common import free_name, frozen, windows

SHINGLE = 5
CONTAINED = 0.8
PERMUTATIONS = 64
MISS = 1e-8
#: Size classes are powers of two: a set of n shingles is in class floor(log2 n).
CLASSES = 40
#: Rows that may be broadcast: two longs each.
BROADCAST_ROWS = 500_000


def word_list(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.array_remove(F.split(plain, " "), "")


def with_shingles(texts: DataFrame, text: str) -> DataFrame:
    """``texts`` with one row per shingle hash ``h`` (repeats included); shorter texts have none."""
    listed = texts.withColumn("listed", word_list(F.col(text))).drop(text)
    return listed.withColumn("h", F.explode(windows(F.col("listed"), SHINGLE))).drop("listed")


def rows_per_band(ratio: int, contained: float) -> int:
    """Rows for a document class ``ratio`` above the item's: 0 if nothing can match, -1 if no banding suffices."""
    most = 2.0 ** (ratio + 1)  # of the document's size over the item's
    if most < contained:
        return 0
    least = contained / (most + 1 - contained)
    for rows in (4, 2, 1):
        if (1 - least**rows) ** (PERMUTATIONS // rows) <= MISS:
            return rows
    return -1


def _bounded(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it is counted and small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _signature() -> list[Column]:
    return [F.min(F.xxhash64(F.lit(i), "h")).alias(f"m{i}") for i in range(PERMUTATIONS)]


def _bands(rows: int, size_class: Column) -> Column:
    """Band hashes, told apart by rows, band and the document's size class."""
    return F.array(
        *[
            F.xxhash64(F.lit(rows), F.lit(b), size_class, *[f"m{b * rows + r}" for r in range(rows)])
            for b in range(PERMUTATIONS // rows)
        ]
    )


def _size_class(n: Column) -> Column:
    return F.floor(F.log2(n)).cast("int")


def contained_items(
    docs: DataFrame, items: DataFrame, contained: float = CONTAINED, text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """(text_digest, item_id, shared, shingles): each distinct text and each item it contains.

    Equal texts are searched once; ``text_digest`` is the MD5 of the text.
    Texts and items of fewer than five words, null and empty ones have no
    shingle and match nothing. Repeated items are one; items of one id but
    different texts are searched apart.
    """
    benchmark = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col("text").alias("item_text"))
    benchmark = benchmark.withColumn("item", F.xxhash64("item_id", "item_text"))
    shingles = frozen(with_shingles(benchmark, "item_text").distinct(), "benchmark-shingles")
    sized = frozen(shingles.groupBy("item", "item_id").agg(F.count("*").alias("shingles"), *_signature()), "benchmark-items")
    vocabulary = _bounded(frozen(shingles.select("h").distinct(), "benchmark-vocabulary"))

    keyed = docs.select(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_digest"), F.col(f"`{text}`").alias("doc_text"))
    shared = with_shingles(keyed, "doc_text").join(vocabulary, "h").select("text_digest", "h").distinct()
    shared = frozen(shared, "benchmark-shared")
    domains = shared.groupBy("text_digest").agg(F.count("*").alias("n"), *_signature())
    domains = frozen(domains.withColumn("class", _size_class(F.col("n"))), "benchmark-domains")
    queries = sized.withColumn("class", _size_class(F.col("shingles")))

    bands = {ratio: rows_per_band(ratio, contained) for ratio in range(-4, CLASSES)}
    banded = {ratio: rows for ratio, rows in bands.items() if rows > 0}
    by_rows = sorted(set(banded.values()))
    of_docs = F.concat(*[_bands(rows, F.col("class")) for rows in by_rows])
    of_items = F.concat(*[_bands(rows, F.col("class") + ratio) for ratio, rows in banded.items()])
    doc_bands = domains.select("text_digest", F.explode(of_docs).alias("band"))
    item_bands = frozen(queries.select("item", F.explode(of_items).alias("band")), "benchmark-bands")
    near = doc_bands.join(_bounded(item_bands), "band").select("text_digest", "item")

    large = min((ratio for ratio, rows in bands.items() if rows < 0), default=CLASSES)
    wide = shared.join(
        domains.where(F.col("class") >= large).select("text_digest", "class").withColumnRenamed("class", "doc_class"),
        "text_digest",
    )
    held = shared.groupBy("h").agg(F.count("*").alias("texts"))
    ranked = shingles.join(queries.select("item", "shingles", F.col("class").alias("item_class")), "item").join(held, "h", "left")
    rarest = Window.partitionBy("item").orderBy(F.coalesce("texts", F.lit(0)), "h")
    spare = F.col("shingles") - F.ceil(F.lit(contained) * F.col("shingles") - 1e-9)
    ranked = ranked.withColumn("key", F.row_number().over(rarest) <= spare + 1)
    item_rows = frozen(ranked.select("item", "item_class", "h", "key"), "benchmark-rows")
    keys = _bounded(item_rows.where("key"))
    item_rows = _bounded(item_rows)
    any_shared = wide.join(keys, "h").where(F.col("doc_class") >= F.col("item_class") + large)
    candidates = near.unionByName(any_shared.select("text_digest", "item")).distinct()

    counted = (
        candidates.join(shared, "text_digest")
        .join(item_rows.select("item", "h"), ["item", "h"], "left_semi")
        .groupBy("text_digest", "item")
        .agg(F.count("*").alias("shared"))
    )
    least = F.ceil(F.lit(contained) * F.col("shingles") - 1e-9)
    return (
        counted.join(_bounded(sized.select("item", "item_id", "shingles")), "item")
        .where(F.col("shared") >= least)
        .select("text_digest", "item_id", "shared", "shingles")
    )


def matches(docs: DataFrame, items: DataFrame, contained: float = CONTAINED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, shingles) for every row of ``docs`` and every item it contains.

    A repeated row gives its matches again; null ids stay null; tables without
    rows give none.
    """
    found = frozen(contained_items(docs, items, contained, text), "benchmark-found")
    keyed = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_digest")
    )
    return keyed.join(_bounded(found), "text_digest").drop("text_digest")


def drop_contaminated(docs: DataFrame, items: DataFrame, contained: float = CONTAINED, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with the same columns.

    The verdict depends on the text alone, so repeated rows share it; rows with
    null or empty texts stay.
    """
    found = contained_items(docs, items, contained, text).select("text_digest").distinct()
    name = free_name(docs, "text_digest")
    found = _bounded(frozen(found.withColumnRenamed("text_digest", name), "benchmark-found"))
    marked = docs.withColumn(name, F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return marked.join(found, name, "left_anti").drop(name)


