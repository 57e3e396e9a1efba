"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import held_out


def known_labels(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, label) of all documents to learn from, before any bound; never held-out ones.

    Labels of ids that ``docs`` does not have are passed over first, so they take no place within a bound.
    """
    there = docs.select(F.col(f"`{doc_id}`").alias("doc_id"))
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    return known.join(there, "doc_id", "left_semi")


def log_odds_shift(docs: DataFrame, labels: DataFrame, label: str, bound: int, doc_id: str = "doc_id") -> float:
    """Log-odds of label 1 among all documents to learn from, less those among at most ``bound`` of each label.

    Added to the logit of a model of the sample, it makes scores mean the same
    at every size; 0 below the bound, and where one label does not occur.
    """
    known = known_labels(docs, labels, label, doc_id)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return 0.0
    return math.log(counts[1] / counts[0]) - math.log(min(counts[1], bound) / min(counts[0], bound))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, bound: int, seed: int = 7, doc_id: str = "doc_id", columns=("text",)
) -> DataFrame:
    """(doc_id, columns, label): at most ``bound`` documents of each label, never held-out ones.

    Chosen by a seeded hash of the id. Null ids and labels are passed over;
    contradicting labels of an id are decided by their majority (a tie is 1);
    of rows that share an id the one whose columns have the least digest is
    taken, so the choice does not depend on how the table is partitioned. The
    chosen ids are few by construction, so they are broadcast and no text of another row moves.
    """
    known = known_labels(docs, labels, label, doc_id)
    order = [F.xxhash64(F.lit(seed), "doc_id"), "doc_id"]
    chosen = [known.where(F.col("label") == value).orderBy(*order).limit(bound) for value in (0, 1)]
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("columns"))
    rows = source.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    first = F.min(F.struct(F.sha2(F.to_json("columns"), 256).alias("digest"), "columns", "label"))
    one = rows.groupBy("doc_id").agg(first.alias("row"))
    return one.select("doc_id", *[F.col(f"row.columns.`{c}`").alias(c) for c in columns], F.col("row.label").alias("label"))
