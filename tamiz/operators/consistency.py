"""Checks across columns: dependencies, pairs, containment, contradictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import plain
from tamiz.operators.distinct import distinct_counts_by


def dependency_violations(
    df: DataFrame, determinant: dict[str, Column], dependent: dict[str, Column]
) -> DataFrame:
    """Determinant values with more than one value of some dependent column.

    Fingerprints of the dependents are made distinct first, with map-side
    merging, so a frequent determinant is spread by its dependents and no wide
    value is shuffled.
    """
    labelled = {f"distintos_{n}": c for n, c in dependent.items()}
    counted = distinct_counts_by(df, determinant, labelled)
    return counted.where(F.greatest(*[F.col(n) for n in labelled], F.lit(0)) > 1)


def distinct_pairs(df: DataFrame, a: Column, b: Column, where: Column | None = None) -> DataFrame:
    """Distinct (a, b) combinations of the rows that meet a condition."""
    pairs = df.select(
        a.alias("a"), b.alias("b"), (F.lit(True) if where is None else where).alias("_w")
    )
    return pairs.where("_w").select("a", "b").distinct()


def homonyms(df: DataFrame, name: Column, group: Column, where: Column | None = None) -> DataFrame:
    """Names that occur in more than one group."""
    return (
        distinct_pairs(df, name, group, where)
        .groupBy(F.col("a").alias("nombre"))
        .agg(F.count("b").alias("grupos"))
        .where("grupos > 1")
    )


def contains_other(haystack: Column, needle: Column) -> Column:
    """The value of one column occurs in the other; a blank needle never does."""
    return (needle != "") & haystack.contains(needle)


def differs(a: Column, b: Column) -> Column:
    """Raw inequality of two columns, null being the same as blank."""
    return plain(a) != plain(b)


def detail(df: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """Chosen columns of the rows that meet a condition; absent ones are skipped."""
    return df.where(condition).select(*[c for c in columns if c in df.columns])
