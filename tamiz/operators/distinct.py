"""Exact distinct counts of many expressions without widening the rows.

Each expression becomes narrow (label, 128-bit fingerprint) rows that are
de-duplicated map-side first, so no single value or group is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import digest


def fingerprints(
    df: DataFrame, labelled: dict[str, Column], keys: list[Column] | None = None
) -> DataFrame:
    """Distinct (keys..., variable, h1, h2); null expressions drop out."""
    # The expressions become columns first, so that each is worked out once.
    names = {label: f"_e{i}" for i, label in enumerate(labelled)}
    prepared = df.select(
        *(keys or []), *[expr.alias(names[label]) for label, expr in labelled.items()]
    )
    key_names = prepared.columns[: len(keys or [])]
    items = F.array(
        *[
            F.struct(
                F.when(F.col(name).isNotNull(), F.lit(label)).alias("variable"),
                *digest(F.col(name)),
            )
            for label, name in names.items()
        ]
    )
    return (
        prepared.select(*key_names, F.inline(items))
        .where(F.col("variable").isNotNull())
        .distinct()
    )


def distinct_counts(df: DataFrame, labelled: dict[str, Column]) -> DataFrame:
    """(variable, unicos); a label whose expression is always null is absent."""
    return (
        fingerprints(df, labelled)
        .groupBy("variable")
        .agg(F.count("*").alias("unicos"))
    )


def distinct_counts_by(
    df: DataFrame, keys: dict[str, Column], labelled: dict[str, Column]
) -> DataFrame:
    """Per key, one distinct count per label.

    The first shuffle is on (key, fingerprint), so a key that holds a third of
    all rows spreads over all tasks; the second carries partial counts only.
    """
    named = [c.alias(n) for n, c in keys.items()]
    return (
        fingerprints(df, labelled, named)
        .groupBy(*keys)
        .agg(*[F.count_if(F.col("variable") == n).alias(n) for n in labelled])
    )


def distinct_scalar(df: DataFrame, expr: Column) -> Column:
    """Number of distinct non-null values as a scalar subquery."""
    counted = df.select(F.when(expr.isNotNull(), F.struct(*digest(expr))).alias("d"))
    return (
        counted.where("d IS NOT NULL").distinct().agg(F.count("*").alias("n")).scalar()
    )
