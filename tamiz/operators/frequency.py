"""Frequency tables: (variable, value) is counted map-side before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import percentage, plain, trimmed


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery; reads no column of a Parquet scan."""
    return df.agg(F.count("*").alias("n")).scalar()


def value_counts(df: DataFrame, columns: list[str], trim: bool = False) -> DataFrame:
    """Counts of every value of every listed column, in one pass over the rows."""
    shape = trimmed if trim else plain
    long = df.select(*[shape(F.col(c)).alias(c) for c in columns]).unpivot(
        [], columns, "variable", "valor"
    )
    return long.groupBy("variable", "valor").agg(F.count("*").alias("cantidad"))


def value_frequency(df: DataFrame, columns: list[str], trim: bool = False) -> DataFrame:
    """`value_counts` with the share of all rows."""
    return value_counts(df, columns, trim).withColumn(
        "porcentaje", percentage(F.col("cantidad"), row_count(df))
    )


def class_counts(
    df: DataFrame, label: Column, name: str, total: Column | None = None
) -> DataFrame:
    """How many rows carry each class label, and their share."""
    counted = df.groupBy(label.alias(name)).agg(F.count("*").alias("cantidad"))
    total = row_count(df) if total is None else total
    return counted.withColumn("porcentaje", percentage(F.col("cantidad"), total))


def conditional_frequency(
    df: DataFrame, condition: Column, value: str, order: bool = True
) -> DataFrame:
    """Distribution of one column over the rows that meet a condition."""
    counted = (
        df.where(condition)
        .groupBy(trimmed(F.col(value)).alias(value))
        .agg(F.count("*").alias("cantidad"))
    )
    return counted.orderBy(F.desc("cantidad"), value) if order else counted


def category_inventory(df: DataFrame, columns: list[str]) -> DataFrame:
    """Categories, blanks and the least frequent value of each column.

    Ties go to the first value in order. "" counts as a category when present.
    """
    counts = value_counts(df, columns, trim=True)
    rarest = F.min(F.struct("cantidad", "valor"))
    return (
        counts.groupBy("variable")
        .agg(
            F.count("*").alias("categorias_distintas"),
            F.coalesce(F.sum(F.when(F.col("valor") == "", F.col("cantidad"))), F.lit(0))
            .cast("long")
            .alias("vacios"),
            rarest["valor"].alias("categoria_minoritaria"),
            rarest["cantidad"].alias("frecuencia_minoritaria"),
            F.sum("cantidad").alias("registros"),
        )
        .withColumn(
            "porcentaje_minoritaria",
            percentage(F.col("frecuencia_minoritaria"), F.col("registros")),
        )
        .drop("registros")
    )


def rare_categories(df: DataFrame, columns: list[str], max_rows: int) -> DataFrame:
    """Non-blank categories with at most `max_rows` rows, for review."""
    return value_frequency(df, columns, trim=True).where(
        (F.col("valor") != "") & (F.col("cantidad") <= max_rows)
    )


def outside_domain(df: DataFrame, domains: dict[str, list[str]]) -> DataFrame:
    """Non-blank values outside the fixed domain of their column."""
    counts = value_counts(df, list(domains), trim=True)
    inside = reduce(
        lambda a, b: a | b,
        [
            (F.col("variable") == c) & F.col("valor").isin(*values)
            for c, values in domains.items()
        ],
    )
    return counts.where((F.col("valor") != "") & ~inside)


def outside_catalog(
    df: DataFrame, value: str, catalog: DataFrame, key: str, special: list[str] = ()
) -> DataFrame:
    """Non-blank values absent from a catalog table, with their row counts.

    Values are counted before the join, so the anti join sees one row per
    value and no side needs a broadcast hint.
    """
    text = trimmed(F.col(value))
    wanted = text != ""
    if special:
        wanted = wanted & ~text.isin(*special)
    counts = (
        df.where(wanted).groupBy(text.alias(value)).agg(F.count("*").alias("cantidad"))
    )
    known = catalog.select(F.col(key).alias(value)).distinct()
    return counts.join(known, value, "left_anti")
