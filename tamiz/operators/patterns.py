"""Counts and first examples of non-exclusive text patterns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.text import percentage
from tamiz.operators.profile import unpivot_metrics

EXAMPLE_SEPARATOR = " ¦ "


#: Hash buckets of the values of a label, in each of which a task keeps the first place alone.
PLACES = 64
#: Bits of a record number in the order key; file numbers take the others.
RECORD_BITS = 41


def ordered_by_key(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``_key``, a long that sorts like the columns ``order``; nulls come first.

    A number is its own key. Of (file name, record number) the file is
    numbered: the names are as few as the files that the driver lists for
    the scan, so they are broadcast. Other orders cost a sort of the table.
    """
    types = dict(df.dtypes)
    integral = [types.get(c) in ("tinyint", "smallint", "int", "bigint") for c in order]
    if integral == [True]:
        return df.withColumn("_key", F.coalesce(F.col(order[0]).cast("long"), F.lit(-(1 << 63))))
    if integral == [False, True] and types.get(order[0]) == "string":
        names = df.select(F.col(order[0]).alias("_name")).distinct()
        numbered = names.withColumn("_file", F.row_number().over(Window.orderBy(F.asc_nulls_first("_name"))))
        placed = df.join(F.broadcast(numbered), F.col(order[0]).eqNullSafe(F.col("_name")))
        record = F.coalesce(F.col(order[1]).cast("long"), F.lit(-1).cast("long"))
        return placed.withColumn("_key", F.shiftleft(F.col("_file").cast("long"), RECORD_BITS) + record)
    return df.orderBy(*[F.asc_nulls_first(c) for c in order]).withColumn("_key", F.monotonically_increasing_id())


def first_examples(
    df: DataFrame,
    labels: Column,
    value: Column,
    order: list[str],
    n: int,
    separator: str = EXAMPLE_SEPARATOR,
    name: str = "etiqueta",
    label_count: int | None = None,
) -> DataFrame:
    """First n distinct values per label, in row order, joined to one text.

    `labels` is an array column with the labels of a row; null entries do not
    count. The first pass keeps, for each task, label and hash bucket of the
    values, the place of the first row alone: numbers, and as many whatever the
    data. The n-th least place of a label is as far as its examples can lie.
    The second pass takes the rows up to there; only their values move.

    The places are broadcast if `label_count`, the fixed number of labels, is
    given; otherwise the farthest of them is, as a number.
    """
    base = ordered_by_key(df.withColumns({"_value": value, "_labels": labels}), order)
    # The outer form and a null test after it: for a plain explode the optimizer
    # adds a filter on the array's size, which would run all patterns twice.
    tagged = base.select(F.explode_outer("_labels").alias(name), "_key", "_value").where(F.col(name).isNotNull())
    bucket = F.pmod(F.xxhash64("_value"), F.lit(PLACES)).alias("_bucket")
    places = tagged.groupBy(name, bucket).agg(F.min("_key").alias("_place"))
    until = places.groupBy(name).agg(F.get(F.array_sort(F.collect_list("_place")), F.lit(n - 1)).alias("_until"))
    if label_count is not None:
        until = F.broadcast(until)
    else:  # one number first, so that rows beyond the last place of all labels end where they are read
        endless = F.lit((1 << 63) - 1)
        last = until.agg(F.max(F.coalesce("_until", endless)).alias("_last")).scalar()
        tagged = tagged.where(F.col("_key") <= F.coalesce(last, endless))
    near = tagged.join(until, name).where(F.col("_until").isNull() | (F.col("_key") <= F.col("_until")))
    firsts = near.groupBy(name, "_value").agg(F.min("_key").alias("_first"))
    rank = F.row_number().over(Window.partitionBy(name).orderBy("_first", "_value"))
    ranked = firsts.withColumn("_rank", rank).where(F.col("_rank") <= n)
    ordered = F.array_sort(F.collect_list(F.struct("_rank", "_value")))
    return ranked.groupBy(name).agg(F.array_join(ordered["_value"], separator).alias("ejemplos"))


def pattern_inventory(
    df: DataFrame,
    text: Column,
    patterns: dict[str, Column],
    order: list[str],
    label: str = "patron",
    n: int = 3,
    residual: str | None = None,
    scope: Column | None = None,
    with_percentage: bool = True,
    with_examples: bool = True,
) -> DataFrame:
    """Cells, share and examples per pattern; zero-count patterns stay.

    `patterns` maps labels to predicates on the column ``texto`` (the prepared
    text, computed once per row). `scope` restricts every predicate, and
    `residual` names a last row for in-scope cells that match none.
    """
    base = df.select(*order, text.alias("texto"))
    flags = {k: (p if scope is None else scope & p) for k, p in patterns.items()}
    if residual is not None:
        rest = ~reduce(or_, patterns.values())
        flags[residual] = rest if scope is None else scope & rest
    names = {k: f"_f{i}" for i, k in enumerate(flags)}
    flagged = base.select(
        *order, "texto", *[p.alias(names[k]) for k, p in flags.items()]
    )
    metrics = {}
    for k in flags:
        cells = F.count_if(F.col(names[k]))
        metrics[k] = {"celdas": cells}
        if with_percentage:
            metrics[k]["porcentaje"] = percentage(cells, F.count("*"))
    table = unpivot_metrics(flagged, metrics, label)
    if with_examples:
        labels = F.array(*[F.when(F.col(names[k]), F.lit(k)) for k in flags])
        examples = first_examples(
            flagged, labels, F.col("texto"), order, n, name=label, label_count=len(flags),
        )
        # One row per pattern on both sides.
        table = table.join(F.broadcast(examples), label, "left").withColumn(
            "ejemplos", F.coalesce("ejemplos", F.lit(""))
        )
    return table.orderBy(F.desc("celdas"), label)
