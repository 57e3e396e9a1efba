"""Joining per-key results back to rows when some keys are very heavy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy from this many rows on; at most HEAVY_KEYS of them are
# broadcast, which bounds the broadcast side whatever the data.
HEAVY_ROWS = 100_000
HEAVY_KEYS = 50_000


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    weight: str,
    how: str = "inner",
    heavy_rows: int | None = None,
) -> DataFrame:
    """rows joined with `per_key` (one row per key, `weight` rows behind it).

    Rows of heavy keys never move: those keys are few and are broadcast. All
    other rows meet their key in an ordinary shuffle join, where no key has
    more than `heavy_rows` rows (HEAVY_ROWS unless given), except those that fall
    behind the HEAVY_KEYS largest. For a left join, `per_key` should list every
    key (with nulls to attach where there is nothing), or a heavy key that it
    lacks goes unnoticed.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    least = HEAVY_ROWS if heavy_rows is None else heavy_rows
    heavy = (
        per_key.where(F.col(weight) >= least)
        .orderBy(F.desc(weight), *keys)
        .limit(HEAVY_KEYS)
    )
    heavy_part = rows.join(F.broadcast(heavy), keys, "inner")
    light_part = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(
        per_key, keys, how
    )
    return heavy_part.unionByName(light_part)


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left", heavy_rows: int | None = None
) -> DataFrame:
    """rows joined with a reference table that has one row per key, of any size.

    How often the rows have a key is counted first, map-side. The entries of
    frequent keys are broadcast to their rows; all others meet in a join
    that the engine broadcasts or shuffles by the bytes it finds. Nothing
    runs while the query is built. Rows with a null key find nothing.
    """
    taken, weight = {c.lower() for c in [*rows.columns, *lookup.columns]}, "_filas"
    while weight in taken:
        weight += "_"
    counts = rows.groupBy(*keys).agg(F.count("*").alias(weight))
    # For a left join every key is listed, so that a frequent one without an entry is known too.
    entries = counts.join(lookup, keys, how)
    return join_per_key(rows, entries, keys, weight, how, heavy_rows).drop(weight)
