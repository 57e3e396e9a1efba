"""Exact duplicates, surplus keys and duplicate candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import all_blank, digest, plain, trimmed
from tamiz.operators.skew import HEAVY_KEYS, HEAVY_ROWS
from tamiz.session import written


#: Bits of the filter of repeated fingerprints: 16 MB are broadcast, whatever the data.
FILTER_BITS = 1 << 27


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def _keyed(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with the fingerprint of ``columns``, and the names of its two parts."""
    names = [free_name(df, "_h1"), free_name(df, "_h2")]
    first, second = digest(*[plain(F.col(f"`{c}`")) for c in columns])
    return df.withColumns(dict(zip(names, (first, second)))), names


def _bit(fingerprint: Column, bits: int) -> Column:
    return F.pmod(fingerprint, F.lit(bits).cast("long")) + 1


def repeated_filter(fingerprints: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """(_bucket, _bitmap): a Bloom filter of one hash, in rows of 4 KB."""
    place = _bit(F.col(column), bits)
    return fingerprints.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap")
    )


def may_contain(rows: DataFrame, column: str, filter_: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose fingerprint the filter may contain; none that it does contain is lost.

    The filter is broadcast (its size follows from ``bits`` alone), so rows are dropped where they are read.
    """
    place = _bit(F.col(column), bits)
    at = F.bitmap_bit_position(place)
    bucket, bitmap = free_name(rows, "_bucket"), free_name(rows, "_bitmap")
    named = filter_.select(F.col("_bucket").alias(bucket), F.col("_bitmap").alias(bitmap))
    met = rows.join(F.broadcast(named), F.bitmap_bucket_number(place) == F.col(bucket))
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.call_function("shiftright", byte.cast("int"), (at % 8).cast("int")).bitwiseAND(1)
    return met.where(bit == 1).drop(bucket, bitmap)


def repeated_rows(df: DataFrame, columns: list[str], bits: int = FILTER_BITS) -> tuple[DataFrame, list[str]]:
    """Rows whose fingerprint of ``columns`` is repeated, with it, and the names of its two parts.

    Fingerprints are counted map-side and alone; rows that are unique stay where
    they are read, but for the few that the filter lets pass by chance.
    """
    keyed, names = _keyed(df, columns)
    counted = keyed.select(*names).groupBy(*names).agg(F.count("*").alias("_n")).where("_n > 1")
    return may_contain(keyed, names[0], repeated_filter(counted, names[0], bits), bits), names


def _value(columns: list[str]) -> Column:
    """The values as one column: an equality for each would make the optimizer infer all their combinations."""
    return F.struct(*[plain(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])


def _values(rows: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """Different values of ``columns`` as ``_value``, with their fingerprint and row count ``_n``.

    The values themselves are compared here; copies are merged before they move.
    """
    return rows.select(*names, _value(columns).alias("_value")).groupBy(*names, "_value").agg(F.count("*").alias("_n"))


def duplicate_count(df: DataFrame, columns: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """Rows that belong to a group of equal rows, and how many groups."""
    values = _values(*repeated_rows(df, columns, bits), columns)
    return values.where("_n > 1").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("filas_duplicadas"),
        F.count("*").alias("grupos"),
    )


def duplicate_rows(
    df: DataFrame,
    columns: list[str],
    drop_blank: bool = False,
    heavy_rows: int | None = None,
    bits: int = FILTER_BITS,
    write: bool = False,
) -> DataFrame:
    """All members of groups of equal rows, with the group size as `copias` (`copias_` if the table has that).

    Null and blank are equal. A filter of repeated fingerprints drops unique
    rows where they are read; the others meet the repeated values and are
    compared with them. Rows of groups larger than `heavy_rows` meet their
    fingerprint alone, by broadcast, and never shuffle; their values were
    compared when they were counted. With `write` the rows that the filter lets pass
    are written once, when this is called; else each of the three steps that
    follow finds them anew in the whole table.
    """
    copies = free_name(df, "copias")
    if drop_blank:
        df = df.where(~all_blank([F.col(f"`{c}`") for c in columns]))
    rows, names = repeated_rows(df, columns, bits)
    if write:
        rows = written(rows, "repeated-rows")
    values = _values(rows, names, columns)
    per_print = values.groupBy(*names).agg(F.sum("_n").alias(copies), F.count("*").alias("_values"))
    least = HEAVY_ROWS if heavy_rows is None else heavy_rows
    heavy = per_print.where((F.col("_values") == 1) & (F.col(copies) > 1) & (F.col(copies) >= least))
    heavy = heavy.orderBy(F.desc(copies), *names).limit(HEAVY_KEYS).select(*names, copies)
    value = free_name(df, "_value")
    repeated = values.where("_n > 1").select(*names, F.col("_value").alias(value), F.col("_n").alias(copies))
    light = rows.join(F.broadcast(heavy.select(*names)), names, "left_anti").withColumn(value, _value(columns))
    found = rows.join(F.broadcast(heavy), names).unionByName(light.join(repeated, [*names, value]).drop(value))
    return found.drop(*names)


def surplus_count(column: Column) -> Column:
    """Non-blank rows after the first of each key, as an aggregate.

    Fingerprints are counted, so that no text is shuffled.
    """
    value = F.nullif(trimmed(column), F.lit(""))
    first, second = digest(value)
    return F.count(value) - F.count_distinct(F.when(value.isNotNull(), first), second)


def repeats_after_first(df: DataFrame, column: str) -> DataFrame:
    """Per repeated non-blank value, the rows after the first one."""
    return (
        df.select(trimmed(F.col(column)).alias("valor"))
        .where("valor <> ''")
        .groupBy("valor")
        .agg((F.count("*") - 1).alias("repeticiones"))
        .where("repeticiones > 0")
    )
