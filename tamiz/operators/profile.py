"""Column profiles: every table is one fused aggregate over a single scan.

All counts of all columns are partial aggregates on the map side; one row
reaches the last stage and is turned into one row per column there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.text import (
    all_blank,
    full_match,
    has_inner_run,
    percentage,
    plain,
    trimmed,
)
from tamiz.operators.distinct import distinct_counts


def unpivot_metrics(
    df: DataFrame, metrics: dict[str, dict[str, Column]], label: str = "variable"
) -> DataFrame:
    """One aggregate, then one row per label.

    `metrics` maps a label to its named aggregate expressions; every label has
    the same names, in the order of the output columns.
    """
    flat, structs = [], []
    for i, (name, aggregates) in enumerate(metrics.items()):
        fields = [F.lit(name).alias(label)]
        for j, (column, expr) in enumerate(aggregates.items()):
            flat.append(expr.alias(f"m{i}_{j}"))
            fields.append(F.col(f"m{i}_{j}").alias(column))
        structs.append(F.struct(*fields))
    return df.agg(*flat).select(F.inline(F.array(*structs)))


def metric_rows(
    df: DataFrame,
    metrics: list[tuple[str, Column]],
    label: str,
    value: str,
) -> DataFrame:
    """Several scalar aggregates as (label, value) rows."""
    return unpivot_metrics(
        df, {name: {value: expr.cast("long")} for name, expr in metrics}, label
    )


def with_trimmed(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The columns and their trimmed texts, each trimmed once per row."""
    names = {c: f"_t{i}" for i, c in enumerate(columns)}
    return df.select(*columns, *[trimmed(F.col(c)).alias(t) for c, t in names.items()]), names


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-blank trimmed values per column."""
    texts = df.select(*[trimmed(F.col(c)).alias(c) for c in columns])
    return distinct_counts(texts, {c: F.when(F.col(c) != "", F.col(c)) for c in columns})


def _attach_distinct(
    table: DataFrame, counts: DataFrame, name: str, columns: list[str]
) -> DataFrame:
    # `counts` has at most one row per profiled column, hence the broadcast.
    joined = table.join(F.broadcast(counts), "variable", "left")
    return joined.withColumn(name, F.coalesce("unicos", F.lit(0).cast("long"))).select(
        *columns
    )


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Type, rows, missing, distinct values and space defects per column."""
    types = dict(df.dtypes)
    source, texts = with_trimmed(df, columns)

    def metrics(c: str) -> dict[str, Column]:
        missing = F.count_if(F.col(texts[c]) == "")
        return {
            "tipo_leido": F.lit(types[c]),
            "registros": F.count("*"),
            "faltantes": missing,
            "porcentaje_faltantes": percentage(missing, F.count("*")),
            "espacios_inicio_fin": F.count_if(plain(F.col(c)) != F.col(texts[c])),
            "espacios_multiples": F.count_if(has_inner_run(F.col(texts[c]))),
        }

    table = unpivot_metrics(source, {c: metrics(c) for c in columns})
    counts = distinct_values(df, columns)
    return _attach_distinct(
        table,
        counts,
        "valores_unicos_no_vacios",
        [
            "variable", "tipo_leido", "registros", "faltantes",
            "porcentaje_faltantes", "valores_unicos_no_vacios",
            "espacios_inicio_fin", "espacios_multiples",
        ],
    )


def missing_table(df: DataFrame, columns: list[str], markers: list[str]) -> DataFrame:
    """Cells that are blank or hold one of the upper-case markers."""

    flags = df.select(*[F.upper(trimmed(F.col(c))).isin(*markers).alias(c) for c in columns])
    counts = {c: F.count_if(F.col(c)) for c in columns}
    table = unpivot_metrics(
        flags,
        {
            c: {"faltantes": n, "porcentaje": percentage(n, F.count("*"), 4)}
            for c, n in counts.items()
        },
    )
    return table.orderBy(F.desc("faltantes"), "variable")


def unique_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct raw values per column; null counts as a value of its own."""
    # A struct is never null, and the fingerprint inside tells null from "".
    counts = distinct_counts(df.select(*columns), {c: F.struct(c) for c in columns})
    return counts.withColumnRenamed("unicos", "valores_unicos").orderBy(
        F.desc("valores_unicos"), "variable"
    )


def format_table(df: DataFrame, columns: list[str], only_findings: bool = True) -> DataFrame:
    """Edge spaces, runs of spaces in the raw text, and final full stops."""
    source, texts = with_trimmed(df, columns)
    table = unpivot_metrics(
        source,
        {
            c: {
                "espacios_inicio_fin": F.count_if(plain(F.col(c)) != F.col(texts[c])),
                "espacios_multiples": F.count_if(has_inner_run(plain(F.col(c)))),
                "punto_final": F.count_if(F.col(texts[c]).endswith(".")),
            }
            for c in columns
        },
    )
    if not only_findings:
        return table
    return table.where("espacios_inicio_fin + espacios_multiples + punto_final > 0")


def dimension_summary(df: DataFrame, columns: list[str], lineage: list[str]) -> DataFrame:
    """Rows, informative rows, blank rows, variables and lineage columns."""
    blank = all_blank([F.col(c) for c in columns])
    return metric_rows(
        df.select(blank.alias("vacia")),
        [
            ("Registros crudos", F.count("*")),
            ("Registros no vacíos", F.count_if(~F.col("vacia"))),
            ("Filas completamente vacías", F.count_if("vacia")),
            ("Variables originales", F.lit(len(columns))),
            ("Columnas de trazabilidad", F.lit(len(lineage))),
        ],
        "métrica",
        "valor",
    )


def schema_listing(df: DataFrame) -> DataFrame:
    """(variable, tipo_leído), from the schema alone."""
    return df.sparkSession.createDataFrame(df.dtypes, "variable string, `tipo_leído` string")


def phone_summary(df: DataFrame, phone: str, letters: str, standard: str) -> DataFrame:
    """Blank, standard, other, and cells holding letters."""
    text = F.col("texto")
    good = full_match(text, standard)
    return metric_rows(
        df.select(trimmed(F.col(phone)).alias("texto")),
        [
            ("Vacíos", F.count_if(text == "")),
            ("Exactamente 8 dígitos", F.count_if(good)),
            ("Formato diferente de 8 dígitos", F.count_if((text != "") & ~good)),
            ("Con letras o texto adicional", F.count_if(text.rlike(letters))),
        ],
        "métrica",
        "cantidad",
    )


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns with exactly one distinct non-blank value."""
    values = unpivot_metrics(
        df.select(*[trimmed(F.col(c)).alias(c) for c in columns]),
        {c: {"valor": F.max(F.col(c))} for c in columns},
    )
    constant = distinct_values(df, columns).where("unicos = 1")
    # One row per column on both sides.
    return values.join(F.broadcast(constant), "variable").select(
        "variable", "valor"
    )
