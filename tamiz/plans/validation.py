"""Checks that a cleaned table must pass."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.codes import SCHOOL_CODE, code_prefix, is_name
from tamiz.functions.folding import let
from tamiz.functions.phone import VALID_LENGTHS, split_numbers
from tamiz.functions.text import (
    all_blank,
    found,
    full_match,
    has_edge_space,
    name_key,
    plain,
    trimmed,
    unaccented,
)
from tamiz.operators.duplicates import duplicate_count, duplicate_rows
from tamiz.operators.frequency import value_counts
from tamiz.operators.skew import join_per_key
from tamiz.plans import registry as R
from tamiz.plans.cleaning import TRAILING_DATE

#: A cell that is one number of an approved length, and not of zeros alone.
SINGLE_NUMBER = r"\A(?!0+\z)(?:" + "|".join(f"[0-9]{{{n}}}" for n in VALID_LENGTHS) + r")\z"


def category_spellings(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columna, valor, cantidad, escrituras): every value, its rows and how many values share its folded key."""
    values = value_counts(df, columns, trim=True).where("valor <> ''")
    values = values.withColumn("_clave", name_key(F.col("valor")))
    spellings = F.count("*").over(Window.partitionBy("variable", "_clave"))  # one row per value
    return values.select(F.col("variable").alias("columna"), "valor", "cantidad", spellings.alias("escrituras"))


def equivalent_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columna, valor): the values behind `equivalent_categories`."""
    return category_spellings(df, columns).where("escrituras > 1").select("columna", "valor")


def equivalent_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Categories of one column that share a folded key (V6)."""
    return (
        value_counts(df, columns, trim=True)
        .where("valor <> ''")
        .groupBy("variable", name_key(F.col("valor")).alias("clave"))
        .agg(F.count("*").alias("escrituras"))
        .where("escrituras > 1")
    )


def wrong_types(df: DataFrame, columns: list[str]) -> list[str]:
    """Source columns that are not text; known from the schema alone."""
    types = dict(df.dtypes)
    return [c for c in columns if types.get(c) != "string"]


def has_wrong_type(column: str) -> Column:
    """The value of a cell reads as another type than its column's (V5)."""
    pattern = R.NUMBER if column in R.WORD_COLUMNS else R.CAST_IDENTIFIER
    text = plain(F.col(column))
    word = (text >= "A") & (text < "\x7f")  # begins with what no number begins with
    return (text != "") & ~word & full_match(trimmed(F.col(column)), pattern)


def has_wrong_phone(column: str) -> Column:
    """A cell that holds a number of another length than the approved ones, or none at all (V3)."""
    numbers = split_numbers(F.col(column))
    wrong = let(numbers, lambda ns: (F.size(ns) == 0) | F.exists(ns, lambda n: ~F.length(n).isin(*VALID_LENGTHS)))
    # One number of an approved length need not be taken apart.
    single = plain(F.col(column)).rlike(SINGLE_NUMBER)
    return (trimmed(F.col(column)) != "") & ~single & wrong


def has_marker(column: str) -> Column:
    """The cell is a disguised missing value; upper case is never shorter than the text."""
    text = F.col(column)
    short = F.length(plain(text)) <= max(map(len, R.MISSING_MARKERS))
    return short & F.coalesce(F.upper(text).isin(*R.MISSING_MARKERS), F.lit(False))


def invalid_checks() -> list[tuple[str, Column]]:
    """Disguised missing values and contamination left in a row, by column (V7)."""
    address = F.coalesce("DIRECCION", F.lit(""))
    return [
        *[(c, has_marker(c)) for c in R.SOURCE_COLUMNS],
        *[(c, F.col(c).isNotNull() & ~is_name(F.col(c))) for c in ("SUPERVISOR", "DIRECTOR")],
        ("DIRECCION", (address != "") & (unaccented(address) == unaccented(trimmed(F.col("MUNICIPIO"))))),
        ("DIRECCION", found(address, TRAILING_DATE)),
        ("AREA", trimmed(F.col("AREA")) == R.UNSPECIFIED_AREA),
    ]


def row_checks(columns: list[str]) -> list[tuple[str, str, Column]]:
    """(rule, column, violation) of all rules that a row breaks by itself."""
    dep = trimmed(F.col("DEPARTAMENTO"))
    code = trimmed(F.col("CODIGO"))
    return [
        *[("V2", c, has_edge_space(F.col(c))) for c in columns],
        ("V3", "TELEFONO", has_wrong_phone("TELEFONO")),
        ("V4", "DEPARTAMENTO", (dep != "") & ~dep.isin(*R.DEPARTMENTS.values())),
        *[("V5", c, has_wrong_type(c)) for c in [*R.WORD_COLUMNS, *R.IDENTIFIERS]],
        *[("V7", c, check) for c, check in invalid_checks()],
        ("C2 formato", "CODIGO", (code != "") & ~full_match(code, SCHOOL_CODE)),
    ]


def repeated_codes(df: DataFrame) -> DataFrame:
    """(CODIGO, n): codes of more than one row."""
    return (
        df.select(trimmed(F.col("CODIGO")).alias("CODIGO"))
        .where("CODIGO <> ''")
        .groupBy("CODIGO")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )


def _place(df: DataFrame) -> DataFrame:
    """The prefix of well-formed codes, with the place of the row."""
    return df.where(full_match(trimmed(F.col("CODIGO")), SCHOOL_CODE)).withColumns(
        {
            "_prefijo": code_prefix(F.col("CODIGO")),
            "_departamento": trimmed(F.col("DEPARTAMENTO")),
            "_municipio": trimmed(F.col("MUNICIPIO")),
        }
    )


def misplaced_codes(df: DataFrame) -> DataFrame:
    """(_prefijo, _departamento, _municipio, n): prefixes of several places, and places of several prefixes."""
    keys = ["_prefijo", "_departamento", "_municipio"]
    seen = _place(df).groupBy(*keys).agg(F.count("*").alias("n"))  # as few rows as places and prefixes
    places = F.count("*").over(Window.partitionBy("_prefijo"))
    prefixes = F.count("*").over(Window.partitionBy("_departamento", "_municipio"))
    return seen.withColumns({"_lugares": places, "_prefijos": prefixes}).where(
        "_lugares > 1 OR _prefijos > 1"
    ).select(*keys, "n")


def unknown_places(df: DataFrame, municipios: DataFrame) -> DataFrame:
    """(departamento, municipio, n): pairs with a municipality that the catalog lacks (V4)."""
    pairs = df.groupBy(
        trimmed(F.col("DEPARTAMENTO")).alias("departamento"), trimmed(F.col("MUNICIPIO")).alias("municipio")
    )
    return (
        pairs.agg(F.count("*").alias("n"))
        .where("municipio <> ''")
        .join(municipios.select("departamento", "municipio").distinct(), ["departamento", "municipio"], "left_anti")
    )


def violaciones(df: DataFrame, municipios: DataFrame | None = None) -> DataFrame:
    """(regla, columna, archivo_origen, fila_origen, valor): one row per violation, whatever the number.

    Rules that a row breaks by itself come from one scan. The others are found
    on values and their counts, and their rows by a join with what breaks the rule.
    """
    checks = row_checks(R.SOURCE_COLUMNS)
    shape = ["regla", "columna", *R.LINEAGE, "valor"]
    # A row sends the numbers of the checks that it breaks; their names and values are looked up after.
    broken = F.array(*[F.when(check, F.lit(i)).otherwise(0) for i, (_, _, check) in enumerate(checks, 1)])
    judged = df.select(*R.SOURCE_COLUMNS, *R.LINEAGE, F.array_remove(broken, 0).alias("_rotas"))
    own = judged.select(*R.SOURCE_COLUMNS, *R.LINEAGE, F.explode_outer("_rotas").alias("_i")).where("_i IS NOT NULL")

    def looked_up(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("_i"))

    place = looked_up([R.SOURCE_COLUMNS.index(c) + 1 for _, c, _ in checks])
    own = own.select(
        looked_up([rule for rule, _, _ in checks]).alias("regla"),
        looked_up([c for _, c, _ in checks]).alias("columna"),
        *R.LINEAGE,
        F.elt(place, *[F.col(c).cast("string") for c in R.SOURCE_COLUMNS]).alias("valor"),
    )

    def named(rows: DataFrame, rule: str, column: str) -> DataFrame:
        return rows.select(F.lit(rule).alias("regla"), F.lit(column).alias("columna"), *R.LINEAGE, F.col(column).alias("valor"))

    copies = duplicate_rows(df.select(*R.SOURCE_COLUMNS, *R.LINEAGE), R.SOURCE_COLUMNS, drop_blank=True, write=True)
    coded = df.select("CODIGO", *R.LINEAGE).withColumn("_codigo", trimmed(F.col("CODIGO")))
    repeated = join_per_key(coded, repeated_codes(df).withColumnRenamed("CODIGO", "_codigo"), ["_codigo"], "n")
    bad_places = misplaced_codes(df)
    misplaced = _place(df).join(bad_places, ["_prefijo", "_departamento", "_municipio"])
    spellings = category_spellings(df, R.CATEGORICAL_COLUMNS)
    by_cell = df.select(
        *R.LINEAGE,
        F.inline(F.array(*[F.struct(F.lit(c).alias("columna"), trimmed(F.col(c)).alias("valor")) for c in R.CATEGORICAL_COLUMNS])),
    ).where("valor <> ''")
    # Every value is listed, so that cells of a frequent one stay where they are read, whether it has variants or not.
    met = join_per_key(by_cell, spellings, ["columna", "valor"], "cantidad").where("escrituras > 1")
    equivalent = met.select(F.lit("V6").alias("regla"), "columna", *R.LINEAGE, "valor")
    found_ = [
        own,
        named(copies, "V1", "CODIGO"),
        named(repeated, "C2 unicidad", "CODIGO"),
        named(misplaced, "C2 lugar", "CODIGO"),
        equivalent,
    ]
    if municipios is not None:
        unknown = unknown_places(df, municipios).select("departamento", "municipio")
        placed = df.withColumns({"departamento": trimmed(F.col("DEPARTAMENTO")), "municipio": trimmed(F.col("MUNICIPIO"))})
        found_.append(named(placed.join(unknown, ["departamento", "municipio"]), "V4", "MUNICIPIO"))
    return reduce(DataFrame.unionByName, [rows.select(*shape) for rows in found_])


def reporte_validacion(df: DataFrame, municipios: DataFrame | None = None) -> DataFrame:
    """(regla, descripcion, violaciones, cumple), one row per rule.

    `municipios` (departamento, municipio) turns on the pair check of V4.
    `violaciones` lists the rows behind the counts.
    """
    columns = R.SOURCE_COLUMNS
    by_rule: dict[str, list[Column]] = {}
    for rule, _, check in row_checks(columns):
        by_rule.setdefault(rule, []).append(check.cast("long"))
    scalars = df.agg(*[F.sum(reduce(add, checks)).alias(rule) for rule, checks in by_rule.items()])

    def rows_of(found_: DataFrame) -> Column:
        return F.coalesce(found_.agg(F.sum("n").alias("n")).scalar(), F.lit(0))

    informative = df.where(~all_blank([F.col(c) for c in columns]))
    duplicated = duplicate_count(informative, columns).select("filas_duplicadas").scalar()
    variants = (
        equivalent_categories(df, R.CATEGORICAL_COLUMNS).agg(F.count("*").alias("n")).scalar()
    )
    outside = F.col("V4")
    if municipios is not None:
        outside = outside + rows_of(unknown_places(df, municipios))
    codes = F.col("C2 formato") + rows_of(repeated_codes(df)) + rows_of(misplaced_codes(df))
    rules = [
        ("C2", "codigos con formato, unicos y de un solo lugar", codes),
        ("V1", "cero duplicados exactos", duplicated),
        ("V2", "cero espacios al inicio o final", F.col("V2")),
        ("V3", "telefonos en formato aprobado", F.col("V3")),
        ("V4", "departamentos y municipios en catalogo", outside),
        ("V5", "tipos correctos", F.col("V5") + len(wrong_types(df, columns))),
        ("V6", "categorias sin variantes equivalentes", variants),
        ("V7", "valores invalidos del diagnostico en cero", F.col("V7")),
    ]
    rows = [
        F.struct(
            F.lit(rule).alias("regla"),
            F.lit(text).alias("descripcion"),
            F.coalesce(count.cast("long"), F.lit(0).cast("long")).alias("violaciones"),
        )
        for rule, text, count in rules
    ]
    return scalars.select(F.inline(F.array(*rows))).withColumn(
        "cumple", F.col("violaciones") == 0
    )


def validar_datos(df: DataFrame, municipios: DataFrame | None = None) -> None:
    """Raises ValueError naming the rules that the table breaks."""
    broken = reporte_validacion(df, municipios).where(~F.col("cumple")).collect()
    if broken:
        raise ValueError(
            "Reglas incumplidas: "
            + "; ".join(f"{r.regla} {r.descripcion} ({r.violaciones})" for r in broken)
        )
