"""Diagnostics of the registry: one function per report of the data contract.

Names and output columns are those a user of the registry tools knows. Every
function returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.codes import (
    CAPITAL,
    DISTRICT_CLASSES,
    NAME_CLASSES,
    SCHOOL_CODE,
    code_prefix,
    district_class,
    is_name,
    name_class,
    region_relation,
)
from tamiz.functions.phone import (
    EIGHT_DIGITS,
    PHONE_CLASSES,
    is_nonstandard_phone,
    phone_class,
    split_numbers,
)
from tamiz.functions.text import full_match, percentage, trimmed, unaccented
from tamiz.operators import consistency, duplicates, frequency, patterns, profile, variants
from tamiz.operators.distinct import distinct_scalar
from tamiz.plans import registry as R

# The names of checks, classes and cases that the functions below
# pass to their reports, and the texts beside them, are those of the data contract.


def _t(name: str) -> Column:
    return trimmed(F.col(name))


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in R.LINEAGE if c in df.columns]


def _ordered(df: DataFrame, orden) -> tuple[DataFrame, list[str]]:
    """Columns that say which example comes first: those given, else the
    lineage, else the order in which the rows are read."""
    if orden:
        return df, list(orden)
    if len(_lineage(df)) == len(R.LINEAGE):
        return df, R.LINEAGE
    return df.withColumn("_orden", F.monotonically_increasing_id()), ["_orden"]


# --- profile -----------------------------------------------------------------

def resumen_variables(df, columnas=tuple(R.GEOGRAPHIC_COLUMNS)) -> DataFrame:
    return profile.column_profile(df, list(columnas))


def tabla_faltantes(df, columnas=tuple(R.SOURCE_COLUMNS)) -> DataFrame:
    return profile.missing_table(df, list(columnas), R.MISSING_MARKERS)


def tabla_unicos(df, columnas=tuple(R.SOURCE_COLUMNS)) -> DataFrame:
    return profile.unique_values(df, list(columnas))


def duplicados_exactos(df, columnas=tuple(R.SOURCE_COLUMNS), sin_vacias=False) -> DataFrame:
    listed = duplicates.duplicate_rows(df, list(columnas), drop_blank=sin_vacias)
    order = [c for c in ["CODIGO", *_lineage(df)] if c in df.columns]
    return listed.select(*columnas, *_lineage(df), "copias").orderBy(*order)


def dominios(df, columnas=tuple(R.DOMAIN_COLUMNS)) -> DataFrame:
    return frequency.value_counts(df, list(columnas))


def tabla_formatos(df, columnas=tuple(R.SOURCE_COLUMNS)) -> DataFrame:
    return profile.format_table(df, list(columnas))


def resumen_telefono(df) -> DataFrame:
    return profile.phone_summary(df, "TELEFONO", R.PHONE_LETTERS, EIGHT_DIGITS)


def resumen_dimension(df, columnas=tuple(R.SOURCE_COLUMNS)) -> DataFrame:
    return profile.dimension_summary(df, list(columnas), R.LINEAGE)


# --- phones --------------------------------------------------------------------

def telefonos_no_estandar(df, extra=()) -> DataFrame:
    numbers = df.where(is_nonstandard_phone(F.col("TELEFONO"))).withColumn(
        "numeros_recuperados", split_numbers(F.col("TELEFONO"))
    )
    return numbers.select(
        "TELEFONO",
        "ESTABLECIMIENTO",
        phone_class(F.col("TELEFONO"), F.col("numeros_recuperados")).alias("categoria"),
        "numeros_recuperados",
        F.size("numeros_recuperados").cast("long").alias("cantidad_recuperada"),
        *_lineage(df),
        *extra,
    )


def categorias_telefono(df, orden=None, ejemplos: int = 5) -> DataFrame:
    """Non-standard cells per class, with the first examples of each."""
    df, order = _ordered(df, orden)
    detail = telefonos_no_estandar(df, extra=[c for c in order if c not in R.LINEAGE])
    counts = detail.groupBy("categoria").agg(F.count("*").alias("cantidad"))
    examples = patterns.first_examples(
        detail, F.array("categoria"), F.col("TELEFONO"), order, ejemplos,
        separator=" | ", name="categoria", label_count=len(PHONE_CLASSES),
    )
    # One row per class on both sides.
    return counts.join(F.broadcast(examples), "categoria", "left").orderBy(
        F.desc("cantidad"), "categoria"
    )


# --- free text -------------------------------------------------------------------

def inventario_escritura(df, columna, orden=None) -> DataFrame:
    df, order = _ordered(df, orden)
    return patterns.pattern_inventory(df, _t(columna), R.predicates(R.WRITING_PATTERNS), order)


def marcadores_direccion(df, columna="DIRECCION", orden=None) -> DataFrame:
    df, order = _ordered(df, orden)
    return patterns.pattern_inventory(
        df, unaccented(_t(columna)), R.predicates(R.ADDRESS_MARKERS), order,
        label="marcador", residual=R.NO_MARKER, scope=F.col("texto") != "",
    )


def direccion_redundante(
    df, direccion="DIRECCION", municipio="MUNICIPIO", orden=None
) -> DataFrame:
    df, order = _ordered(df, orden)
    prepared = df.withColumn("_municipio", unaccented(_t(municipio))).withColumn(
        "_direccion", unaccented(_t(direccion))
    )
    equal = F.col("_direccion") == F.col("_municipio")
    inside = consistency.contains_other(F.col("_direccion"), F.col("_municipio"))
    cases = prepared.select(
        *order,
        "_direccion",
        F.when((F.col("_direccion") != "") & equal, "direccion == municipio")
        .when((F.col("_direccion") != "") & inside, "direccion contiene municipio")
        .alias("_caso"),
    )
    return _exclusive_cases(
        cases, "_caso", "_direccion", "caso",
        ["direccion == municipio", "direccion contiene municipio"], order,
    )


def _exclusive_cases(df, case, value, label, labels, order) -> DataFrame:
    """Counts, shares and examples of exclusive classes; empty classes stay."""
    table = profile.unpivot_metrics(
        df,
        {
            name: {
                "celdas": F.count_if(F.col(case) == name),
                "porcentaje": percentage(F.count_if(F.col(case) == name), F.count("*")),
            }
            for name in labels
        },
        label,
    )
    examples = patterns.first_examples(
        df, F.array(case), F.col(value), order, 3, name=label, label_count=len(labels),
    )
    return table.join(F.broadcast(examples), label, "left").withColumn(
        "ejemplos", F.coalesce("ejemplos", F.lit(""))
    )


def direccion_contaminada(df, columna="DIRECCION", orden=None) -> DataFrame:
    df, order = _ordered(df, orden)
    return patterns.pattern_inventory(
        df, unaccented(_t(columna)), R.predicates(R.CONTAMINATION), order,
        with_percentage=False,
    )


def nombres_ausentes(df, columna, orden=None) -> DataFrame:
    df, order = _ordered(df, orden)
    classed = df.select(
        *order, _t(columna).alias("_texto"), name_class(F.col(columna)).alias("_clase")
    )
    return _exclusive_cases(
        classed, "_clase", "_texto", "categoria", list(NAME_CLASSES), order
    )


# --- spelling variants --------------------------------------------------------------

def variantes_establecimiento(
    df, nombre="ESTABLECIMIENTO", codigo="CODIGO", municipio="MUNICIPIO"
) -> DataFrame:
    groups = variants.spelling_groups(
        df,
        _t(nombre),
        {"codigos": F.col(codigo), "municipios": F.col(municipio)},
        keep=_t(nombre) != "",
    )
    return variants.label_by_count(groups, "municipios", "posible duplicado", "homonimos")


def variantes_nombre(df, nombre, geografia) -> DataFrame:
    groups = variants.spelling_groups(
        df, _t(nombre), {"jurisdicciones": F.col(geografia)}, keep=is_name(F.col(nombre))
    )
    return variants.label_by_count(
        groups, "jurisdicciones", "misma persona", "revisar (homonimo?)"
    )


# --- categories ----------------------------------------------------------------------

def inventario_categorias(df, columnas=tuple(R.CATEGORICAL_COLUMNS)) -> DataFrame:
    return frequency.category_inventory(df, list(columnas))


def jornada_sin_jornada(df) -> DataFrame:
    return frequency.conditional_frequency(df, _t("JORNADA") == R.NO_SHIFT, "PLAN")


def plan_jerarquia_ambigua(df) -> DataFrame:
    return frequency.conditional_frequency(df, _t("PLAN") == R.GENERIC_PLAN, "SECTOR")


def area_sin_especificar(df) -> DataFrame:
    return consistency.detail(
        df,
        _t("AREA") == R.UNSPECIFIED_AREA,
        ["CODIGO", "DEPARTAMENTO", "MUNICIPIO", "ESTABLECIMIENTO", "AREA"],
    )


def rural_en_capital() -> Column:
    return (_t("DEPARTAMENTO") == CAPITAL) & (_t("AREA") == R.RURAL)


def area_contradice_departamento(df) -> DataFrame:
    return consistency.detail(
        df, rural_en_capital(), ["CODIGO", "MUNICIPIO", "ESTABLECIMIENTO", "DIRECCION", "AREA"]
    )


# --- codes and geography ----------------------------------------------------------------

def _one_row(df: DataFrame, label: str, rows: list[tuple]) -> DataFrame:
    """(label, cantidad, text) rows, each from its own count."""
    return df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias(label),
                        count.cast("long").alias("cantidad"),
                        (text if isinstance(text, Column) else F.lit(text)).alias(column),
                    )
                    for name, count, column, text in rows
                ]
            )
        )
    )


def diagnostico_codigo(df) -> DataFrame:
    code = _t("CODIGO")
    # Prefixes and places are few: one scan counts their combinations, and all
    # checks but the one of whole codes follow from those.
    seen = df.groupBy(
        code_prefix(F.col("CODIGO")).alias("prefijo"),
        F.coalesce("DEPARTAMENTO", F.lit("")).alias("departamento"),
        F.coalesce("MUNICIPIO", F.lit("")).alias("municipio"),
    ).agg(
        F.count_if(code == "").alias("vacios"),
        F.count_if(full_match(code, SCHOOL_CODE)).alias("formato"),
        F.count_if(code != "").alias("no_vacios"),
    )
    pair, prefix = Window.partitionBy("departamento", "municipio"), Window.partitionBy("prefijo")

    def differ(column: str) -> Column:
        return F.min(column).over(prefix) != F.max(column).over(prefix)

    related = seen.withColumns(
        {
            "par": F.row_number().over(pair.orderBy("prefijo")),
            "lugar": F.row_number().over(prefix.orderBy("departamento", "municipio")),
            "varios": differ("departamento") | differ("municipio"),
        }
    )
    scalars = related.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("vacios", "formato", "no_vacios")],
        # Row 2 is there once for every pair of several prefixes.
        F.count_if(F.col("par") == 2).alias("prefijos_por_par"),
        F.count_if((F.col("lugar") == 1) & F.col("varios")).alias("lugares_por_prefijo"),
    )
    distinct_codes = distinct_scalar(df, F.nullif(code, F.lit("")))
    return _one_row(
        scalars,
        "revision",
        [
            ("valores vacios", F.col("vacios"), "resultado", "esperado 0"),
            (
                "formato NN-NN-NNNN-NN", F.col("formato"), "resultado",
                "debe coincidir con los registros no vacios",
            ),
            (
                "codigos duplicados", F.col("no_vacios") - distinct_codes, "resultado",
                "esperado 0",
            ),
            (
                "pares departamento-municipio con más de un prefijo",
                F.col("prefijos_por_par"), "resultado", "esperado 0",
            ),
            (
                "prefijos asociados a más de una geografia",
                F.col("lugares_por_prefijo"), "resultado", "esperado 0",
            ),
        ],
    )


def diagnostico_distrito(df, orden=None) -> DataFrame:
    df, order = _ordered(df, orden)
    classed = df.select(
        *order, _t("DISTRITO").alias("_valor"), district_class(F.col("DISTRITO")).alias("categoria")
    )
    counts = frequency.class_counts(classed, F.col("categoria"), "categoria")
    examples = patterns.first_examples(
        classed, F.array("categoria"), F.col("_valor"), order, 4,
        separator=" | ", name="categoria", label_count=len(DISTRICT_CLASSES),
    )
    # One row per format class on both sides.
    return counts.join(F.broadcast(examples), "categoria", "left").orderBy(
        F.desc("cantidad"), "categoria"
    )


def fuera_de_catalogo() -> Column:
    dep = _t("DEPARTAMENTO")
    return (dep != "") & ~dep.isin(*R.DEPARTMENTS) & (dep != CAPITAL)


def diagnostico_departamento(df) -> DataFrame:
    dep = _t("DEPARTAMENTO")
    # Departments are counted first; the checks then read one row per value.
    values = df.groupBy(dep.alias("valor")).agg(F.count("*").alias("n"))
    value, n = F.col("valor"), F.col("n")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    official = value.isin(*R.DEPARTMENTS)
    scalars = values.agg(
        F.count_if(value != "").alias("observadas"),
        F.count_if(official).alias("oficiales"),
        rows_where(value == CAPITAL).alias("capital"),
        rows_where(value.isin(*R.ACCENTED_DEPARTMENTS)).alias("sin_tilde"),
        rows_where((value != "") & ~official & (value != CAPITAL)).alias("fuera"),
    )
    return _one_row(
        scalars,
        "revision",
        [
            (
                "categorias observadas", F.col("observadas"), "detalle",
                F.concat(
                    F.col("oficiales").cast("string"),
                    F.lit(" departamentos oficiales y una categoria especial de la fuente"),
                ),
            ),
            (
                "registros en CIUDAD CAPITAL", F.col("capital"), "detalle",
                "particion de la fuente; no es departamento oficial",
            ),
            (
                "departamentos sin tilde normativa", F.col("sin_tilde"), "detalle",
                ", ".join(sorted(R.ACCENTED_DEPARTMENTS)),
            ),
            (
                "valores fuera del catalogo preliminar", F.col("fuera"), "detalle",
                "excluye la categoria especial CIUDAD CAPITAL",
            ),
        ],
    )


def diagnostico_municipio(df) -> DataFrame:
    # All eight checks follow from the distinct pairs and their row counts.
    pairs = df.groupBy(
        _t("DEPARTAMENTO").alias("dep"), _t("MUNICIPIO").alias("mun")
    ).agg(F.count("*").alias("n"))
    dep, mun, n = F.col("dep"), F.col("mun"), F.col("n")
    capital, named = dep == CAPITAL, mun != ""

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    per_name = pairs.groupBy("mun").agg(
        F.count_if(named).alias("pares"),
        F.count_if(named & ~capital).alias("pares_fuera"),
        F.count_if(named & capital).alias("pares_capital"),
        rows_where(~named).alias("vacios"),
        rows_where(capital & ~full_match(mun, R.ZONE)).alias("capital_sin_zona"),
        rows_where(mun.rlike(R.ACCENTED_VOWEL)).alias("acentuadas"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    scalars = per_name.agg(
        total("vacios"),
        F.count_if(named).alias("nombres"),
        total("pares"),
        total("pares_fuera"),
        F.count_if(F.col("pares_capital") > 0).alias("zonas"),
        total("capital_sin_zona"),
        F.count_if(F.col("pares_fuera") > 1).alias("homonimos"),
        total("acentuadas"),
    )
    return _one_row(
        scalars,
        "revision",
        [
            ("valores vacios", F.col("vacios"), "detalle", "esperado 0"),
            (
                "nombres unicos", F.col("nombres"), "detalle",
                "incluye las zonas registradas por la fuente",
            ),
            (
                "pares departamento-municipio", F.col("pares"), "detalle",
                "conteo derivado de pares únicos observados",
            ),
            (
                "pares fuera de CIUDAD CAPITAL", F.col("pares_fuera"), "detalle",
                "municipios con establecimientos de Diversificado",
            ),
            (
                "zonas de Ciudad Capital", F.col("zonas"), "detalle",
                "etiquetas ZONA que deben conservarse como sububicacion",
            ),
            (
                "filas capitalinas que no tienen formato ZONA", F.col("capital_sin_zona"),
                "detalle", "esperado 0",
            ),
            (
                "nombres repetidos en distintos departamentos", F.col("homonimos"),
                "detalle", "homonimos posibles; validar siempre junto a DEPARTAMENTO",
            ),
            (
                "filas con vocal acentuada", F.col("acentuadas"), "detalle",
                "permite medir si la exportacion conserva tildes en municipios",
            ),
        ],
    )


def diagnostico_departamental(df) -> DataFrame:
    # Pairs are few; the relation is worked out once per distinct pair.
    pairs = df.groupBy("DEPARTAMENTO", "DEPARTAMENTAL").agg(F.count("*").alias("n"))
    relation = region_relation(F.col("DEPARTAMENTO"), F.col("DEPARTAMENTAL"))
    counts = pairs.groupBy(relation.alias("relacion")).agg(F.sum("n").alias("cantidad"))
    divisions = distinct_scalar(df, _t("DEPARTAMENTAL"))
    return counts.select(
        "relacion",
        "cantidad",
        percentage(F.col("cantidad"), frequency.row_count(df)).alias("porcentaje"),
        divisions.alias("categorias_departamentales"),
    ).orderBy(F.desc("cantidad"), "relacion")
