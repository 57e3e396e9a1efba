"""Defect ledgers, the before/after report, and the report bundle."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.codes import CAPITAL, INCOMPLETE_DISTRICT, NAME_CLASSES, name_class
from tamiz.functions.phone import is_nonstandard_phone
from tamiz.functions.text import (
    all_blank,
    found,
    full_match,
    has_edge_space,
    has_inner_run,
    is_blank,
    name_key,
    percentage,
    plain,
    trimmed,
    unaccented,
)
from tamiz.operators import consistency
from tamiz.operators.distinct import distinct_scalar
from tamiz.operators.duplicates import duplicate_count
from tamiz.plans import diagnostics as D
from tamiz.plans import registry as R
from tamiz.plans.validation import equivalent_categories, wrong_types
from tamiz.session import written
from tamiz.sources.sinks import write_csv


def _t(name: str) -> Column:
    return trimmed(F.col(name))


def ledger(
    df: DataFrame, columns: list[str], rows: list[tuple], masks: dict[str, Column],
    scalars: dict[str, Column] | None = None, extra: DataFrame | None = None,
) -> DataFrame:
    """Ledger rows whose counts come from one aggregate over `df`.

    A row is a tuple matching `columns`; its entry for ``cantidad`` names a
    mask (counted), a scalar subquery, a column of the one row of ``extra`` or ``todas`` (all rows). The
    share is that of all rows, or of the count itself where the row says so. A column
    ``ejemplo`` holds the smallest value of the variable, trimmed and not blank,
    among the rows counted; it is empty where there is none and for scalars.
    """
    scalars = scalars or {}
    given = {*scalars, *(extra.columns if extra is not None else [])}
    examples = {}
    if "ejemplo" in columns:
        for variable, _, _, key, *_ in rows:
            if key not in given:
                shown = F.min(F.when(masks.get(key, F.lit(True)), F.nullif(_t(variable), F.lit(""))))
                examples[variable, key] = F.coalesce(shown, F.lit("")).alias(f"{variable}:{key}")
    counted = df.agg(
        F.count("*").alias("todas"),
        *[F.count_if(mask).alias(name) for name, mask in masks.items()],
        *examples.values(),
    )
    if extra is not None:
        both = counted.unionByName(extra, allowMissingColumns=True)
        counted = both.agg(*[F.max(f"`{c}`").alias(c) for c in both.columns])
    structs = []
    for row in rows:
        entry = dict(zip(columns, row))
        key = entry["cantidad"]
        count = (scalars[key] if key in scalars else F.col(key)).cast("long")
        shown = F.col(f"`{entry['variable']}:{key}`") if (entry["variable"], key) in examples else F.lit("")
        whole = count if entry.get("porcentaje") == OF_ITSELF else F.col("todas")
        share = percentage(count, whole)
        structs.append(
            F.struct(
                *[
                    count.alias(c) if c == "cantidad"
                    else share.alias(c) if c == "porcentaje"
                    else shown.alias(c) if c == "ejemplo"
                    else F.lit(entry[c]).alias(c)
                    for c in columns
                ]
            )
        )
    return counted.select(F.inline(F.array(*structs)))


#: A share of what is counted, where that is not rows.
OF_ITSELF = "propio"

# Ledger of the categorical columns. Columns are variable,
# problema, categoria, cantidad (name of a count), porcentaje (None: the share
# of all rows), requiere_limpieza, estrategia_sugerida.
CATEGORICAL_LEDGER_COLUMNS = [
    "variable", "problema", "categoria", "cantidad", "porcentaje",
    "requiere_limpieza", "estrategia_sugerida",
]
CATEGORICAL_LEDGER = [
    ("NIVEL", "Columna constante (un solo valor: DIVERSIFICADO)", "sin variabilidad", "todas", None, "No",
     "Conservar; documentar en el codebook que viene del filtro de descarga, no aporta variabilidad para el análisis"),
    ("JORNADA", '"SIN JORNADA" es un valor real, no un faltante', "dominio", "sin_jornada", None, "No",
     "Mantener como categoría; documentar que corresponde a planes semipresenciales/a distancia"),
    ("AREA", '"SIN ESPECIFICAR" es faltante disfrazado de categoría', "faltante", "sin_especificar", None, "Si",
     "Reclasificar a NA"),
    ("AREA", "Contradice DEPARTAMENTO (RURAL dentro de Ciudad Capital)", "inconsistencia entre variables",
     "rural_capital", None, "Revisar", "Revisar caso a caso contra DIRECCION; no corregir automáticamente"),
    ("PLAN", '"SEMIPRESENCIAL" sin el detalle de sus 3 sub-categorías', "jerarquía ambigua", "plan_generico", None,
     "Documentar", "Conservar como está; documentar la jerarquía en el codebook, no reasignar por adivinanza"),
    ("PLAN", "Categorías de muy baja frecuencia (posibles typos o casos legítimos raros)", "dominio", "plan_raro",
     None, "Revisar",
     "Revisar manualmente; conservar si son consistentes con SECTOR/JORNADA"),
    ("STATUS", '"TEMPORAL TITULOS" / "TEMPORAL NOMBRAMIENTO" sin catálogo oficial de referencia',
     "dominio por validar", "status_temporal", None, "Validar",
     "Confirmar contra catálogo MINEDUC si está disponible; si no, mantener y documentar como categoría administrativa distinta de CERRADA"),
    ("SECTOR/STATUS/MODALIDAD", "Sin problemas de formato detectados (mayúsculas, espacios, tildes)", "formato",
     "formato_irregular", None, "No", "Convertir a tipo categórico (factor) con dominio fijo; validar cardinalidad"),
]

# Ledger of the geographic columns; its example column is computed.
GEOGRAPHIC_LEDGER_COLUMNS = CATEGORICAL_LEDGER_COLUMNS + ["ejemplo"]
GEOGRAPHIC_LEDGER = [
    ("CODIGO", "Riesgo de tipado de un identificador numerico", "tipo", "todas", None, "No",
     "Conservar como texto y validar formato/unicidad; no convertir a numero"),
    ("DISTRITO", "Valor vacio", "faltante", "distrito_vacio", None, "Si",
     "Representar como NA; no imputar sin catalogo oficial"),
    ("DISTRITO", "Codigo incompleto que termina en guion", "formato", "distrito_incompleto", None, "Si",
     "Marcar para revision; no completar digitos automaticamente"),
    ("DISTRITO", "Dos estructuras ampliamente usadas", "formato", "distrito_no_vacio", None, "Revisar",
     "Conservar ambos formatos hasta contrastar el catalogo MINEDUC"),
    ("DEPARTAMENTO", "Categoria especial CIUDAD CAPITAL", "dominio", "capital", None, "Si",
     "Mapear geograficamente a Guatemala sin perder la condicion de capital"),
    ("DEPARTAMENTO", "Tildes omitidas en departamentos con acento normativo", "ortografia", "sin_tilde", None, "Si",
     "Usar nombres oficiales bien escritos para el dato final"),
    ("MUNICIPIO", "Zonas capitalinas almacenadas como municipio", "consistencia", "capital", None, "Si",
     "Conservar la zona como sububicacion y asignar municipio Guatemala"),
    ("MUNICIPIO", "Etiquetas pendientes de validacion ortografica contra catalogo", "catalogo", "municipios", OF_ITSELF,
     "Si", "Cruzar cada etiqueta con el catalogo oficial y conservar la escritura correcta"),
    ("DEPARTAMENTAL", "No siempre coincide textualmente con DEPARTAMENTO", "consistencia", "departamental_distinta",
     None, "Revisar", "Tratarla como division administrativa propia; normalizar tildes sin forzar igualdad"),
]

# What is done about each kind of defect: category, whether it needs cleaning, and how.
TREATMENTS = {
    "vacío": ("faltante", "No", "Queda como NA"),
    "ausencia disfrazada": ("faltante", "Si", "Pasa a NA"),
    "patrón de escritura": ("formato", "Si", "Se iguala en la clave de comparación"),
    "valor compuesto": ("formato", "Si", "Se separa en sus partes"),
    "texto de otra columna": ("formato", "Si", "Se recorta"),
    "contaminación": ("contaminacion", "Si", "Se corrige en su contexto"),
    "variantes de escritura": ("duplicado", "Si", "Se agrupan por clave; se revisan antes de fusionar"),
    "valor informado": ("estructural", "No", "Se conserva"),
    "fuera del dominio fijo": ("estructural", "Si", "Se revisa contra el dominio"),
    "categoría por confirmar": ("estructural", "Revisar", "Se revisa caso a caso"),
    "categoría con significado propio": ("estructural", "No", "Se conserva y se documenta"),
}
# (variable, kind, what exactly, name of the count), by source column.
DEFECTS = [
    ("ESTABLECIMIENTO", "patrón de escritura", "tiene tildes", "nombre_tildes"),
    ("ESTABLECIMIENTO", "patrón de escritura", "comillas", "nombre_comillas"),
    ("ESTABLECIMIENTO", "patrón de escritura", "espacios multiples", "nombre_espacios"),
    ("ESTABLECIMIENTO", "variantes de escritura", "", "nombre_variantes"),
    ("DIRECCION", "vacío", "o marcador", "direccion_vacia"),
    ("DIRECCION", "ausencia disfrazada", "igual al municipio", "direccion_municipio"),
    ("DIRECCION", "texto de otra columna", "contiene el municipio", "direccion_contiene"),
    *[("DIRECCION", "contaminación", label, key) for label, key in zip(R.CONTAMINATION, ("direccion_fecha", "direccion_letra_o"))],
    ("TELEFONO", "vacío", "", "telefono_vacio"),
    ("TELEFONO", "valor compuesto", "no es un número de 8 dígitos", "telefono_no_estandar"),
    ("SUPERVISOR", "ausencia disfrazada", "o vacío", "supervisor_ausente"),
    ("SUPERVISOR", "variantes de escritura", "", "supervisor_variantes"),
    ("SUPERVISOR", "contaminación", "carácter inusual", "supervisor_raro"),
    ("DIRECTOR", "ausencia disfrazada", "o vacío", "director_ausente"),
    ("DIRECTOR", "variantes de escritura", "", "director_variantes"),
    ("DIRECTOR", "valor compuesto", "título y nombre", "director_titulo"),
    ("NIVEL", "valor informado", "", "nivel_no_vacio"),
    *[(c, "fuera del dominio fijo", "", f"{c.lower()}_fuera") for c in R.FIXED_DOMAINS],
    ("AREA", "ausencia disfrazada", R.UNSPECIFIED_AREA, "sin_especificar"),
    ("AREA", "categoría por confirmar", f"{R.RURAL} en {CAPITAL}", "rural_capital"),
    ("STATUS", "categoría por confirmar", ", ".join(R.TEMPORARY_STATUS), "status_temporal"),
    ("JORNADA", "categoría con significado propio", R.NO_SHIFT, "sin_jornada"),
    ("PLAN", "categoría por confirmar", ", ".join(R.RARE_PLANS), "plan_raro"),
    ("PLAN", "categoría con significado propio", R.GENERIC_PLAN, "plan_generico"),
]


def defect_entries() -> list[tuple]:
    """The rows of the complete ledger, from the kinds of defects and their treatment."""
    rows = []
    for variable, kind, what, count in DEFECTS:
        category, cleaning, treatment = TREATMENTS[kind]
        rows.append((variable, f"{kind}: {what}" if what else kind, category, count, None, cleaning, treatment))
    return rows


FULL_LEDGER_COLUMNS = GEOGRAPHIC_LEDGER_COLUMNS
FULL_LEDGER = defect_entries()


def categorical_masks() -> dict[str, Column]:
    return {
        "sin_jornada": _t("JORNADA") == R.NO_SHIFT,
        "sin_especificar": _t("AREA") == R.UNSPECIFIED_AREA,
        "rural_capital": D.rural_en_capital(),
        "plan_generico": _t("PLAN") == R.GENERIC_PLAN,
        "plan_raro": _t("PLAN").isin(*R.RARE_PLANS),
        "status_temporal": _t("STATUS").isin(*R.TEMPORARY_STATUS),
        "formato_irregular": reduce(
            lambda a, b: a | b,
            [F.coalesce(F.col(c) != F.upper(_t(c)), F.lit(False)) for c in ("SECTOR", "STATUS", "MODALIDAD")],
        ),
    }


def resumen_calidad_categoricas(df: DataFrame) -> DataFrame:
    return ledger(df, CATEGORICAL_LEDGER_COLUMNS, CATEGORICAL_LEDGER, categorical_masks())


def problemas_geograficos(df: DataFrame) -> DataFrame:
    masks = {
        "distrito_vacio": is_blank(F.col("DISTRITO")),
        "distrito_incompleto": full_match(_t("DISTRITO"), INCOMPLETE_DISTRICT),
        "distrito_no_vacio": ~is_blank(F.col("DISTRITO")),
        "capital": _t("DEPARTAMENTO") == CAPITAL,
        "sin_tilde": _t("DEPARTAMENTO").isin(*R.ACCENTED_DEPARTMENTS),
        "departamental_distinta": consistency.differs(
            F.col("DEPARTAMENTO"), F.col("DEPARTAMENTAL")
        ),
    }
    scalars = {"municipios": distinct_scalar(df, F.nullif(_t("MUNICIPIO"), F.lit("")))}
    return ledger(df, GEOGRAPHIC_LEDGER_COLUMNS, GEOGRAPHIC_LEDGER, masks, scalars)


def merged_spellings(df: DataFrame, kept: dict[str, tuple[str, Column]]) -> DataFrame:
    """One row: per name of ``kept`` (column, condition) the spellings that would disappear if each
    folded key had one, that is distinct spellings minus distinct keys. One scan for all."""
    cells = F.array(
        *[
            F.when(condition, F.struct(F.lit(name).alias("de"), _t(column).alias("nombre")))
            for name, (column, condition) in kept.items()
        ]
    )
    spellings = df.select(F.explode_outer(F.array_compact(cells)).alias("c")).where("c IS NOT NULL").select("c.*").distinct()
    keys = spellings.groupBy("de", name_key(F.col("nombre")).alias("clave")).agg((F.count("*") - 1).alias("sobrantes"))
    return keys.agg(
        *[F.coalesce(F.sum(F.when(F.col("de") == name, F.col("sobrantes"))), F.lit(0)).alias(name) for name in kept]
    )


def libro_de_defectos(df: DataFrame) -> DataFrame:
    """The complete ledger: one fused count, and one more scan for the spellings."""
    absent = NAME_CLASSES[:4]
    prepared = df.withColumns(
        {
            "_dir": unaccented(_t("DIRECCION")),
            "_mun": unaccented(_t("MUNICIPIO")),
            "_nom": _t("ESTABLECIMIENTO"),
        }
    )
    address, municipality, name = F.col("_dir"), F.col("_mun"), F.col("_nom")
    masks = {
        **categorical_masks(),
        "telefono_vacio": is_blank(F.col("TELEFONO")),
        "telefono_no_estandar": is_nonstandard_phone(F.col("TELEFONO")),
        "nombre_tildes": found(name, R.WRITING_PATTERNS["tiene tildes"]),
        "nombre_comillas": found(name, R.WRITING_PATTERNS["comillas"]),
        "nombre_espacios": found(name, R.WRITING_PATTERNS["espacios multiples"]),
        "direccion_vacia": F.upper(_t("DIRECCION")).isin(*R.MISSING_MARKERS)
        | found(_t("DIRECCION"), R.ADDRESS_MARKERS["solo puntuacion"]),
        "direccion_municipio": (address != "") & (address == municipality),
        "direccion_contiene": (address != municipality)
        & consistency.contains_other(address, municipality),
        "direccion_fecha": found(address, R.CONTAMINATION["fecha incrustada"]),
        "direccion_letra_o": found(address, R.CONTAMINATION["letra O por cero"]),
        "supervisor_ausente": name_class(F.col("SUPERVISOR")).isin(*absent),
        "supervisor_raro": found(_t("SUPERVISOR"), R.ODD_NAME),
        "director_ausente": name_class(F.col("DIRECTOR")).isin(*absent),
        "director_titulo": found(_t("DIRECTOR"), r"\b(?:" + "|".join(R.TITLES) + r")\."),
        "nivel_no_vacio": ~is_blank(F.col("NIVEL")),
        **{
            f"{c.lower()}_fuera": (_t(c) != "") & ~_t(c).isin(*values)
            for c, values in R.FIXED_DOMAINS.items()
        },
    }
    extra = merged_spellings(
        df,
        {
            "nombre_variantes": ("ESTABLECIMIENTO", _t("ESTABLECIMIENTO") != ""),
            "supervisor_variantes": ("SUPERVISOR", ~name_class(F.col("SUPERVISOR")).isin(*absent)),
            "director_variantes": ("DIRECTOR", ~name_class(F.col("DIRECTOR")).isin(*absent)),
        },
    )
    return ledger(prepared, FULL_LEDGER_COLUMNS, FULL_LEDGER, masks, extra=extra)


def variables_por_limpiar(problems: DataFrame) -> DataFrame:
    """How many variables have at least one defect to clean, and defects listed."""
    return problems.agg(
        F.count("*").alias("defectos_registrados"),
        F.count_distinct(
            F.when(F.col("requiere_limpieza") == "Si", F.col("variable"))
        ).alias("variables_con_limpieza"),
    )


# The ten metrics of the quality report.
METRICS = [
    "Registros", "Variables originales", "Valores faltantes", "Variables con NA",
    "Duplicados exactos", "Posibles duplicados parciales",
    "Variables con formato inconsistente", "Variables con tipo incorrecto",
    "Categorías inconsistentes", "Errores corregidos",
]


def quality_metrics(df: DataFrame, name: str, corrections: Column | None = None) -> DataFrame:
    """The ten metrics of one table as (metrica, <name>) rows."""
    columns = R.SOURCE_COLUMNS
    present = [c for c in columns if c in df.columns]
    missing = [F.upper(_t(c)).isin(*R.MISSING_MARKERS) for c in present]
    uneven = [has_edge_space(F.col(c)) | has_inner_run(plain(F.col(c))) for c in present]
    scalars = df.agg(
        F.count("*").alias("registros"),
        F.coalesce(F.sum(reduce(add, [m.cast("long") for m in missing])), F.lit(0)).alias("faltantes"),
        reduce(add, [F.coalesce(F.max(m.cast("int")), F.lit(0)) for m in missing]).alias("con_na"),
        reduce(add, [F.coalesce(F.max(u.cast("int")), F.lit(0)) for u in uneven]).alias("formato"),
    )
    informative = df.where(~all_blank([F.col(c) for c in present]))
    values = [
        F.col("registros"),
        F.lit(len(present)),
        F.col("faltantes"),
        F.col("con_na"),
        duplicate_count(informative, present).select("filas_duplicadas").scalar(),
        D.variantes_establecimiento(df)
        .where("categoria = 'posible duplicado'")
        .agg(F.count("*").alias("n"))
        .scalar(),
        F.col("formato"),
        F.lit(len(wrong_types(df, columns))),
        equivalent_categories(df, R.CATEGORICAL_COLUMNS).agg(F.count("*").alias("n")).scalar(),
        F.lit(0) if corrections is None else corrections,
    ]
    rows = [
        F.struct(F.lit(m).alias("metrica"), v.cast("long").alias(name))
        for m, v in zip(METRICS, values)
    ]
    return scalars.select(F.inline(F.array(*rows)))


def informe_calidad(
    before: DataFrame, after: DataFrame, transformations: DataFrame | None = None
) -> DataFrame:
    """Before/after report; `transformations` is the log of changed rows."""
    corrections = None
    if transformations is not None:
        corrections = transformations.agg(
            F.coalesce(F.sum("filas_afectadas"), F.lit(0)).alias("n")
        ).scalar()
    # Ten rows on both sides.
    return quality_metrics(before, "antes").join(
        F.broadcast(quality_metrics(after, "despues", corrections)), "metrica"
    )


def geographic_bundle(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "resumen_variables": D.resumen_variables(df),
        "diagnostico_codigo": D.diagnostico_codigo(df),
        "diagnostico_distrito": D.diagnostico_distrito(df),
        "diagnostico_departamento": D.diagnostico_departamento(df),
        "diagnostico_municipio": D.diagnostico_municipio(df),
        "diagnostico_departamental": D.diagnostico_departamental(df),
        "problemas_geograficos": problemas_geograficos(df),
    }


def generar_reportes(df: DataFrame, path: str, bom: bool = True) -> list[str]:
    """Writes the seven geographic reports, one folder each; returns their paths.

    The seven reports read the same five columns, which are written once as
    Parquet below the shared scratch folder.
    """
    columns = [*R.GEOGRAPHIC_COLUMNS, *[c for c in R.LINEAGE if c in df.columns]]
    source = written(df.select(*columns), "reports-columns")
    paths = []
    for name, table in geographic_bundle(source).items():
        target = f"{path.rstrip('/')}/{name}"
        write_csv(table, target, bom=bom, single=True)
        paths.append(target)
    return paths
