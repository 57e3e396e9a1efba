"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.codes import (
    code_prefix,
    district_class,
    is_name,
    name_class,
    region_relation,
)
from tamiz.functions.phone import phone_class, split_numbers
from tamiz.functions.text import (
    comparison_key,
    name_key,
    trimmed,
    unaccented,
    words_with_letter,
)
from tamiz.operators import consistency, duplicates, frequency, patterns, profile, similarity, variants
from tamiz.plans import cleaning as C
from tamiz.plans import diagnostics as D
from tamiz.plans import registry as R
from tamiz.plans import reports, validation
from tamiz.session import scratch_dir, written
from tamiz.sources import csv_union
from tamiz.sources.sinks import write_csv
from tamiz.workload.messy import messy, spread

Query = Callable[[SparkSession, str], DataFrame]
KEY = ["archivo_origen", "fila_origen"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def on_messy(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(messy(spark, sf_dir))


# Primary keys, by which a small table is spread over the cores.
PRIMARY_KEYS = {
    "documents": ["doc_id"],
    "conversations": ["conv_id", "turn"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "part": ["p_partkey"],
}


def on_table(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(
        spread(table(spark, sf_dir, name), *PRIMARY_KEYS[name])
    )


def joined(df: DataFrame, column: str, separator: str = " | ") -> DataFrame:
    """A list column as one text, for comparison across engines."""
    return df.withColumn(column, F.array_join(column, separator))


def c(name: str) -> Column:
    return F.col(name)


# --- ingest ------------------------------------------------------------------------

def record_lineage(spark, sf_dir):
    """Record numbers of a file scan; the scan's splits are numbered in parallel."""
    scan = table(spark, sf_dir, "orders").select("o_orderkey")
    return csv_union.number_records(scan)


def csv_round_trip(spark, sf_dir):
    """Write the registry as many CSV files, read them back through the guards."""
    folder = scratch_dir(spark, "tamiz-csv")
    source = messy(spark, sf_dir).drop(*KEY)
    write_csv(source, f"{folder}/datos")
    back = csv_union.read_union(spark, f"{folder}/datos", columns=R.SOURCE_COLUMNS)
    return back.groupBy(*R.SOURCE_COLUMNS).agg(F.count("*").alias("copias"))


def csv_lineage(spark, sf_dir):
    """One CSV file per origin, written in record order; records are numbered when read back."""
    folder = scratch_dir(spark, "tamiz-csv")
    source = messy(spark, sf_dir).withColumnRenamed("archivo_origen", "origen")
    ordered = (
        source.withColumn("carpeta", c("origen"))
        .repartition("carpeta")
        .sortWithinPartitions("carpeta", "fila_origen")
    )
    write_csv(ordered.drop("fila_origen"), f"{folder}/datos", folders=("carpeta",))
    back = csv_union.read_union(spark, f"{folder}/datos/*", expected_files=R.EXPECTED_FILES)
    return back.select("origen", "CODIGO", "TELEFONO", "fila_origen")


# --- text --------------------------------------------------------------------------

def fold_keys(df):
    text = trimmed(c("text"))
    return df.select(
        "doc_id",
        unaccented(text).alias("sin_tildes"),
        comparison_key(text).alias("clave_comparacion"),
        name_key(text).alias("clave_nombre"),
        words_with_letter(text).cast("long").alias("palabras"),
    )


def phone_parse(df):
    parsed = df.select(*KEY, "TELEFONO", split_numbers(c("TELEFONO")).alias("numeros"))
    return joined(
        parsed.withColumn("clase", phone_class(c("TELEFONO"), c("numeros"))), "numeros"
    )


def phone_parse_documents(df):
    """Whole document texts taken as phone cells."""
    parsed = df.select("doc_id", split_numbers(c("text")).alias("numeros"))
    return joined(
        parsed.withColumn("cantidad", F.size("numeros").cast("long")), "numeros"
    )


def row_classes(df):
    """Every row-level classifier, map-only."""
    return df.select(
        *KEY,
        district_class(c("DISTRITO")).alias("distrito"),
        region_relation(c("DEPARTAMENTO"), c("DEPARTAMENTAL")).alias("relacion"),
        name_class(c("DIRECTOR")).alias("director"),
        name_class(c("SUPERVISOR")).alias("supervisor"),
        code_prefix(c("CODIGO")).alias("prefijo"),
    )


def documents_first_examples(df):
    flagged = df.select(
        "doc_id", trimmed(c("text")).alias("texto"), F.array("source").alias("etiquetas")
    )
    return patterns.first_examples(
        flagged, c("etiquetas"), c("texto"), ["doc_id"], 3, name="source",
    )


def part_spellings(df):
    written = (
        F.when(c("p_partkey") % 3 == 0, F.upper("p_name"))
        .when(c("p_partkey") % 3 == 1, F.concat("p_name", F.lit(".")))
        .otherwise(c("p_name"))
    )
    groups = variants.spelling_groups(
        df, written, {"marcas": c("p_brand"), "tipos": c("p_type")}
    )
    return joined(groups, "formas")


def near_part_names(df):
    """Part names with a size digit appended, within one edit, per type."""
    name = F.concat_ws(" ", "p_name", c("p_size").cast("string"))
    return variants.near_pairs(df, name, c("p_type")).withColumn(
        "distancia", c("distancia").cast("long")
    )


def event_dependencies(df):
    return consistency.dependency_violations(
        df, {"user_id": c("user_id")}, {"event_type": c("event_type"), "props": c("props")}
    )


def outside_nation(spark, sf_dir):
    return frequency.outside_catalog(
        messy(spark, sf_dir), "DEPARTAMENTO", table(spark, sf_dir, "nation"), "n_name",
        special=["CIUDAD CAPITAL"],
    )


# --- cleaning ----------------------------------------------------------------------

# A catalog of official spellings for the municipalities of the registry view,
# with a pair written twice and one whose official spellings differ.
CATALOG = [
    ("PETEN", "LA LIBERTAD", "La Libertad"),
    ("PETEN", "SAN JOSE", "San José"),
    ("QUICHE", "COBAN", "Cobán"),
    ("IZABAL", "COBAN", "Cobán"),
    ("SOLOLA", "CHISEC", "Chisec"),
    ("JALAPA", "SANTA BARBARA", "Santa Bárbara"),
    ("QUICHÉ", "COBÁN", "Cobán"),
    ("PETEN", "CHISEC", "Chisec"),
    ("PETÉN", "CHISEC", "CHISEC"),
]
CATALOG_SCHEMA = "departamento string, municipio string, oficial string"


def clean_rows(df):
    return joined(C.limpiar_datos(df), "TELEFONOS")


def municipality_spelling(spark, sf_dir):
    catalog = spark.createDataFrame(CATALOG, CATALOG_SCHEMA)
    return C.corregir_municipio(messy(spark, sf_dir), catalog).select(
        *KEY, "DEPARTAMENTO", "MUNICIPIO", "MUNICIPIO_EN_CATALOGO"
    )


def supervisor_imputed(df):
    """Districts of their own supervisors, so that some have exactly one name."""
    district = F.concat_ws("-", "DISTRITO", F.substring("CODIGO", 9, 2))
    shaped = df.withColumn("DISTRITO", F.when(c("DISTRITO") != "", district).otherwise(""))
    return C.imputar_supervisor(shaped).select(
        *KEY, "DISTRITO", "SUPERVISOR", "SUPERVISOR_IMPUTADO"
    )


def shortened(df):
    """Every third supervisor has lost the last word of the name."""
    cut = F.regexp_replace(trimmed(c("SUPERVISOR")), r" [^ ]*$", "")
    return df.withColumn("SUPERVISOR", F.when(c("fila_origen") % 3 == 0, cut).otherwise(c("SUPERVISOR")))


def written_clean(spark, df):
    """The cleaned table, written once; the checks then scan it several times."""
    path = f"{scratch_dir(spark, 'tamiz-clean')}/limpio"
    C.limpiar_datos(df).write.parquet(path)
    return spark.read.parquet(path)


def validation_after(spark, sf_dir):
    return validation.reporte_validacion(written_clean(spark, messy(spark, sf_dir)))


def validation_of_places(spark, sf_dir):
    """The rules with the check of department and municipality together."""
    return validation.reporte_validacion(
        messy(spark, sf_dir), spark.createDataFrame(CATALOG, CATALOG_SCHEMA)
    )


def violations(spark, sf_dir):
    """Every rule is broken: some sectors in lower case and copies of some rows as well."""
    rows = messy(spark, sf_dir)
    lower = F.when(c("fila_origen") % 9 == 0, F.lower("SECTOR")).otherwise(c("SECTOR"))
    dirty = rows.withColumn("SECTOR", lower).unionByName(rows.where("fila_origen % 40 = 0"))
    return validation.violaciones(written(dirty, "tamiz-dirty"), spark.createDataFrame(CATALOG, CATALOG_SCHEMA))


def validate_raw(spark, sf_dir):
    return validation.reporte_validacion(written(messy(spark, sf_dir), "tamiz-raw"))


def before_after(spark, sf_dir):
    raw = written(messy(spark, sf_dir), "tamiz-raw")
    marked = written(C.limpiar_datos(raw, marks=True), "tamiz-clean")
    clean = marked.select([n for n in marked.columns if not n.startswith("_cambio")])
    return reports.informe_calidad(raw, clean, C.registro_transformaciones(raw, marked))


QUERIES: dict[str, Query] = {
    # profile
    "column_profile_documents": on_table(
        "documents", lambda d: profile.column_profile(d, ["text", "lang", "source"])
    ),
    "column_profile_conversations": on_table(
        "conversations", lambda d: profile.column_profile(d, ["role", "text"])
    ),
    "column_profile_registry": on_messy(D.resumen_variables),
    "missing_markers": on_messy(D.tabla_faltantes),
    "unique_values": on_table("orders", lambda d: profile.unique_values(d, d.columns)),
    "unique_values_registry": on_messy(D.tabla_unicos),
    "format_flags_registry": on_messy(D.tabla_formatos),
    "format_flags_documents": on_table(
        "documents",
        lambda d: profile.format_table(d, ["text", "lang", "source"], only_findings=False),
    ),
    "blank_rows_dimension": on_messy(D.resumen_dimension),
    "phone_summary": on_messy(D.resumen_telefono),
    "constant_columns": on_messy(lambda d: profile.constant_columns(d, R.CATEGORICAL_COLUMNS)),
    # frequency
    "value_frequency_events": on_table(
        "events", lambda d: frequency.value_frequency(d, ["event_type"])
    ),
    "value_frequency_orders": on_table(
        "orders", lambda d: frequency.value_frequency(d, ["o_orderpriority", "o_orderstatus"])
    ),
    "domain_listing": on_messy(D.dominios),
    "minority_category_registry": on_messy(D.inventario_categorias),
    "minority_category_lineitem": on_table(
        "lineitem",
        lambda d: frequency.category_inventory(d, ["l_returnflag", "l_linestatus"]),
    ),
    "conditional_frequency": on_table(
        "lineitem",
        lambda d: frequency.conditional_frequency(d, c("l_returnflag") == "R", "l_linestatus"),
    ),
    "shift_by_plan": on_messy(D.jornada_sin_jornada),
    "generic_plan_by_sector": on_messy(D.plan_jerarquia_ambigua),
    "rare_categories": on_messy(
        lambda d: frequency.rare_categories(d, R.CATEGORICAL_COLUMNS, 1500)
    ),
    "domain_check": on_messy(
        lambda d: frequency.outside_domain(
            d, {**R.FIXED_DOMAINS, "AREA": ["URBANA", "RURAL"], "STATUS": ["ABIERTA", "CERRADA"]}
        )
    ),
    "catalog_check": outside_nation,
    # duplicates
    "exact_duplicates_documents": on_table(
        "documents",
        lambda d: duplicates.duplicate_rows(d.select("doc_id", "text", "lang"), ["text", "lang"])
        .select("doc_id", "copias"),
    ),
    "exact_duplicates_registry": on_messy(D.duplicados_exactos),
    "exact_duplicates_heavy": on_table(
        "lineitem",
        lambda d: duplicates.duplicate_rows(
            d.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"),
            ["l_returnflag", "l_quantity"], heavy_rows=500,
        ),
    ),
    "exact_duplicate_count": on_table(
        "documents", lambda d: duplicates.duplicate_count(d, ["text", "lang"])
    ),
    "surplus_duplicates": on_table(
        "documents",
        lambda d: d.agg(
            duplicates.surplus_count(c("text")).alias("sobrantes_text"),
        ),
    ),
    "repeated_codes": on_messy(lambda d: duplicates.repeats_after_first(d, "CODIGO")),
    # patterns
    "writing_patterns_documents": on_table(
        "documents",
        lambda d: D.inventario_escritura(d, "text", ["doc_id"]),
    ),
    "writing_patterns_registry": on_messy(
        lambda d: D.inventario_escritura(d, "ESTABLECIMIENTO")
    ),
    "address_markers": on_messy(D.marcadores_direccion),
    "address_redundancy": on_messy(D.direccion_redundante),
    "contamination": on_messy(D.direccion_contaminada),
    "first_examples_documents": on_table("documents", documents_first_examples),
    # classes
    "row_classes": on_messy(row_classes),
    "phone_parse": on_messy(phone_parse),
    "phone_parse_documents": on_table("documents", phone_parse_documents),
    "phone_detail": on_messy(lambda d: joined(D.telefonos_no_estandar(d), "numeros_recuperados")),
    "phone_classes": on_messy(D.categorias_telefono),
    "phone_rows": on_messy(
        lambda d: C.telefonos_por_fila(d, KEY).withColumn("posicion", c("posicion").cast("long"))
    ),
    "name_absence_director": on_messy(lambda d: D.nombres_ausentes(d, "DIRECTOR")),
    "name_absence_supervisor": on_messy(lambda d: D.nombres_ausentes(d, "SUPERVISOR")),
    "code_format_classes": on_messy(D.diagnostico_distrito),
    "pair_relation_classes": on_messy(D.diagnostico_departamental),
    "fold_keys": on_table("documents", fold_keys),
    # variants
    "entity_variants": on_messy(lambda d: joined(D.variantes_establecimiento(d), "formas")),
    "name_variants_supervisor": on_messy(
        lambda d: joined(D.variantes_nombre(d, "SUPERVISOR", "DEPARTAMENTAL"), "formas")
    ),
    "name_variants_director": on_messy(
        lambda d: joined(D.variantes_nombre(d, "DIRECTOR", "DEPARTAMENTAL"), "formas")
    ),
    "spelling_forms": on_messy(
        lambda d: variants.spelling_forms(
            d, trimmed(c("ESTABLECIMIENTO")), trimmed(c("ESTABLECIMIENTO")) != ""
        )
    ),
    "spelling_groups_part": on_table("part", part_spellings),
    "fuzzy_pairs": on_table("part", near_part_names),
    "similar_pairs": lambda spark, sf_dir: similarity.similar_pairs(
        table(spark, sf_dir, "documents"), "doc_id", "text"
    ),
    "similar_texts": lambda spark, sf_dir: similarity.similar_texts(
        table(spark, sf_dir, "documents"), "doc_id", "text"
    ),
    # consistency
    "fd_violations_registry": on_messy(D.diagnostico_codigo),
    "fd_violations_events": on_table("events", event_dependencies),
    "department_checks": on_messy(D.diagnostico_departamento),
    "municipality_checks": on_messy(D.diagnostico_municipio),
    "homonyms": on_table(
        "part", lambda d: consistency.homonyms(d, c("p_name"), c("p_brand"))
    ),
    "distinct_pairs": on_table(
        "part", lambda d: consistency.distinct_pairs(d, c("p_name"), c("p_brand"))
    ),
    "unspecified_area": on_messy(D.area_sin_especificar),
    "rural_in_capital": on_messy(D.area_contradice_departamento),
    # ledgers
    "categorical_ledger": on_messy(reports.resumen_calidad_categoricas),
    "geographic_ledger": on_messy(reports.problemas_geograficos),
    "defect_ledger": on_messy(reports.libro_de_defectos),
    "ledger_variables": on_messy(
        lambda d: reports.variables_por_limpiar(reports.libro_de_defectos(d))
    ),
    # ingest
    "record_lineage": record_lineage,
    "file_profile": on_messy(csv_union.file_profile),
    "ingest_summary": on_messy(csv_union.ingest_summary),
    "csv_round_trip": csv_round_trip,
    "csv_lineage": csv_lineage,
    # cleaning, validation, reports
    "clean_rows": on_messy(clean_rows),
    "transformation_log": on_messy(C.registro_transformaciones),
    "clean_municipality": municipality_spelling,
    "clean_supervisor": on_messy(supervisor_imputed),
    "clean_person_merge": on_messy(
        lambda d: C.fusionar_escrituras(d, "DIRECTOR", "DEPARTAMENTAL").select(
            *KEY, "DIRECTOR", "DIRECTOR_FUSIONADO"
        )
    ),
    "truncated_names": on_messy(
        lambda d: variants.truncated_names(
            shortened(d), c("SUPERVISOR"), c("DEPARTAMENTAL"), is_name(c("SUPERVISOR"))
        )
    ),
    "clean_truncated_marks": on_messy(
        lambda d: C.marcar_truncados(shortened(d), "SUPERVISOR", "DEPARTAMENTAL").select(
            *KEY, "SUPERVISOR", "SUPERVISOR_TRUNCADO", "SUPERVISOR_COMPLETO"
        )
    ),
    "clean_duplicate_marks": on_messy(
        lambda d: C.marcar_duplicados(d).select(*KEY, "CANDIDATO_DUPLICADO", "CONFIRMADO")
    ),
    "validate_raw": validate_raw,
    "violations": violations,
    "validate_places": validation_of_places,
    "validate_clean": validation_after,
    "before_after": before_after,
}
