"""Registered queries of the sources and sinks, and their SQL: files are written, read back through the guards and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.plans import cleaning as C
from tamiz.plans import registry as R
from tamiz.plans import reports
from tamiz.session import scratch_dir
from tamiz.sources import csv_union
from tamiz.sources.sinks import write_csv
from tamiz.workload.messy import messy, messy_oracle
from tamiz.workload.oracles import CLEAN_TABLE, INGEST, ORACLES, q, union

ORIGIN, RECORD = R.LINEAGE


def by_origin(df: DataFrame, folder: str) -> str:
    """Writes ``df`` as one CSV file for each origin; returns where they are."""
    placed = df.withColumn("carpeta", F.col(ORIGIN)).repartition("carpeta").sortWithinPartitions("carpeta", RECORD)
    write_csv(placed.drop(*R.LINEAGE), folder, folders=("carpeta",))
    return f"{folder}/*"


FILES = 5


def csv_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed number of files, named apart; all six figures."""
    rows, folder = messy(spark, sf_dir), f"{scratch_dir(spark, 'tamiz-csv')}/datos"
    for i in range(FILES):
        own = rows.where(F.substring(ORIGIN, 2, 2).cast("int") % FILES == i)
        write_csv(own.drop(*R.LINEAGE), f"{folder}/{i}", single=True)
    return csv_union.ingest_summary(csv_union.read_union(spark, f"{folder}/*", expected_files=FILES))


def differing_files(spark: SparkSession, sf_dir: str) -> str:
    """Files of even origins have all columns, those of odd ones lack PLAN and begin with SECTOR."""
    rows, folder = messy(spark, sf_dir), scratch_dir(spark, "tamiz-csv")
    odd = F.substring(ORIGIN, 2, 2).cast("int") % 2 == 1
    by_origin(rows.where(~odd), f"{folder}/datos/a")
    others = ["SECTOR", *[c for c in R.SOURCE_COLUMNS if c not in ("SECTOR", "PLAN")]]
    by_origin(rows.where(odd).select(*others, *R.LINEAGE), f"{folder}/datos/b")
    return f"{folder}/datos/*/*"


def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with two headers, united by name: a column that a file lacks is null."""
    back = csv_union.read_by_name(spark, differing_files(spark, sf_dir), lineage=False)
    return back.groupBy(*R.SOURCE_COLUMNS).agg(F.count("*").alias("copias"))


def csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on headers: files by their columns and whether those are the first file's."""
    found = csv_union.header_report(spark, differing_files(spark, sf_dir))
    return found.groupBy(F.array_join("columnas", ",").alias("columnas"), "esquema_consistente").agg(
        F.count("*").alias("archivos")
    )


CELLS = ["CODIGO", "TELEFONO", "SECTOR"]


def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some have a cell too few or too many: the report lists those, whole."""
    rows, folder = messy(spark, sf_dir), f"{scratch_dir(spark, 'tamiz-csv')}/datos"
    cells = F.concat_ws(",", *CELLS)
    line = (
        F.when(F.col(RECORD) % 7 == 0, F.concat_ws(",", *CELLS[:2]))
        .when(F.col(RECORD) % 11 == 0, F.concat(cells, F.lit(",de más")))
        .otherwise(cells)
    )
    lines = rows.select(ORIGIN, RECORD, line.alias("value"))
    header = lines.select(ORIGIN).distinct().select(ORIGIN, F.lit(0).cast("long").alias(RECORD), F.lit(",".join(CELLS)).alias("value"))
    placed = header.unionByName(lines).repartition(ORIGIN).sortWithinPartitions(ORIGIN, RECORD)
    placed.select("value", ORIGIN).write.partitionBy(ORIGIN).option("compression", "none").text(folder)
    found = csv_union.malformed_records(spark, f"{folder}/*", CELLS, glob="*")
    kept = [F.coalesce("CODIGO", F.lit("")).alias("CODIGO"), F.col("_corrupt_record").alias("registro")]
    return found.groupBy(*kept).agg(F.count("*").alias("copias"))


def csv_text_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The all-text loader: blanks stay blank, markers such as SIN DATO stay words."""
    folder = f"{scratch_dir(spark, 'tamiz-csv')}/datos"
    write_csv(messy(spark, sf_dir).drop(*R.LINEAGE), folder)
    back = csv_union.load_text(spark, folder, required=R.SOURCE_COLUMNS)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("valor")) for c in R.SOURCE_COLUMNS]))
    return back.select(cells.alias("c")).groupBy("c.variable", "c.valor").agg(F.count("*").alias("celdas"))


def clean_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table as CSV, read back."""
    folder = f"{scratch_dir(spark, 'tamiz-csv')}/limpio"
    write_csv(C.limpiar_datos(messy(spark, sf_dir)), folder)
    return csv_union.load_text(spark, folder, required=[*R.SOURCE_COLUMNS, *R.LINEAGE])


def csv_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each guard says about files that it must refuse, as rows."""
    rows, folder = messy(spark, sf_dir), scratch_dir(spark, "tamiz-csv")
    good = by_origin(rows, f"{folder}/buenos")
    differing = differing_files(spark, sf_dir)

    def refused(guard: str, action) -> tuple[str, str]:
        try:
            action()
        except Exception as error:  # noqa: BLE001  the error is the result
            text = str(error)
            return guard, text if type(error) in (ValueError, FileNotFoundError) else "error de lectura"
        return guard, "aceptado"

    def whole(path: str) -> None:
        csv_union.read_union(spark, path).write.format("noop").mode("overwrite").save()

    said = [
        refused("numero de archivos", lambda: csv_union.read_union(spark, good, expected_files=R.EXPECTED_FILES + 1)),
        refused("encabezado distinto", lambda: whole(differing)),
        refused("archivos iguales", lambda: whole(good)),
        refused("variables requeridas", lambda: csv_union.load_text(spark, good, required=["CODIGO", "NOTA", "OTRA"])),
        refused("ruta ausente", lambda: csv_union.load_text(spark, f"{folder}/nada")),
    ]
    found = spark.createDataFrame([(g, m.replace(folder, "")) for g, m in said], "guarda string, mensaje string")
    return found.withColumn("archivos", F.lit(csv_union.header_report(spark, good).count()))


def report_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven geographic reports, written and read back as text."""
    folder = scratch_dir(spark, "tamiz-reports")
    parts = []
    for path in reports.generar_reportes(messy(spark, sf_dir), folder):
        back = csv_union.load_text(spark, path)
        cells = F.concat_ws("|", *[F.col(f"`{c}`") for c in sorted(back.columns)])
        parts.append(back.select(F.lit(path.rsplit("/", 1)[1]).alias("reporte"), cells.alias("fila")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


INGEST_QUERIES = {
    "csv_ingest_summary": csv_ingest_summary,
    "csv_by_name": csv_by_name,
    "csv_headers": csv_headers,
    "csv_malformed": csv_malformed,
    "csv_text_cells": csv_text_cells,
    "csv_guards": csv_guards,
    "clean_csv": clean_csv,
    "report_bundle": report_bundle,
}

_COLUMNS = ", ".join(R.SOURCE_COLUMNS)
_ODD = "CAST(substr(archivo_origen, 2, 2) AS INT) % 2 = 1"
_LACKING = ["SECTOR", *[c for c in R.SOURCE_COLUMNS if c not in ("SECTOR", "PLAN")]]
_CELLS = "CODIGO || ',' || TELEFONO || ',' || SECTOR"
_LINE = f"""CASE WHEN fila_origen % 7 = 0 THEN CODIGO || ',' || TELEFONO WHEN fila_origen % 11 = 0 THEN {_CELLS} || ',de más'
  ELSE {_CELLS} END"""
# A number of the telephone cell or a comma in one counts as cells do.
_WIDTH = "len(string_split(linea, ','))"
_FILES = "(SELECT count(DISTINCT archivo_origen) FROM messy)"


def _report_sql(name: str, source: str, columns: list[str]) -> str:
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in sorted(columns))
    return f"SELECT {q(name)} AS reporte, concat_ws('|', {cells}) AS fila FROM ({source})"


def _body(name: str) -> str:
    """The SQL of a registered query without the view that it starts from."""
    return ORACLES[name][len(messy_oracle("")) :]


_CHECKS = ["revision", "cantidad", "detalle"]
_BUNDLE = [
    ("resumen_variables", "column_profile_registry", [
        "variable", "tipo_leido", "registros", "faltantes", "porcentaje_faltantes", "valores_unicos_no_vacios",
        "espacios_inicio_fin", "espacios_multiples",
    ]),
    ("diagnostico_codigo", "fd_violations_registry", ["revision", "cantidad", "resultado"]),
    ("diagnostico_distrito", "code_format_classes", ["categoria", "cantidad", "porcentaje", "ejemplos"]),
    ("diagnostico_departamento", "department_checks", _CHECKS),
    ("diagnostico_municipio", "municipality_checks", _CHECKS),
    ("diagnostico_departamental", "pair_relation_classes", [
        "relacion", "cantidad", "porcentaje", "categorias_departamentales",
    ]),
    ("problemas_geograficos", "geographic_ledger", reports.GEOGRAPHIC_LEDGER_COLUMNS),
]
_CLEAN_COLUMNS = [*R.SOURCE_COLUMNS, *C.DERIVED_COLUMNS, *R.LINEAGE]

INGEST_ORACLES = {
    "csv_ingest_summary": messy_oracle(
        INGEST + f"\nUNION ALL SELECT 'Archivos unidos', count(DISTINCT CAST(substr(archivo_origen, 2, 2) AS INT) % {FILES}) FROM messy"
    ),
    "csv_by_name": messy_oracle(f"""
SELECT {_COLUMNS}, count(*) AS copias FROM (SELECT * REPLACE (CASE WHEN {_ODD} THEN NULL ELSE PLAN END AS PLAN) FROM messy)
GROUP BY {_COLUMNS}"""),
    "csv_headers": messy_oracle(f"""
SELECT CASE WHEN odd THEN {q(",".join(_LACKING))} ELSE {q(",".join(R.SOURCE_COLUMNS))} END AS columnas,
  NOT odd AS esquema_consistente, count(*) AS archivos
FROM (SELECT DISTINCT archivo_origen, {_ODD} AS odd FROM messy) GROUP BY odd"""),
    "csv_malformed": messy_oracle(f"""
SELECT CODIGO, linea AS registro, count(*) AS copias FROM (SELECT CODIGO, {_LINE} AS linea FROM messy)
WHERE {_WIDTH} <> 3 GROUP BY 1, 2"""),
    "csv_text_cells": messy_oracle(union([
        f"SELECT {q(c)} AS variable, {c} AS valor, count(*) AS celdas FROM messy GROUP BY 2" for c in R.SOURCE_COLUMNS
    ])),
    "csv_guards": messy_oracle(f"""
SELECT guarda, replace(mensaje, '#', CAST({_FILES} AS VARCHAR)) AS mensaje, {_FILES} AS archivos FROM (VALUES
  ('numero de archivos', 'Se esperaban {R.EXPECTED_FILES + 1} archivos CSV y se encontraron #.'),
  ('encabezado distinto', 'error de lectura'),
  ('archivos iguales', 'aceptado'),
  ('variables requeridas', 'Faltan variables requeridas: NOTA, OTRA'),
  ('ruta ausente', 'No existe /nada.')) AS v(guarda, mensaje)"""),
    "clean_csv": messy_oracle(
        CLEAN_TABLE + "SELECT " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in _CLEAN_COLUMNS) + " FROM clean"
    ),
    "report_bundle": messy_oracle(union([_report_sql(name, _body(query), columns) for name, query, columns in _BUNDLE])),
}
