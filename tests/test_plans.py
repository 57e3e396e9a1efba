"""Cleaning, validation and reports."""

import pytest
from pyspark.sql import functions as F

from tamiz.functions import text
from tamiz.functions.phone import split_numbers
from tamiz.operators import duplicates, skew
from tamiz.plans import cleaning as C
from tamiz.plans import diagnostics as D
from tamiz.plans import registry as R
from tamiz.plans import reports, validation
from tamiz.workload.messy import MESSY_CTE


@pytest.fixture(scope="module")
def cleaned(spark, messy, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clean") / "limpio")
    C.limpiar_datos(messy).write.parquet(path)
    return spark.read.parquet(path)


def one(spark, **cells):
    row = {c: cells.get(c, "x") for c in R.SOURCE_COLUMNS}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    return C.limpiar_datos(df).first()


@pytest.mark.parametrize(
    "cells, expected",
    [
        ({"DIRECCION": "12 AV. NORTE 22/02/20"}, "12 AV. NORTE"),
        ({"DIRECCION": "12 AV. NORTE 22/0209/02/20209"}, "12 AV. NORTE"),
        ({"DIRECCION": "4A. CALLE 3-50"}, "4A. CALLE 3-50"),
        ({"DIRECCION": "5A CALLE 1-2, COBÁN", "MUNICIPIO": "COBAN"}, "5A CALLE 1-2"),
        ({"DIRECCION": "ALDEA SAN JOSE", "MUNICIPIO": "SAN JOSE"}, "ALDEA SAN JOSE"),
        ({"DIRECCION": "COBAN", "MUNICIPIO": "COBÁN"}, None),
        ({"DIRECCION": "O AV. 0-06"}, "0 AV. 0-06"),
        ({"DIRECCION": "O-71"}, "0-71"),
        ({"DIRECCION": "OC-150"}, "0C-150"),
        ({"DIRECCION": "---"}, None),
        ({"DIRECCION": "s/d"}, None),
    ],
)
def test_addresses(spark, cells, expected):
    assert one(spark, **cells).DIRECCION == expected


def test_other_columns(spark):
    row = one(
        spark, DEPARTAMENTO="CIUDAD CAPITAL", MUNICIPIO="ZONA 7", DEPARTAMENTAL="PETEN",
        TELEFONO="2432-8801 / 5", SUPERVISOR="JUAN ACEVED0 ORTÌZ O´NELL,", DIRECTOR="LIC. ANA PEREZ",
        AREA="RURAL", DISTRITO="01-", ESTABLECIMIENTO='COLEGIO "CAÑAS"', DIRECCION="CANTON NORTE",
    )
    assert (row.DEPARTAMENTO, row.MUNICIPIO, row.ZONA_CAPITAL) == ("Guatemala", "Guatemala", "ZONA 7")
    assert row.DEPARTAMENTAL == "PETÉN" and row.TELEFONOS == ["24328801"]
    assert row.SUPERVISOR == "JUAN ACEVEDO ORTÍZ O'NELL"
    assert (row.DIRECTOR, row.DIRECTOR_TITULO) == ("ANA PEREZ", "LIC")
    assert row.AREA_REVISION == "con respaldo en DIRECCION" and row.DISTRITO_REVISAR
    assert row.ESTABLECIMIENTO_CLAVE == "COLEGIO CANAS" and not row.DIRECCION_SIN_NUMERO


def test_cleaning_twice_is_cleaning_once(cleaned):
    twice = C.limpiar_datos(cleaned)
    assert twice.columns == cleaned.columns
    assert cleaned.exceptAll(twice).count() == 0 and twice.count() == cleaned.count()


def test_log_counts_changed_rows(messy, cleaned):
    log = C.registro_transformaciones(messy).collect()
    key = R.LINEAGE
    pairs = messy.select(*key, F.col("AREA").alias("before")).join(
        cleaned.select(*key, F.col("AREA").alias("after")), key
    )
    changed = pairs.where(~F.col("before").eqNullSafe(F.col("after"))).count()
    assert sum(r.filas_afectadas for r in log if r.variable == "AREA") == changed
    assert {r.filas_afectadas for r in C.registro_transformaciones(cleaned).collect()} == {0}


def well_coded(df):
    """Unique codes whose prefix stands for one place."""
    places = sorted(tuple(r) for r in df.select("DEPARTAMENTO", "MUNICIPIO").distinct().collect())
    prefix = {place: f"{i // 100:02d}-{i % 100:02d}" for i, place in enumerate(places)}
    chain = F.lit(None)
    for (dep, mun), code in prefix.items():
        here = F.col("DEPARTAMENTO").eqNullSafe(F.lit(dep)) & F.col("MUNICIPIO").eqNullSafe(F.lit(mun))
        chain = F.when(here, code).otherwise(chain)
    number = F.col("fila_origen") * 23 + F.substring("archivo_origen", 2, 2).cast("long")
    ending = F.concat(F.lpad((number % 10_000).cast("string"), 4, "0"), F.lit("-"), F.lpad(F.expr("CAST(1 AS STRING)"), 2, "0"))
    return df.withColumn("CODIGO", F.concat(chain, F.lit("-"), ending))


def test_validation(messy, cleaned):
    report = {r.regla: r.violaciones for r in validation.reporte_validacion(cleaned).collect()}
    # The view has departments that are in no catalog, and codes that are malformed, repeated and of several places.
    assert {k for k, v in report.items() if v} == {"C2", "V4"}
    with pytest.raises(ValueError, match="V2"):
        validation.validar_datos(messy)
    official = well_coded(cleaned.where(F.col("DEPARTAMENTO").isin(*R.DEPARTMENTS.values())))
    assert validation.validar_datos(official) is None
    pairs = official.select(F.col("DEPARTAMENTO").alias("departamento"), F.col("MUNICIPIO").alias("municipio"))
    assert validation.validar_datos(official, pairs) is None
    with pytest.raises(ValueError, match="V4"):
        validation.validar_datos(official, pairs.where("municipio <> 'COBÁN'"))
    assert validation.violaciones(official, pairs).count() == 0


def test_types_are_checked(messy):
    before = {r.regla: r.violaciones for r in validation.reporte_validacion(messy).collect()}
    wrong = messy.withColumn("CODIGO", F.lit(1))
    report = {r.regla: r.violaciones for r in validation.reporte_validacion(wrong).collect()}
    assert report["V5"] == before["V5"] + 1


def registry_rows(spark, **cells):
    """Rows of the registry that break no rule but by the given cells; a list gives one cell a row."""
    good = dict.fromkeys(R.SOURCE_COLUMNS, "ABC") | {
        "DEPARTAMENTO": "Guatemala", "MUNICIPIO": "Mixco", "SUPERVISOR": "Ana Ruiz", "DIRECTOR": "Eva Paz",
        "DIRECCION": "1a calle 3-50", "TELEFONO": "24328801", "DISTRITO": "01-001",
    }
    n = max(len(v) for v in cells.values())
    rows = [
        {**good, "CODIGO": f"01-01-{i:04d}-46", **{k: v[i] for k, v in cells.items()}, "archivo_origen": "f.csv", "fila_origen": i}
        for i in range(n)
    ]
    types = ", ".join(f"{c} string" for c in [*R.SOURCE_COLUMNS, "archivo_origen"])
    return spark.createDataFrame([[r[c] for c in [*R.SOURCE_COLUMNS, *R.LINEAGE]] for r in rows], f"{types}, fila_origen long")


@pytest.mark.parametrize(
    "cells, want",
    [
        ({"TELEFONO": ["24328801, 123, 99", "24328801 Y 2432880", "123", None]}, [("V3", "TELEFONO", 0), ("V3", "TELEFONO", 2)]),
        ({"CODIGO": ["not a code", "01-01-0001-46", "01-01-0002-46", None]}, [("C2 formato", "CODIGO", 0)]),
        ({"CODIGO": ["01-01-0001-46", " 01-01-0001-46", "01-01-0002-46"]}, [("C2 unicidad", "CODIGO", 0), ("C2 unicidad", "CODIGO", 1), ("V2", "CODIGO", 1)]),
        (
            {"CODIGO": ["01-01-0001-46", "01-01-0002-46", "01-02-0003-46", "09-01-0001-46"], "MUNICIPIO": ["Mixco", "Petapa", "Mixco", "Amatitlán"]},
            [("C2 lugar", "CODIGO", 0), ("C2 lugar", "CODIGO", 1), ("C2 lugar", "CODIGO", 2)],
        ),
        ({"DIRECTOR": ["Eva Paz", "000000"], "NIVEL": ["1.5", "ABC"]}, [("V5", "DIRECTOR", 1), ("V5", "NIVEL", 0), ("V7", "DIRECTOR", 1)]),
        ({"TELEFONO": ["2.4328801E7", "24328801"]}, [("V3", "TELEFONO", 0), ("V5", "TELEFONO", 0)]),
        ({"SECTOR": ["Privado", "PRIVADO", "Oficial"]}, [("V6", "SECTOR", 0), ("V6", "SECTOR", 1)]),
        ({"DEPARTAMENTO": ["Guatemala", "Atlantis"], "CODIGO": ["01-01-0001-46", "02-01-0001-46"]}, [("V4", "DEPARTAMENTO", 1)]),
    ],
)
def test_rules_name_the_rows_that_break_them(spark, cells, want):
    df = registry_rows(spark, **cells)
    got = sorted((r.regla, r.columna, r.fila_origen) for r in validation.violaciones(df).collect())
    assert got == sorted(want)
    broken = {r.regla for r in validation.reporte_validacion(df).collect() if not r.cumple}
    assert broken == {rule.split()[0] for rule, _, _ in want}


def test_duplicates_and_unknown_places_are_listed(spark):
    df = registry_rows(spark, CODIGO=["01-01-0001-46"] * 2 + ["01-01-0002-46"])
    known = spark.createDataFrame([("Guatemala", "Petapa")], "departamento string, municipio string")
    got = sorted((r.regla, r.fila_origen) for r in validation.violaciones(df, known).collect())
    assert got == sorted([("V1", 0), ("V1", 1), ("C2 unicidad", 0), ("C2 unicidad", 1), ("V4", 0), ("V4", 1), ("V4", 2)])
    assert validation.violaciones(df.limit(0), known).count() == 0


@pytest.mark.parametrize("heavy_rows", [2, 10**6])
def test_supervisor_only_where_district_has_one_name(spark, monkeypatch, heavy_rows):
    monkeypatch.setattr(skew, "HEAVY_ROWS", heavy_rows)
    df = spark.createDataFrame(
        [("d1", "ANA PEREZ"), ("d1", ""), ("d1", "---"), ("d2", "ANA PEREZ"), ("d2", "EVA RUIZ"), ("d2", ""), ("", ""), ("d3", None)],
        "DISTRITO string, SUPERVISOR string",
    )
    got = sorted((r.DISTRITO, r.SUPERVISOR or "", r.SUPERVISOR_IMPUTADO) for r in C.imputar_supervisor(df).collect())
    assert got == [
        ("", "", False), ("d1", "ANA PEREZ", False), ("d1", "ANA PEREZ", True), ("d1", "ANA PEREZ", True),
        ("d2", "", False), ("d2", "ANA PEREZ", False), ("d2", "EVA RUIZ", False), ("d3", "", False),
    ]


@pytest.mark.parametrize("heavy_rows", [2, 10**6])
def test_merge_and_marks_keep_every_row(messy, monkeypatch, heavy_rows):
    monkeypatch.setattr(skew, "HEAVY_ROWS", heavy_rows)
    n = messy.count()
    merged = C.fusionar_escrituras(messy, "SUPERVISOR", "DEPARTAMENTAL")
    assert merged.count() == n
    left = merged.where("SUPERVISOR_FUSIONADO LIKE 'CARLOS%'").groupBy("DEPARTAMENTAL").agg(
        F.count_distinct("SUPERVISOR_FUSIONADO").alias("n")
    )
    assert {r.n for r in left.collect()} == {1}
    marks = C.marcar_duplicados(messy)
    assert marks.count() == n and marks.where("CONFIRMADO AND NOT CANDIDATO_DUPLICADO").count() == 0


def test_municipality_catalog_uses_both_columns(spark, messy):
    catalog = spark.createDataFrame([("PETEN", "SAN JOSE", "San José")], "departamento string, municipio string, oficial string")
    out = C.corregir_municipio(messy, catalog)
    fixed = out.where("MUNICIPIO = 'San José'")
    assert fixed.count() > 0 and fixed.where("trim(DEPARTAMENTO) <> 'PETEN'").count() == 0
    assert out.where("MUNICIPIO = 'SAN JOSE'").count() > 0 and out.count() == messy.count()


def test_ledger_rows_and_before_after(messy, cleaned):
    rows = reports.libro_de_defectos(messy).collect()
    assert len(rows) == len(reports.FULL_LEDGER) and all(r.cantidad is not None for r in rows)
    log = C.registro_transformaciones(messy)
    report = {r.metrica: (r.antes, r.despues) for r in reports.informe_calidad(messy, cleaned, log).collect()}
    assert list(sorted(report)) == sorted(reports.METRICS)
    assert report["Registros"] == (messy.count(), messy.count())
    assert report["Variables con formato inconsistente"][0] > report["Variables con formato inconsistente"][1] - 1


def test_ledgers_show_the_rows_given(messy):
    changed = messy.withColumn("SECTOR", F.when(F.col("CODIGO").isNotNull(), F.lit(" privado")))
    (formats,) = reports.resumen_calidad_categoricas(changed).where("variable LIKE 'SECTOR/%'").collect()
    assert formats.cantidad >= changed.where("SECTOR IS NOT NULL").count() > 0
    (outside,) = reports.libro_de_defectos(changed).where("variable = 'SECTOR'").collect()
    assert (outside.cantidad, outside.ejemplo) == (changed.where("SECTOR IS NOT NULL").count(), "privado")


def test_catalog_twins_do_not_multiply_rows(spark):
    catalog = spark.createDataFrame(
        [
            ("ALTA VERAPAZ", "COBAN", "COBÁN"),
            ("ALTA VERAPAZ", "COBÁN", "COBÁN"),
            ("PETEN", "FLORES", "FLORES"),
            ("PETÉN", "FLORES", "Flores"),
        ],
        "departamento string, municipio string, oficial string",
    )
    rows = spark.createDataFrame(
        [("Alta Verapaz", "coban"), ("PETEN", "FLORES")], "DEPARTAMENTO string, MUNICIPIO string"
    )
    got = sorted(tuple(r) for r in C.corregir_municipio(rows, catalog).collect())
    assert got == [("Alta Verapaz", "COBÁN", True), ("PETEN", "FLORES", False)]


def test_homonyms_and_blank_places_are_not_duplicates(spark):
    columns = ["ESTABLECIMIENTO", "DEPARTAMENTO", "MUNICIPIO", "JORNADA", "PLAN", "DIRECCION"]
    rows = [
        ("INEB", "PETEN", "LA LIBERTAD", "M", "D", "x"),
        ("INEB", "HUEHUETENANGO", "LA LIBERTAD", "M", "D", "x"),
        ("INEB", "IZABAL", "", "M", "D", "x"),
        ("INEB", "IZABAL", None, "M", "D", "x"),
        ("COLEGIO", "JALAPA", "JALAPA", "M", "D", "x"),
        ("Colegio.", " JALAPA ", "JALAPA", "M", "D", "x"),
        ("COLEGIO", "JALAPA", "JALAPA", "V", "D", "x"),
        (None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    got = [(r.CANDIDATO_DUPLICADO, r.CONFIRMADO) for r in C.marcar_duplicados(df).orderBy("ESTABLECIMIENTO", "JORNADA").collect()]
    assert len(got) == 8 and got.count((True, True)) == 2 and got.count((True, False)) == 1


def test_people_without_jurisdiction_are_not_merged(spark):
    rows = [("JOSÉ PÉREZ", ""), ("JOSE PEREZ", None), ("ANA LÓPEZ", "NORTE"), ("ANA LOPEZ", "NORTE")]
    df = spark.createDataFrame(rows, "SUPERVISOR string, DEPARTAMENTAL string")
    got = sorted(r.SUPERVISOR_FUSIONADO for r in C.fusionar_escrituras(df, "SUPERVISOR", "DEPARTAMENTAL").collect())
    assert got == ["ANA LÓPEZ", "ANA LÓPEZ", "JOSE PEREZ", "JOSÉ PÉREZ"]


@pytest.mark.parametrize(
    "build", [D.diagnostico_codigo, reports.libro_de_defectos], ids=["codes", "defects"]
)
def test_reports_read_the_table_at_most_twice(spark, small_dir, build):
    """One scan for counts by combination, one for what needs all values; the rest reads those exchanges."""
    orders = spark.read.parquet(f"{small_dir}/orders.parquet").select("o_orderkey")
    rows = spark.sql(f"WITH {MESSY_CTE} SELECT * FROM messy", orders=orders)
    plan = build(rows)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    scans = [line for line in plan.splitlines() if line.startswith("(") and ") Scan parquet" in line]
    assert 1 <= len(scans) <= 2


def test_truncated_names_are_flagged_not_merged(spark):
    names = [
        ("JOSÉ VASQUEZ", "N"), ("Jose Vasquez", "N"), ("JOSE VASQUEZ REYES", "N"), ("JOSE VASQUEZ", "S"), ("JOSE", "N"),
        ("ANA LUZ PEREZ", "N"), ("ANA LUZ", "N"), ("ANA LUZ RUIZ", "N"), ("JOSE VASQUEZREYES", "N"), ("JOSE VASQUEZ", ""), ("", "N"), (None, None),
    ]
    df = spark.createDataFrame(names, "SUPERVISOR string, DEPARTAMENTAL string")
    got = C.marcar_truncados(df, "SUPERVISOR", "DEPARTAMENTAL")
    assert got.drop("SUPERVISOR_TRUNCADO", "SUPERVISOR_COMPLETO").exceptAll(df).count() == 0 and got.count() == len(names)
    marked = {(r.SUPERVISOR, r.DEPARTAMENTAL): r.SUPERVISOR_COMPLETO for r in got.collect() if r.SUPERVISOR_TRUNCADO}
    assert marked == {("JOSÉ VASQUEZ", "N"): "JOSE VASQUEZ REYES", ("Jose Vasquez", "N"): "JOSE VASQUEZ REYES", ("ANA LUZ", "N"): None}
    assert C.marcar_truncados(df.limit(0), "SUPERVISOR", "DEPARTAMENTAL").count() == 0


ODD_CELLS = [
    None, "", " ", " ", "a", " a", "a ", "A b", "~x", "\x7fx", "É", "é ", "12", " 12 ", "+3", "-1,5e3", "1.0", "2E+5", "٣", "x1",
    "24328801", "2432880", "00000000", "0000000", "123456789", "24328801\n", "٢٤٣٢٨٨٠١", "24328801-02", "123", "24328801, 99", "s/d",
    "sın dato", "no aplica", "NO APLICA.", "N.A.", "n/a ", "ﬁ", "-",
]


def test_shortcuts_of_the_checks_change_nothing(spark):
    """What lets most cells skip the longer tests gives what those give alone."""
    df = spark.createDataFrame([(v, v, v) for v in ODD_CELLS], "TELEFONO string, CODIGO string, NIVEL string")
    pairs = [
        *[(text.has_edge_space(F.col(c)), text.plain(F.col(c)) != text.trimmed(F.col(c))) for c in df.columns],
        *[(validation.has_wrong_type(c), text.full_match(text.trimmed(F.col(c)), R.NUMBER if c == "NIVEL" else R.CAST_IDENTIFIER)) for c in ("CODIGO", "NIVEL")],
        (validation.has_marker("NIVEL"), F.coalesce(F.upper("NIVEL").isin(*R.MISSING_MARKERS), F.lit(False))),
        (
            validation.has_wrong_phone("TELEFONO"),
            (text.trimmed(F.col("TELEFONO")) != "")
            & ((F.size(split_numbers(F.col("TELEFONO"))) == 0) | F.exists(split_numbers(F.col("TELEFONO")), lambda n: ~F.length(n).isin(7, 8))),
        ),
    ]
    for row in df.select("NIVEL", F.array(*[a for a, _ in pairs]).alias("got"), F.array(*[b for _, b in pairs]).alias("want")).collect():
        assert row.got == row.want, row.NIVEL


@pytest.mark.parametrize("heavy_rows", [2, 10**6])
def test_frequent_categories_stay_where_they_are_read(spark, monkeypatch, heavy_rows):
    """Every spelling is listed for the join, so that cells without variants are known to be frequent too."""
    monkeypatch.setattr(skew, "HEAVY_ROWS", heavy_rows)
    df = registry_rows(spark, SECTOR=["OFICIAL", "oficial ", "OFICIAL", "PRIVADO", "PRIVADO", None, ""])
    listed = {(r.valor, r.cantidad, r.escrituras) for r in validation.category_spellings(df, ["SECTOR"]).collect()}
    assert listed == {("OFICIAL", 2, 2), ("oficial", 1, 2), ("PRIVADO", 2, 1)}
    got = sorted((r.fila_origen, r.valor) for r in validation.violaciones(df).where("regla = 'V6'").collect())
    assert got == [(0, "OFICIAL"), (1, "oficial"), (2, "OFICIAL")]


def test_rows_that_may_be_copies_are_written_once(spark, tmp_path):
    """The steps after the filter of fingerprints read its result, not the table again."""
    spark.createDataFrame([(i % 90, f"v{i % 90}") for i in range(100)], "k long, v string").write.parquet(f"{tmp_path}/t")
    found = duplicates.duplicate_rows(spark.read.parquet(f"{tmp_path}/t"), ["k", "v"], write=True)
    assert sorted((r.k, r.copias) for r in found.collect()) == sorted([(k, 2) for k in range(10)] * 2)
    assert not [f for f in found.inputFiles() if str(tmp_path) in f]
