"""Operators against brute force on small fixtures, hot keys included."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tamiz.operators import consistency, duplicates, frequency, patterns, profile, skew, variants
from tamiz.operators.distinct import distinct_counts, distinct_counts_by
from tamiz.plans import diagnostics as D
from tamiz.plans import registry as R


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows are copies of one row."""
    return spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.when(F.col("id") % 7 == 0, None).otherwise("v").alias("v"),
    )


def expected_copies(rows):
    count = Counter((r.k, r.v or "") for r in rows)
    return {r.id: count[(r.k, r.v or "")] for r in rows if count[(r.k, r.v or "")] > 1}


@pytest.mark.parametrize("heavy_rows", [2, 100, None])
def test_duplicate_rows_same_with_and_without_heavy_keys(skewed, heavy_rows):
    got = duplicates.duplicate_rows(skewed, ["k", "v"], heavy_rows=heavy_rows).collect()
    assert {r.id: r.copias for r in got} == expected_copies(skewed.collect())
    assert len(got) == len({r.id for r in got})


def test_heavy_keys_limit_does_not_lose_rows(skewed, monkeypatch):
    monkeypatch.setattr(duplicates, "HEAVY_KEYS", 1)
    got = duplicates.duplicate_rows(skewed, ["k", "v"], heavy_rows=2).collect()
    assert {r.id: r.copias for r in got} == expected_copies(skewed.collect())


@pytest.mark.parametrize("heavy_rows", [2, 10**6])
def test_left_join_per_key_keeps_unmatched_rows(skewed, heavy_rows):
    per_key = skewed.groupBy("k").agg(F.count("*").alias("n")).where("k <> '1'")
    got = skew.join_per_key(skewed, per_key, ["k"], "n", "left", heavy_rows).collect()
    want = Counter(r.k for r in skewed.collect())
    assert len(got) == 900
    assert all(r.n == (None if r.k == "1" else want[r.k]) for r in got)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("heavy_rows", [2, 100, None])
def test_lookup_join_with_frequent_keys(skewed, how, heavy_rows):
    """A third of the rows have one key; that key, others and null keys may be missing in the table."""
    rows = skewed.withColumn("k", F.when(F.col("id") % 11 != 0, F.col("k")))
    for absent in ("1", "hot"):
        lookup = rows.select("k").distinct().where(F.col("k") != absent).withColumn("name", F.concat(F.lit("n-"), "k"))
        got = skew.join_lookup(rows, lookup, ["k"], how, heavy_rows)
        assert got.columns == ["k", "id", "v", "name"]
        found = {r.id: r.name for r in got.collect()}
        known = {r.id: None if r.k in (None, absent) else f"n-{r.k}" for r in rows.collect()}
        assert found == (known if how == "left" else {i: n for i, n in known.items() if n})


def test_building_a_lookup_join_runs_nothing(spark, skewed):
    spark.sparkContext.setJobGroup("lookup", "lookup")
    skew.join_lookup(skewed, skewed.select("k").distinct().withColumn("n", F.lit(1)), ["k"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lookup")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_distinct_counts(skewed):
    rows = skewed.collect()
    got = {r.variable: r.unicos for r in distinct_counts(skewed, {"k": F.col("k"), "v": F.col("v")}).collect()}
    assert got == {"k": len({r.k for r in rows}), "v": 1}
    per = {r.k: r.ids for r in distinct_counts_by(skewed, {"k": F.col("k")}, {"ids": F.col("id")}).collect()}
    assert per == Counter(r.k for r in rows)
    unique = {r.variable: r.valores_unicos for r in profile.unique_values(skewed, ["k", "v"]).collect()}
    assert unique == {"k": len({r.k for r in rows}), "v": 2}


@pytest.mark.parametrize("places", [1, 64])
@pytest.mark.parametrize("label_count", [2, None])
def test_first_examples_are_in_row_order(spark, monkeypatch, places, label_count):
    monkeypatch.setattr(patterns, "PLACES", places)
    df = spark.createDataFrame(
        [(i, v, [lab]) for i, (v, lab) in enumerate(
            [("c", "x"), ("a", "x"), ("c", "x"), ("b", "x"), ("d", "x"), ("q", "y"), ("q", "y")]
        )],
        "n int, v string, l array<string>",
    ).repartition(3)
    got = patterns.first_examples(
        df, F.col("l"), F.col("v"), ["n"], 3, separator="|", name="lab", label_count=label_count
    )
    assert {r.lab: r.ejemplos for r in got.collect()} == {"x": "c|a|b", "y": "q"}


def test_pattern_inventory_keeps_zero_counts_and_residual(spark):
    df = spark.createDataFrame([(1, "CALLE 3-50"), (2, "FRENTE"), (3, ""), (4, None)], "n int, DIRECCION string")
    got = {r.marcador: r for r in D.marcadores_direccion(df, orden=["n"]).collect()}
    assert got["via urbana"].celdas == 1 and got["via urbana"].porcentaje == 25.0
    assert got[R.NO_MARKER].ejemplos == "FRENTE"
    assert got["kilometro"].celdas == 0 and got["kilometro"].ejemplos == ""
    assert len(got) == len(R.ADDRESS_MARKERS) + 1


def test_spelling_groups(spark):
    df = spark.createDataFrame(
        [("JOSÉ", "1", "A"), ("JOSE", "2", "A"), ("JOSE", "3", None), ("ANA", "4", "B"), ("--", "5", "B"), ("..", "6", "C")],
        "n string, c string, m string",
    )
    distinct = {"codigos": F.col("c"), "lugares": F.col("m")}

    def groups(**options):
        got = variants.spelling_groups(df, F.col("n"), distinct, **options).collect()
        return {r.clave: (r.escrituras, r.codigos, r.lugares, r.registros, r.formas) for r in got}

    named = {"JOSE": (2, 3, 1, 3, ["JOSE", "JOSÉ"])}
    # Names that fold to nothing are no spellings of each other.
    assert groups() == named
    assert groups(blank_apart=False) == named | {"": (2, 2, 2, 2, ["--", ".."])}
    assert groups(most=1) == {"JOSE": (2, 3, 1, 3, ["JOSE"])}


def test_spelling_forms_with_a_heavy_key(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", 2)
    df = spark.createDataFrame([("-" * i,) for i in range(1, 40)] + [("A.",), ("a",), ("B",)], "n string")
    got = variants.spelling_forms(df, F.col("n")).collect()
    assert sorted(r.nombre for r in got) == ["A.", "a"]
    got = variants.spelling_forms(df, F.col("n"), blank_apart=False).collect()
    assert len(got) == 41 and {r.escrituras for r in got} == {39, 2}


def test_a_key_of_a_million_forms(spark):
    """Its list is bounded before it is made: the window keeps the first of each task alone."""
    marks = F.translate(F.lpad(F.col("id").cast("string"), 6, "0"), "0123456789", ".,;:!?-_()")
    df = spark.range(1_000_000).select(F.concat(F.lit("ANA"), marks).alias("n")).union(spark.sql("SELECT 'Luz' UNION ALL SELECT 'LUZ'"))
    groups = variants.spelling_groups(df, F.col("n"), {}, most=5)
    assert "WindowGroupLimit" in groups._jdf.queryExecution().executedPlan().toString()
    got = {r.clave: r for r in groups.collect()}
    assert set(got) == {"ANA", "LUZ"}
    assert got["ANA"].escrituras == got["ANA"].registros == 1_000_000
    assert got["ANA"].formas == sorted(r.n for r in df.where("n LIKE 'ANA%'").orderBy("n").limit(5).collect())


def edit_distance(a, b):
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(previous[j] + 1, row[-1] + 1, previous[j - 1] + (x != y)))
        previous = row
    return previous[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_near_pairs_equal_brute_force(spark, distance):
    names = ["A", "B", "AB", "BA", "ANA", "ANNA", "ANNE", "HANNAH", "JUAN", "JUANA", "JUNA", "AJUAN", "ACEVEDO", "ACEVED0"]
    df = spark.createDataFrame([(n, g) for n in names for g in "xy"], "n string, g string")
    got = {
        (r.bloque, r.clave_a, r.clave_b, r.distancia)
        for r in variants.near_pairs(df, F.col("n"), F.col("g"), distance).collect()
    }
    want = {
        (g, a, b, edit_distance(a, b))
        for g in "xy" for a in names for b in names if a < b and edit_distance(a, b) <= distance
    }
    assert got == want


def test_dependencies_pairs_and_homonyms(spark):
    df = spark.createDataFrame(
        [("a", "1"), ("a", "1"), ("a", "2"), ("b", "1"), ("c", None)], "x string, y string"
    )
    found = consistency.dependency_violations(df, {"x": F.col("x")}, {"y": F.col("y")}).collect()
    assert [(r.x, r.distintos_y) for r in found] == [("a", 2)]
    assert consistency.distinct_pairs(df, F.col("x"), F.col("y")).count() == 4
    assert [r.nombre for r in consistency.homonyms(df, F.col("y"), F.col("x")).collect()] == ["1"]
    row = df.select(
        consistency.contains_other(F.lit("ZONA 1"), F.lit("")).alias("blank"),
        consistency.differs(F.lit(None), F.lit("")).alias("null"),
    ).first()
    assert (row.blank, row.null) == (False, False)


def test_exclusive_classes_sum_to_all_rows(messy):
    n = messy.count()
    for table, column in [
        (D.nombres_ausentes(messy, "DIRECTOR"), "celdas"),
        (D.diagnostico_distrito(messy), "cantidad"),
        (D.diagnostico_departamental(messy), "cantidad"),
    ]:
        assert sum(r[column] for r in table.collect()) == n


def test_empty_input(spark, messy):
    none = messy.where("false")
    assert D.resumen_variables(none).first().porcentaje_faltantes is None
    assert {r.celdas for r in D.inventario_escritura(none, "DIRECTOR").collect()} == {0}
    assert D.duplicados_exactos(none).count() == 0
    assert frequency.category_inventory(none, ["AREA"]).count() == 0


def test_schema_listing(messy):
    got = {r.variable: r["tipo_leído"] for r in profile.schema_listing(messy).collect()}
    assert got["CODIGO"] == "string" and got["fila_origen"] == "bigint"


def test_minority_category_ties_and_blanks(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("",), ("",)], "v string")
    row = frequency.category_inventory(df, ["v"]).first()
    assert (row.categorias_distintas, row.vacios, row.categoria_minoritaria, row.frecuencia_minoritaria) == (4, 2, "a", 1)
    assert row.porcentaje_minoritaria == 16.67


def test_examples_without_lineage_follow_reading_order(messy):
    bare = messy.orderBy("fila_origen", "archivo_origen").drop(*R.LINEAGE).coalesce(1)
    table = {r.categoria: r for r in D.nombres_ausentes(bare, "DIRECTOR").collect()}
    assert table["solo simbolos"].ejemplos.split(" ¦ ")[0] in ("---", "000000")
    for build in (D.categorias_telefono, D.diagnostico_distrito, D.marcadores_direccion,
                  D.direccion_redundante, D.direccion_contaminada):
        assert "_orden" not in build(bare).columns and build(bare).count() > 0
    assert D.inventario_escritura(bare, "DIRECTOR").count() == len(R.WRITING_PATTERNS)


# --- verified duplicates ----------------------------------------------------------------


@pytest.fixture(scope="module")
def wide(spark):
    """1,000 rows of which 990 are unique, nulls and blanks among them, with columns named like inner ones."""
    return spark.range(1000).select(
        "id",
        F.when(F.col("id") >= 990, F.lit("same")).when(F.col("id") % 10 == 0, None).otherwise(F.concat(F.lit("t"), "id")).alias("t"),
        F.when(F.col("id") >= 995, F.lit("")).when(F.col("id") >= 990, None).otherwise(F.col("id").cast("string")).alias("copias"),
        F.lit(1).alias("_h1"),
        F.lit(2).alias("_value"),
        F.lit(3).alias("_bitmap"),
    )


@pytest.mark.parametrize("bits", [8, 1 << 20])
@pytest.mark.parametrize("heavy_rows", [2, None])
def test_verified_duplicates(wide, bits, heavy_rows):
    """With a filter that lets nearly all rows pass, and with one that drops all unique ones."""
    got = duplicates.duplicate_rows(wide, ["t", "copias"], heavy_rows=heavy_rows, bits=bits)
    assert got.columns == [*wide.columns, "copias_"]
    assert sorted((r.id, r.copias_) for r in got.collect()) == [(i, 10) for i in range(990, 1000)]
    assert duplicates.duplicate_count(wide, ["t", "copias"], bits=bits).first() == (10, 1)


@pytest.mark.parametrize("heavy_rows", [2, None])
def test_values_with_one_fingerprint_stay_apart(skewed, monkeypatch, heavy_rows):
    """Every row has the same fingerprint: only the values can tell them apart."""
    monkeypatch.setattr(duplicates, "digest", lambda *columns: [F.lit(7).cast("long"), F.lit(8).cast("long")])
    got = duplicates.duplicate_rows(skewed, ["k", "v"], heavy_rows=heavy_rows).collect()
    assert {r.id: r.copias for r in got} == expected_copies(skewed.collect())
    assert len(got) == len(expected_copies(skewed.collect()))
    counted = duplicates.duplicate_count(skewed, ["k", "v"]).first()
    assert counted.filas_duplicadas == len(got)


def test_unique_rows_are_never_shuffled(wide):
    """Unique rows end at the filter, which is broadcast: what moves are fingerprints and repeated rows."""
    rows, names = duplicates.repeated_rows(wide, ["t", "copias"])
    assert rows.count() == 10
    lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    fork = lines[join + 1].index(":-")
    probe = [line for line in lines[join + 1 :] if line[fork] == ":"]
    probe = probe[: next((i for i, line in enumerate(probe) if line[fork] == "+"), len(probe))]
    assert probe and not any("Exchange" in line for line in probe)


def test_no_duplicates_and_no_rows(wide):
    for df in (wide.where("id < 990"), wide.limit(0)):
        assert duplicates.duplicate_rows(df, ["t", "copias"]).count() == 0
        assert duplicates.duplicate_count(df, ["t", "copias"]).first() == (0, 0)


# --- first examples ---------------------------------------------------------------------


def first_distinct(rows, n):
    found = {}
    for _, value, labels in sorted(rows, key=lambda r: r[0]):
        for label in labels:
            if label is not None and value not in found.setdefault(label, []):
                found[label].append(value)
    return {label: "|".join(values[:n]) for label, values in found.items()}


@pytest.mark.parametrize("n", [1, 3, 70])
def test_first_examples_equal_brute_force(spark, n):
    """A value that half of all rows hold, labels of one value, values of one bucket, more values than buckets."""
    rows = []
    for i in range(3000):
        value = "hot" if i % 2 else f"v{(i * 7919) % 500}"
        rows.append(((f"f{i % 7}", i), value, ["all", None, "odd" if i % 2 else None, f"l{i % 5}"]))
    df = spark.createDataFrame([(*o, v, ls) for o, v, ls in rows], "f string, r long, v string, l array<string>").repartition(6)
    got = patterns.first_examples(df, F.col("l"), F.col("v"), ["f", "r"], n, separator="|", name="lab")
    assert {r.lab: r.ejemplos for r in got.collect()} == first_distinct(rows, n)


def test_order_keys_sort_like_the_columns(spark):
    rows = [(None, 5, 1.5), ("", 2, 0.1), ("a", None, 3.0), ("a", 0, None), ("ab", 7, 2.0), ("Z", 10**12, 1.0), ("é", 1, 1.0)]
    df = spark.createDataFrame(rows, "f string, r long, x double")
    for order in (["r"], ["f", "r"], ["x", "f"]):
        got = [r[0] for r in patterns.ordered_by_key(df, order).orderBy("_key").select(F.struct(*order)).collect()]
        assert got == [r[0] for r in df.orderBy(*[F.asc_nulls_first(c) for c in order]).select(F.struct(*order)).collect()]


def test_examples_shuffle_places_only(spark, messy):
    """No SortAggregate, and what moves before the limit is known are numbers for 64 buckets of each label."""
    plan = D.marcadores_direccion(messy)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "partial_min(_key" in plan
