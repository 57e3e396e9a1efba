"""Cleaning rules of the registry.

``staged`` applies the row rules one after the other and keeps every
intermediate column, so the cleaned table and the transformation log are two
selections of the same plan. No rule drops a row or a source column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.codes import CAPITAL, DISTRICT_FORMATS, district_class, is_name
from tamiz.functions.folding import let
from tamiz.functions.phone import VALID_LENGTHS, split_numbers
from tamiz.functions.text import (
    comparison_key,
    digest,
    found,
    full_match,
    name_key,
    strip,
    trimmed,
    unaccented,
)
from tamiz.operators.skew import join_lookup, join_per_key
from tamiz.operators.variants import preferred_spelling, truncated_names
from tamiz.plans import registry as R

DERIVED_COLUMNS = [
    "DISTRITO_FORMATO", "DISTRITO_REVISAR", "ZONA_CAPITAL", "ESTABLECIMIENTO_CLAVE",
    "DIRECCION_SIN_NUMERO", "TELEFONOS", "DIRECTOR_TITULO", "AREA_REVISION",
]

TRAILING_DATE = r"[\s,]*[\d/-]*" + R.CONTAMINATION["fecha incrustada"] + r"\d*\z"
TITLE = r"\A(" + "|".join(R.TITLES) + r")\.\s*"
PLACE_WORD = R.ADDRESS_MARKERS["rural"] + "|" + R.ADDRESS_MARKERS["barrio/colonia"]


@dataclass(frozen=True)
class Step:
    """One rule on one column: the column before it and the column after it."""

    rule: str
    variable: str
    action: str
    before: str
    after: str


def relabel(text: Column, labels: dict[str, str]) -> Column:
    """Closed dictionary: known values are replaced, all others stay."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), text), text)


def null_if_missing(column: Column) -> Column:
    text = trimmed(column)
    return F.when(~F.upper(text).isin(*R.MISSING_MARKERS), text)


def cut_date(address: Column) -> Column:
    """The address without a final date; null when nothing else is left."""
    rest = strip(F.regexp_replace(address, f"(?U){TRAILING_DATE}", ""))
    return F.nullif(rest, F.lit(""))


def cut_municipality(address: Column, municipality: Column) -> Column:
    """Drops a final municipality name when an address remains before it.

    The name stays where it belongs to a place ("ALDEA SAN JOSE").
    """
    head_length = F.length(address) - F.length(municipality)
    head = F.substring(address, F.lit(1), head_length)
    tail = F.substring(address, head_length + 1, F.length(municipality))
    rest = F.regexp_replace(head, r"(?U)[\s,.-]+\z", "")
    ends = found(head, r"[\s,]\z") & (unaccented(tail) == unaccented(municipality))
    part_of_name = found(unaccented(rest), rf"(?:{PLACE_WORD})\z")
    return F.when(
        (head_length > 0) & ends & (rest != "") & ~part_of_name, rest
    ).otherwise(address)


def zero_for_letter(address: Column) -> Column:
    """A letter O where a number is meant becomes 0."""
    start = F.regexp_replace(address, r"(?U)\AO(?=\s+(?:CALLE|AV))", "0")
    return F.regexp_replace(start, r"(?U)\bO(?=[A-Z]?-\d)", "0")


def fix_person_spelling(name: Column) -> Column:
    """Zero inside a word, grave accents, odd apostrophes, final punctuation."""
    letters = F.regexp_replace(name, r"(?<=\p{L})0|0(?=\p{L})", "O")
    accents = F.translate(letters, "ÀÈÌÒÙàèìòù´`", "ÁÉÍÓÚáéíóú''")
    return F.regexp_replace(accents, r"(?U)[\s,;:]+\z|(?<=\p{L}{3})\.+\z", "")


def staged(df: DataFrame) -> tuple[DataFrame, list[Step]]:
    """All rules in five layers; rules of one layer do not depend on each other."""
    steps: list[Step] = []

    def last(variable: str) -> Column:
        return F.col([s.after for s in steps if s.variable == variable][-1])

    def layer(frame: DataFrame, rules: list[tuple], **extra: Column) -> DataFrame:
        """`rules`: (variable, rule, action, expression of the column so far)."""
        new = dict(extra)
        for variable, rule, action, expr in rules:
            done = sum(s.variable == variable for s in steps)
            before = variable if done == 0 else f"{variable}__{done - 1}"
            new[f"{variable}__{done}"] = expr(F.col(before))
            steps.append(Step(rule, variable, action, before, f"{variable}__{done}"))
        return frame.withColumns(new)

    capital = F.col("DEPARTAMENTO__0") == CAPITAL
    municipality = F.col("MUNICIPIO__0")
    divisions = {k: v.upper() for k, v in R.DEPARTMENTS.items()}
    numbers = F.filter(
        split_numbers(F.col("TELEFONO__0")), lambda n: F.length(n).isin(*VALID_LENGTHS)
    )

    text = "Texto sin espacios extremos; vacio y marcador a NULL"
    out = layer(df, [(c, "C1", text, null_if_missing) for c in R.SOURCE_COLUMNS])
    out = layer(
        out,
        [
            ("DEPARTAMENTO", "C4", "CIUDAD CAPITAL al departamento oficial",
             lambda c: F.when(c == CAPITAL, R.CAPITAL_DEPARTMENT).otherwise(c)),
            ("MUNICIPIO", "C4", "Zona capitalina a columna propia",
             lambda c: F.when(capital, R.CAPITAL_MUNICIPALITY).otherwise(c)),
            ("DEPARTAMENTAL", "C7", "Tildes segun catalogo propio",
             lambda c: let(
                 comparison_key(c),
                 lambda k: F.when(k.isin(*divisions), relabel(k, divisions)).otherwise(c),
             )),
            ("DIRECCION", "C12", "Fecha final recortada", cut_date),
            ("SUPERVISOR", "C18", "Grafias contaminadas corregidas", fix_person_spelling),
            ("DIRECTOR", "C20", "Titulo separado del nombre",
             lambda c: F.regexp_replace(c, f"(?U){TITLE}", "")),
            ("AREA", "C23", "SIN ESPECIFICAR a NULL",
             lambda c: F.nullif(c, F.lit(R.UNSPECIFIED_AREA))),
        ],
        TELEFONOS=numbers,
    )
    out = layer(
        out,
        [
            ("DEPARTAMENTO", "C5", "Nombre oficial segun diccionario cerrado",
             lambda c: relabel(c, R.DEPARTMENTS)),
            ("DIRECCION", "C11", "Municipio final recortado",
             lambda c: F.when(
                 municipality.isNotNull(), cut_municipality(c, municipality)
             ).otherwise(c)),
            # A cell that still holds a readable number keeps its text.
            ("TELEFONO", "C15", "Celda sin numero recuperable a NULL",
             lambda c: F.when(F.size("TELEFONOS") > 0, c)),
            ("SUPERVISOR", "C19", "Nombre ausente a NULL", lambda c: F.when(is_name(c), c)),
            ("DIRECTOR", "C19", "Nombre ausente a NULL", lambda c: F.when(is_name(c), c)),
        ],
    )
    out = layer(
        out,
        [("DIRECCION", "C13", "Letra O por cero en contexto numerico", zero_for_letter)],
    )
    out = layer(
        out,
        [
            ("DIRECCION", "C10", "Direccion sin informacion a NULL",
             lambda c: F.when(
                 ~(
                     F.coalesce(unaccented(c) == unaccented(municipality), F.lit(False))
                     | found(c, R.ADDRESS_MARKERS["solo puntuacion"])
                 ),
                 c,
             )),
        ],
    )

    def kept(name: str, fresh: Column) -> Column:
        # A second cleaning keeps what the first one moved to its own column.
        return F.coalesce(F.col(name), fresh) if name in df.columns else fresh

    rural_word = found(
        unaccented(F.coalesce("DIRECCION__0", F.lit(""))), R.ADDRESS_MARKERS["rural"]
    )
    house_number = found(
        F.coalesce(last("DIRECCION"), F.lit("")), R.ADDRESS_MARKERS["numero de casa (N-N)"]
    )
    title = F.regexp_extract(F.coalesce("DIRECTOR__0", F.lit("")), f"(?U){TITLE}", 1)
    out = out.withColumns(
        {
            "DISTRITO_FORMATO": district_class(F.col("DISTRITO__0")),
            "DISTRITO_REVISAR": F.coalesce(
                full_match(F.col("DISTRITO__0"), DISTRICT_FORMATS["incompleto"]), F.lit(False)
            ),
            "ZONA_CAPITAL": kept(
                "ZONA_CAPITAL",
                F.when(
                    capital & full_match(F.col("MUNICIPIO__0"), R.ZONE), F.col("MUNICIPIO__0")
                ),
            ),
            "ESTABLECIMIENTO_CLAVE": name_key(F.col("ESTABLECIMIENTO__0")),
            "DIRECCION_SIN_NUMERO": F.coalesce(last("AREA") != R.RURAL, F.lit(False))
            & last("DIRECCION").isNotNull()
            & ~house_number,
            "DIRECTOR_TITULO": kept("DIRECTOR_TITULO", F.nullif(title, F.lit(""))),
            "AREA_REVISION": kept(
                "AREA_REVISION",
                F.when(
                    capital & (F.col("AREA__0") == R.RURAL),
                    F.when(rural_word, "con respaldo en DIRECCION").otherwise("sin respaldo"),
                ),
            ),
        }
    )
    return out, steps


def _changed(step: Step) -> Column:
    return ~F.col(step.before).eqNullSafe(F.col(step.after))


def mark_names(steps: list[Step]) -> list[str]:
    return [f"_cambio{i}" for i in range(len(steps))]


def limpiar_datos(df: DataFrame, marks: bool = False) -> DataFrame:
    """Source columns cleaned by the row rules, derived columns, lineage.

    With ``marks`` also a column for every rule that says whether it changed the row.
    """
    out, steps = staged(df)
    final = {s.variable: s.after for s in steps}
    extra = [c for c in df.columns if c not in R.SOURCE_COLUMNS + DERIVED_COLUMNS]
    return out.select(
        *[F.col(final[c]).alias(c) for c in R.SOURCE_COLUMNS],
        *[F.col(c) for c in DERIVED_COLUMNS],
        *extra,
        *([_changed(s).alias(n) for s, n in zip(steps, mark_names(steps))] if marks else []),
    )


def registro_transformaciones(df: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """Rows changed by each rule on each column, all counted in one scan.

    ``marked`` is the table cleaned with marks if it is there already; the rules then do not run again.
    """
    out, steps = staged(df)
    changes = [_changed(s) for s in steps]
    if marked is not None:
        out, changes = marked, [F.col(n) for n in mark_names(steps)]
    changed = [F.count_if(change).alias(f"n{i}") for i, change in enumerate(changes)]
    rows = [
        F.struct(
            F.lit(s.variable).alias("variable"),
            F.lit(s.rule).alias("regla"),
            F.lit(s.action).alias("transformacion"),
            F.col(f"n{i}").alias("filas_afectadas"),
        )
        for i, s in enumerate(steps)
    ]
    return out.agg(*changed).select(F.inline(F.array(*rows)))


def corregir_municipio(df: DataFrame, catalogo: DataFrame) -> DataFrame:
    """Official municipality spelling by department and municipality together.

    `catalogo`: departamento, municipio (as text) and oficial. Pairs that fold
    alike are one; if their official spellings differ, the pair matches
    nothing. A name alone never matches, so homonyms stay apart.
    """
    lookup = (
        catalogo.groupBy(
            comparison_key(trimmed(F.col("departamento"))).alias("_dep"),
            comparison_key(trimmed(F.col("municipio"))).alias("_mun"),
        )
        .agg(F.min("oficial").alias("_oficial"), F.max("oficial").alias("_otra"))
        .where("_oficial = _otra")
        .drop("_otra")
    )
    keyed = df.withColumn("_dep", comparison_key(trimmed(F.col("DEPARTAMENTO")))).withColumn(
        "_mun", comparison_key(trimmed(F.col("MUNICIPIO")))
    )
    joined = join_lookup(keyed, lookup, ["_dep", "_mun"])
    return joined.select(
        *[
            F.coalesce("_oficial", c).alias(c) if c == "MUNICIPIO" else F.col(c)
            for c in df.columns
        ],
        F.col("_oficial").isNotNull().alias("MUNICIPIO_EN_CATALOGO"),
    )


def imputar_supervisor(df: DataFrame) -> DataFrame:
    """Fills an absent supervisor where the district has exactly one name."""
    named = F.when(is_name(F.col("SUPERVISOR")), trimmed(F.col("SUPERVISOR")))
    prepared = df.withColumn("_distrito", trimmed(F.col("DISTRITO"))).withColumn("_nombre", named)
    per_district = (
        prepared.where("_distrito <> ''")
        .groupBy("_distrito", "_nombre")
        .agg(F.count("*").alias("n"))
        .groupBy("_distrito")
        .agg(
            F.when(F.count("_nombre") == 1, F.min("_nombre")).alias("_unico"),
            F.sum("n").alias("_filas"),
        )
    )
    absent = F.col("_nombre").isNull() & (F.col("_distrito") != "")
    filled = join_per_key(prepared.where(absent), per_district, ["_distrito"], "_filas", "left")
    columns = [F.col(c) for c in df.columns if c != "SUPERVISOR"]
    return (
        filled.select(
            *columns,
            F.col("_unico").alias("SUPERVISOR"),
            F.col("_unico").isNotNull().alias("SUPERVISOR_IMPUTADO"),
        )
        .unionByName(
            prepared.where(~absent).select(
                *columns,
                F.col("_nombre").alias("SUPERVISOR"),
                F.lit(False).alias("SUPERVISOR_IMPUTADO"),
            )
        )
        .select(*df.columns, "SUPERVISOR_IMPUTADO")
    )


def fusionar_escrituras(df: DataFrame, nombre: str, jurisdiccion: str) -> DataFrame:
    """The most frequent spelling of a person within a jurisdiction for all of them.

    Rows without a jurisdiction may be about different people and are not merged.
    """
    keep = is_name(F.col(nombre)) & (trimmed(F.col(jurisdiccion)) != "")
    preferred = preferred_spelling(df, F.col(nombre), F.col(jurisdiccion), keep).select(
        F.col("clave").alias("_clave"),
        F.col("jurisdiccion").alias("_jurisdiccion"),
        F.col("nombre_preferido").alias("_preferido"),
        F.col("registros").alias("_registros"),
    )
    people = df.where(keep).withColumns(
        {
            "_clave": name_key(trimmed(F.col(nombre))),
            "_jurisdiccion": trimmed(F.col(jurisdiccion)),
        }
    )
    joined = join_per_key(people, preferred, ["_clave", "_jurisdiccion"], "_registros", "left")
    new = f"{nombre}_FUSIONADO"
    return joined.select(
        *df.columns, F.coalesce("_preferido", trimmed(F.col(nombre))).alias(new)
    ).unionByName(
        df.where(~keep).select("*", F.nullif(trimmed(F.col(nombre)), F.lit("")).alias(new))
    )


def marcar_truncados(df: DataFrame, nombre: str, jurisdiccion: str) -> DataFrame:
    """Marks names that may be the beginning of a longer one in their jurisdiction; merges nothing.

    `<nombre>_TRUNCADO`: another name of the jurisdiction goes on after these
    words. `<nombre>_COMPLETO`: the key of that name, null if there are several.
    """
    keep = is_name(F.col(nombre))
    found_ = truncated_names(df, F.col(nombre), F.col(jurisdiccion), keep)
    per_name = found_.groupBy("jurisdiccion", "corta").agg(
        F.when(F.count("*") == 1, F.min("completa")).alias("_completo"),
        F.max("registros_corta").alias("_registros"),
    )
    keyed = df.withColumns(
        {
            "_clave": F.when(keep, name_key(trimmed(F.col(nombre)))).otherwise(""),
            "_jurisdiccion": trimmed(F.col(jurisdiccion)),
        }
    )
    per_name = per_name.withColumnsRenamed({"jurisdiccion": "_jurisdiccion", "corta": "_clave"})
    # Every key of a row, so that a heavy one without a mark is known as well.
    every = keyed.groupBy("_jurisdiccion", "_clave").agg(F.count("*").alias("_filas"))
    marks = every.join(per_name, ["_jurisdiccion", "_clave"], "left")
    joined = join_per_key(keyed, marks, ["_jurisdiccion", "_clave"], "_filas")
    return joined.select(
        *df.columns,
        F.col("_registros").isNotNull().alias(f"{nombre}_TRUNCADO"),
        F.col("_completo").alias(f"{nombre}_COMPLETO"),
    )


def marcar_duplicados(df: DataFrame) -> DataFrame:
    """Marks rows that share name key and place; deletes nothing.

    A place is department and municipality together, so homonyms stay apart.
    `CANDIDATO_DUPLICADO`: another row has the same key. `CONFIRMADO`: another
    row also agrees in JORNADA, PLAN and DIRECCION. A row without name,
    department or municipality is not comparable and gets neither mark.
    """
    group = ["_clave", "_departamento", "_municipio"]
    detail = [trimmed(F.col(c)) for c in ("JORNADA", "PLAN", "DIRECCION")]
    keyed = df.withColumns(
        {
            "_clave": name_key(trimmed(F.col("ESTABLECIMIENTO"))),
            "_departamento": trimmed(F.col("DEPARTAMENTO")),
            "_municipio": trimmed(F.col("MUNICIPIO")),
        }
    )
    keyed = keyed.select("*", *digest(*[F.col(c) for c in group], *detail))
    comparable = (
        (F.col("_clave") != "") & (F.col("_departamento") != "") & (F.col("_municipio") != "")
    )
    fine = (
        keyed.where(comparable)
        .groupBy(*group, "h1", "h2")
        .agg(F.count("*").alias("_iguales"))
    )
    coarse = (
        fine.groupBy(*group)
        .agg(F.sum("_iguales").alias("_grupo"), F.count("*").alias("_combinaciones"))
        .where("_grupo > 1")
    )
    per_row_key = join_per_key(fine, coarse, group, "_combinaciones").select(
        "h1", "h2", "_iguales", "_grupo"
    )
    marked = join_per_key(keyed.where(comparable), per_row_key, ["h1", "h2"], "_iguales", "left")
    return marked.select(
        *df.columns,
        F.col("_grupo").isNotNull().alias("CANDIDATO_DUPLICADO"),
        F.coalesce(F.col("_iguales") > 1, F.lit(False)).alias("CONFIRMADO"),
    ).unionByName(
        keyed.where(~comparable).select(
            *df.columns,
            F.lit(False).alias("CANDIDATO_DUPLICADO"),
            F.lit(False).alias("CONFIRMADO"),
        )
    )


def telefonos_por_fila(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per recovered number."""
    numbers = F.posexplode_outer(split_numbers(F.col("TELEFONO"))).alias("posicion", "numero")
    return df.select(*columns, numbers).where(F.col("numero").isNotNull())
