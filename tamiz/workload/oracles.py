"""SQL for each registered query, run on the same tables by another engine.

Everything is computed over whole tables. The text classes are the ASCII ones
of that engine; the tables hold no exotic white space or digits.
"""

from __future__ import annotations

from tamiz.plans import registry as R
from tamiz.plans.cleaning import DERIVED_COLUMNS, PLACE_WORD, TRAILING_DATE
from tamiz.plans.reports import (
    CATEGORICAL_LEDGER,
    CATEGORICAL_LEDGER_COLUMNS,
    FULL_LEDGER,
    FULL_LEDGER_COLUMNS,
    GEOGRAPHIC_LEDGER,
    GEOGRAPHIC_LEDGER_COLUMNS,
    METRICS,
)
from tamiz.workload.messy import messy_oracle

WHITE = "chr(32) || chr(9) || chr(10) || chr(13)"
ORACLES: dict[str, str] = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def ascii_pattern(pattern: str) -> str:
    """A pattern of the registry in the regex dialect of the other engine."""
    return q(
        pattern.replace(r"\s\x1c-\x1f", r"\s").replace(r"[\s]", r"\s")
        .replace(r"\A", "^").replace(r"\z", "$")
        # A word boundary that knows accented letters, before the one pattern
        # that is run on accented text.
        .replace(r"\b[A-ZÑ]{1,4}", r"(?:^|[^\p{L}\p{N}_])[A-ZÑ]{1,4}")
    )


def has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {ascii_pattern(pattern)})"


def full(text: str, pattern: str) -> str:
    return f"regexp_full_match({text}, {ascii_pattern(pattern)})"


def t(c: str) -> str:
    return f"trim(coalesce(CAST({c} AS VARCHAR), ''), {WHITE})"


def unaccented(x: str) -> str:
    return f"upper(replace(strip_accents({x}), 'ß', 'ss'))"


def name_key(x: str) -> str:
    return f"trim(regexp_replace({unaccented(x)}, '[^A-Z0-9]+', ' ', 'g'))"


def comparison_key(x: str) -> str:
    return f"trim(regexp_replace({unaccented(x)}, '\\s+', ' ', 'g'))"


def pct(n: str, total: str, places: int = 2) -> str:
    return f"round(CAST(100.0 AS DOUBLE) * {n} / {total}, {places})"


def count_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def words(x: str) -> str:
    return (
        f"len(list_filter(regexp_split_to_array({x}, '\\s+'), "
        "lambda w: regexp_matches(w, '[A-Za-zÑÁÉÍÓÚÜáéíóúñ]')))"
    )


def examples(source: str, label: str, value: str, order: str, n: int, sep: str = " ¦ ") -> str:
    """First n distinct values per label: (label, ejemplos)."""
    return f"""(SELECT label, string_agg(v, {q(sep)} ORDER BY rn) AS ejemplos FROM (
      SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY o, v) AS rn FROM (
        SELECT {label} AS label, {value} AS v, min({order}) AS o FROM {source} GROUP BY 1, 2))
    WHERE rn <= {n} GROUP BY label)"""


LINEAGE_ORDER = "(archivo_origen, fila_origen)"


# --- profile -------------------------------------------------------------------------

def profile_sql(table: str, columns: list[str]) -> str:
    return union([
        f"""SELECT {q(c)} AS variable, 'string' AS tipo_leido, count(*) AS registros,
        {count_if(f"{t(c)} = ''")} AS faltantes,
        {pct(count_if(f"{t(c)} = ''"), "count(*)")} AS porcentaje_faltantes,
        count(DISTINCT nullif({t(c)}, '')) AS valores_unicos_no_vacios,
        {count_if(f"coalesce({c}, '') <> {t(c)}")} AS espacios_inicio_fin,
        {count_if(has(t(c), r"\s{2,}"))} AS espacios_multiples FROM {table}"""
        for c in columns
    ])


ORACLES["column_profile_documents"] = profile_sql("documents", ["text", "lang", "source"])
ORACLES["column_profile_conversations"] = profile_sql("conversations", ["role", "text"])
ORACLES["column_profile_registry"] = messy_oracle(profile_sql("messy", R.GEOGRAPHIC_COLUMNS))

MISSING = in_list(R.MISSING_MARKERS)
ORACLES["missing_markers"] = messy_oracle(union([
    f"""SELECT {q(c)} AS variable, {count_if(f"upper({t(c)}) IN {MISSING}")} AS faltantes,
    {pct(count_if(f"upper({t(c)}) IN {MISSING}"), "count(*)", 4)} AS porcentaje FROM messy"""
    for c in R.SOURCE_COLUMNS
]))


def unique_sql(table: str, columns: list[str]) -> str:
    return union([
        f"""SELECT {q(c)} AS variable, count(DISTINCT {c})
        + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS valores_unicos FROM {table}"""
        for c in columns
    ])


ORACLES["unique_values"] = unique_sql(
    "orders",
    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
)
ORACLES["unique_values_registry"] = messy_oracle(unique_sql("messy", R.SOURCE_COLUMNS))


def formats_sql(table: str, columns: list[str]) -> str:
    return union([
        f"""SELECT {q(c)} AS variable,
        {count_if(f"coalesce({c}, '') <> {t(c)}")} AS espacios_inicio_fin,
        {count_if(has(f"coalesce({c}, '')", r"\s{2,}"))} AS espacios_multiples,
        {count_if(f"ends_with({t(c)}, '.')")} AS punto_final FROM {table}"""
        for c in columns
    ])


ORACLES["format_flags_registry"] = messy_oracle(
    f"SELECT * FROM ({formats_sql('messy', R.SOURCE_COLUMNS)}) "
    "WHERE espacios_inicio_fin + espacios_multiples + punto_final > 0"
)
ORACLES["format_flags_documents"] = formats_sql("documents", ["text", "lang", "source"])

BLANK_ROW = " AND ".join(f"{t(c)} = ''" for c in R.SOURCE_COLUMNS)
ORACLES["blank_rows_dimension"] = messy_oracle(f"""
SELECT 'Registros crudos' AS "métrica", count(*) AS valor FROM messy
UNION ALL SELECT 'Registros no vacíos', {count_if(f"NOT ({BLANK_ROW})")} FROM messy
UNION ALL SELECT 'Filas completamente vacías', {count_if(BLANK_ROW)} FROM messy
UNION ALL SELECT 'Variables originales', 17
UNION ALL SELECT 'Columnas de trazabilidad', 2""")

TEL = t("TELEFONO")
ORACLES["phone_summary"] = messy_oracle(f"""
SELECT 'Vacíos' AS "métrica", {count_if(f"{TEL} = ''")} AS cantidad FROM messy
UNION ALL SELECT 'Exactamente 8 dígitos', {count_if(full(TEL, r"\d{8}"))} FROM messy
UNION ALL SELECT 'Formato diferente de 8 dígitos',
  {count_if(f"{TEL} <> '' AND NOT {full(TEL, r'''\d{8}''')}")} FROM messy
UNION ALL SELECT 'Con letras o texto adicional', {count_if(has(TEL, R.PHONE_LETTERS))} FROM messy""")

ORACLES["constant_columns"] = messy_oracle(
    "SELECT * FROM (" + union([
        f"SELECT {q(c)} AS variable, max(nullif({t(c)}, '')) AS valor FROM messy "
        f"HAVING count(DISTINCT nullif({t(c)}, '')) = 1"
        for c in R.CATEGORICAL_COLUMNS
    ]) + ")"
)


# --- frequency -------------------------------------------------------------------------

def frequency_sql(table: str, columns: list[str], trim: bool = False, share: bool = True) -> str:
    return union([
        f"""SELECT {q(c)} AS variable, {t(c) if trim else f"coalesce({c}, '')"} AS valor,
        count(*) AS cantidad
        {", " + pct("count(*)", f"(SELECT count(*) FROM {table})") + " AS porcentaje" if share else ""}
        FROM {table} GROUP BY 2"""
        for c in columns
    ])


def inventory_sql(table: str, columns: list[str]) -> str:
    return f"""SELECT variable, count(*) AS categorias_distintas,
      CAST(coalesce(sum(cantidad) FILTER (WHERE valor = ''), 0) AS BIGINT) AS vacios,
      arg_min(valor, (cantidad, valor)) AS categoria_minoritaria,
      min(cantidad) AS frecuencia_minoritaria,
      {pct("min(cantidad)", "sum(cantidad)")} AS porcentaje_minoritaria
    FROM ({frequency_sql(table, columns, trim=True, share=False)}) GROUP BY variable"""


ORACLES["value_frequency_events"] = frequency_sql("events", ["event_type"])
ORACLES["value_frequency_orders"] = frequency_sql("orders", ["o_orderpriority", "o_orderstatus"])
ORACLES["domain_listing"] = messy_oracle(frequency_sql("messy", R.DOMAIN_COLUMNS, share=False))
ORACLES["minority_category_registry"] = messy_oracle(inventory_sql("messy", R.CATEGORICAL_COLUMNS))
ORACLES["minority_category_lineitem"] = inventory_sql("lineitem", ["l_returnflag", "l_linestatus"])
ORACLES["conditional_frequency"] = (
    "SELECT l_linestatus, count(*) AS cantidad FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1"
)
ORACLES["shift_by_plan"] = messy_oracle(
    f"SELECT {t('PLAN')} AS PLAN, count(*) AS cantidad FROM messy "
    f"WHERE {t('JORNADA')} = 'SIN JORNADA' GROUP BY 1"
)
ORACLES["generic_plan_by_sector"] = messy_oracle(
    f"SELECT {t('SECTOR')} AS SECTOR, count(*) AS cantidad FROM messy "
    f"WHERE {t('PLAN')} = 'SEMIPRESENCIAL' GROUP BY 1"
)
ORACLES["rare_categories"] = messy_oracle(
    f"SELECT * FROM ({frequency_sql('messy', R.CATEGORICAL_COLUMNS, trim=True)}) "
    "WHERE valor <> '' AND cantidad <= 1500"
)
ORACLES["domain_check"] = messy_oracle(union([
    f"SELECT {q(c)} AS variable, {t(c)} AS valor, count(*) AS cantidad FROM messy "
    f"WHERE {t(c)} <> '' AND {t(c)} NOT IN {in_list(v)} GROUP BY 2"
    for c, v in {
        **R.FIXED_DOMAINS, "AREA": ["URBANA", "RURAL"], "STATUS": ["ABIERTA", "CERRADA"],
    }.items()
]))
ORACLES["catalog_check"] = messy_oracle(f"""
SELECT {t('DEPARTAMENTO')} AS DEPARTAMENTO, count(*) AS cantidad FROM messy
WHERE {t('DEPARTAMENTO')} NOT IN ('', 'CIUDAD CAPITAL')
  AND {t('DEPARTAMENTO')} NOT IN (SELECT n_name FROM nation) GROUP BY 1""")

# --- duplicates -------------------------------------------------------------------------

ORACLES["exact_duplicates_documents"] = """
SELECT doc_id, copias FROM (
  SELECT doc_id, count(*) OVER (PARTITION BY text, lang) AS copias FROM documents) WHERE copias > 1"""
COLS = ", ".join(R.SOURCE_COLUMNS)
ORACLES["exact_duplicates_registry"] = messy_oracle(f"""
SELECT * FROM (SELECT {COLS}, archivo_origen, fila_origen,
  count(*) OVER (PARTITION BY {COLS}) AS copias FROM messy) WHERE copias > 1""")
ORACLES["exact_duplicates_heavy"] = """
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
  count(*) OVER (PARTITION BY l_returnflag, l_quantity) AS copias FROM lineitem) WHERE copias > 1"""
ORACLES["exact_duplicate_count"] = """
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS filas_duplicadas, count(*) AS grupos
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang HAVING count(*) > 1)"""
ORACLES["surplus_duplicates"] = f"""
SELECT count(nullif({t('text')}, '')) - count(DISTINCT nullif({t('text')}, '')) AS sobrantes_text
FROM documents"""
ORACLES["repeated_codes"] = messy_oracle(f"""
SELECT {t('CODIGO')} AS valor, count(*) - 1 AS repeticiones FROM messy
WHERE {t('CODIGO')} <> '' GROUP BY 1 HAVING count(*) > 1""")

# --- patterns ---------------------------------------------------------------------------


def inventory_patterns(
    prepared: str, patterns: dict[str, str], label: str, order: str, share: bool = True,
    scope: str = "true", residual: str | None = None,
) -> str:
    """`prepared` has the columns texto and those of `order`."""
    conditions = {k: f"({scope}) AND {has('texto', p)}" for k, p in patterns.items()}
    if residual:
        rest = " OR ".join(has("texto", p) for p in patterns.values())
        conditions[residual] = f"({scope}) AND NOT ({rest})"
    parts = []
    for k, condition in conditions.items():
        sample = examples(f"(SELECT * FROM prep WHERE {condition})", q(k), "texto", order, 3)
        share_sql = f"{pct('count(*) FILTER (WHERE ' + condition + ')', 'count(*)')} AS porcentaje," if share else ""
        parts.append(f"""SELECT {q(k)} AS {label}, {count_if(condition)} AS celdas, {share_sql}
          coalesce((SELECT ejemplos FROM {sample}), '') AS ejemplos FROM prep""")
    return f"SELECT * FROM (WITH prep AS MATERIALIZED ({prepared}) SELECT * FROM ({union(parts)}))"


ORACLES["writing_patterns_documents"] = inventory_patterns(
    f"SELECT doc_id, {t('text')} AS texto FROM documents", R.WRITING_PATTERNS, "patron", "doc_id"
)
ORACLES["writing_patterns_registry"] = messy_oracle(inventory_patterns(
    f"SELECT archivo_origen, fila_origen, {t('ESTABLECIMIENTO')} AS texto FROM messy",
    R.WRITING_PATTERNS, "patron", LINEAGE_ORDER,
))
DIR = unaccented(t("DIRECCION"))
ADDRESS = f"SELECT archivo_origen, fila_origen, {DIR} AS texto FROM messy"
ORACLES["address_markers"] = messy_oracle(inventory_patterns(
    ADDRESS, R.ADDRESS_MARKERS, "marcador", LINEAGE_ORDER,
    scope="texto <> ''", residual=R.NO_MARKER,
))
ORACLES["contamination"] = messy_oracle(inventory_patterns(
    ADDRESS, R.CONTAMINATION, "patron", LINEAGE_ORDER, share=False,
))


def exclusive(prepared: str, labels, label: str) -> str:
    """`prepared` has caso, texto and the lineage columns."""
    parts = []
    for k in labels:
        sample = examples(f"(SELECT * FROM prep WHERE caso = {q(k)})", q(k), "texto", LINEAGE_ORDER, 3)
        parts.append(f"""SELECT {q(k)} AS {label}, {count_if(f"caso = {q(k)}")} AS celdas,
          {pct(count_if(f"caso = {q(k)}"), "count(*)")} AS porcentaje,
          coalesce((SELECT ejemplos FROM {sample}), '') AS ejemplos FROM prep""")
    return f"SELECT * FROM (WITH prep AS MATERIALIZED ({prepared}) SELECT * FROM ({union(parts)}))"


MUN = unaccented(t("MUNICIPIO"))
ORACLES["address_redundancy"] = messy_oracle(exclusive(
    f"""SELECT archivo_origen, fila_origen, {DIR} AS texto,
    CASE WHEN {DIR} <> '' AND {DIR} = {MUN} THEN 'direccion == municipio'
      WHEN {DIR} <> '' AND {MUN} <> '' AND contains({DIR}, {MUN})
      THEN 'direccion contiene municipio' END AS caso FROM messy""",
    ["direccion == municipio", "direccion contiene municipio"], "caso",
))


def name_class(c: str) -> str:
    return f"""CASE WHEN {t(c)} = '' THEN 'vacia' WHEN {words(t(c))} = 0 THEN 'solo simbolos'
      WHEN {words(t(c))} = 1 THEN 'un solo token'
      WHEN regexp_matches({t(c)}, '(?i)\\bSIN\\s+DAT') THEN 'frase de ausencia'
      ELSE 'nombre aparente' END"""


NAME_LABELS = ["vacia", "solo simbolos", "un solo token", "frase de ausencia", "nombre aparente"]
for column in ("DIRECTOR", "SUPERVISOR"):
    ORACLES[f"name_absence_{column.lower()}"] = messy_oracle(exclusive(
        f"SELECT archivo_origen, fila_origen, {t(column)} AS texto, {name_class(column)} AS caso FROM messy",
        NAME_LABELS, "categoria",
    ))

ORACLES["first_examples_documents"] = f"""
SELECT label AS source, ejemplos FROM {examples("documents", "source", t("text"), "doc_id", 3)}"""

# --- classes ----------------------------------------------------------------------------

DISTRICT = f"""CASE WHEN {t('DISTRITO')} = '' THEN 'vacio'
  WHEN {full(t('DISTRITO'), r"\d{2}-")} THEN 'incompleto'
  WHEN {full(t('DISTRITO'), r"\d{2}-\d{3}")} THEN 'formato corto NN-NNN'
  WHEN {full(t('DISTRITO'), r"\d{2}-\d{2}-\d{4}")} THEN 'formato extendido NN-NN-NNNN'
  ELSE 'otro formato' END"""
DEP, DIV = t("DEPARTAMENTO"), t("DEPARTAMENTAL")
RELATION = f"""CASE WHEN {DEP} = {DIV} THEN 'coincidencia exacta'
  WHEN {comparison_key(DEP)} = {comparison_key(DIV)} THEN 'solo difiere por tildes'
  WHEN {DEP} IN ('GUATEMALA', 'CIUDAD CAPITAL') AND starts_with({comparison_key(DIV)}, 'GUATEMALA ')
    THEN 'subdivision administrativa'
  WHEN {comparison_key(DEP)} = 'QUICHE' AND {comparison_key(DIV)} = 'QUICHE NORTE'
    THEN 'subdivision administrativa'
  ELSE 'otra relacion' END"""
ORACLES["row_classes"] = messy_oracle(f"""
SELECT archivo_origen, fila_origen, {DISTRICT} AS distrito, {RELATION} AS relacion,
  {name_class('DIRECTOR')} AS director, {name_class('SUPERVISOR')} AS supervisor,
  substr({t('CODIGO')}, 1, 5) AS prefijo FROM messy""")


def phone_numbers(x: str) -> str:
    head = f"regexp_split_to_array({x}, '(?i)\\b(?:EXT|EXTS|ESTX)\\b\\.?')[1]"
    pieces = f"regexp_split_to_array({head}, '[,/;]|\\s+[Yy]\\s+')"
    f = f"trim(f, {WHITE})"
    base = f"regexp_extract({f}, '^(\\d{{7,8}})-(\\d{{1,4}})$', 1)"
    tail = f"regexp_extract({f}, '^(\\d{{7,8}})-(\\d{{1,4}})$', 2)"
    d = f"regexp_replace({f}, '\\D', '', 'g')"
    numbers = f"""CASE WHEN regexp_full_match({f}, '\\d{{7,8}}-\\d{{1,4}}')
        THEN [{base}, substr({base}, 1, length({base}) - length({tail})) || {tail}]
      WHEN {d} = '' THEN CAST([] AS VARCHAR[])
      WHEN length({d}) % 8 = 0 AND length({d}) <= 32 THEN regexp_extract_all({d}, '\\d{{8}}')
      WHEN length({d}) % 7 = 0 AND length({d}) <= 28 THEN regexp_extract_all({d}, '\\d{{7}}')
      WHEN length({d}) = 15 THEN [substr({d}, 1, 8), substr({d}, 9, 7)] ELSE [{d}] END"""
    return (
        f"list_filter(flatten(list_transform({pieces}, lambda f: {numbers})), "
        "lambda n: NOT regexp_full_match(n, '0+'))"
    )


def phone_class(x: str, n: str) -> str:
    return f"""CASE WHEN {x} = '' THEN 'vacio' WHEN {full(x, r"\d{8}")} THEN 'valido'
      WHEN regexp_matches({x}, '(?i)\\b(?:EXT|EXTS|ESTX)\\b\\.?') THEN 'incluye extension'
      WHEN regexp_matches({x}, '0{{6,}}') THEN 'incluye placeholder de ceros'
      WHEN len({n}) = 0 THEN 'sin numeros recuperables'
      WHEN len(list_filter({n}, lambda m: length(m) NOT IN (7, 8))) > 0 THEN 'no interpretable'
      WHEN len({n}) > 1 THEN 'varios numeros'
      WHEN length({n}[1]) = 7 THEN 'numero legado de 7 digitos'
      ELSE 'un numero de 8 digitos mal formateado' END"""


PHONES = f"(SELECT *, {phone_numbers(TEL)} AS nums FROM messy)"
NONSTANDARD = f"{TEL} <> '' AND NOT {full(TEL, r'''\d{8}''')}"
ORACLES["phone_parse"] = messy_oracle(f"""
SELECT archivo_origen, fila_origen, TELEFONO, array_to_string(nums, ' | ') AS numeros,
  {phone_class(TEL, 'nums')} AS clase FROM {PHONES}""")
ORACLES["phone_parse_documents"] = f"""
SELECT doc_id, array_to_string(nums, ' | ') AS numeros, len(nums) AS cantidad
FROM (SELECT doc_id, {phone_numbers(t('text'))} AS nums FROM documents)"""
ORACLES["phone_detail"] = messy_oracle(f"""
SELECT TELEFONO, ESTABLECIMIENTO, {phone_class(TEL, 'nums')} AS categoria,
  array_to_string(nums, ' | ') AS numeros_recuperados, len(nums) AS cantidad_recuperada,
  archivo_origen, fila_origen FROM {PHONES} WHERE {NONSTANDARD}""")
PHONE_CASES = f"(SELECT *, {phone_class(TEL, 'nums')} AS cat FROM {PHONES} WHERE {NONSTANDARD})"
ORACLES["phone_classes"] = messy_oracle(f"""
SELECT c.cat AS categoria, c.cantidad, e.ejemplos
FROM (SELECT cat, count(*) AS cantidad FROM {PHONE_CASES} GROUP BY cat) c
JOIN {examples(PHONE_CASES, "cat", "TELEFONO", LINEAGE_ORDER, 5, " | ")} e ON e.label = c.cat""")
ORACLES["phone_rows"] = messy_oracle(f"""
SELECT archivo_origen, fila_origen, unnest(generate_series(0, len(nums) - 1)) AS posicion,
  unnest(nums) AS numero FROM {PHONES} WHERE len(nums) > 0""")

ORACLES["code_format_classes"] = messy_oracle(f"""
SELECT c.categoria, c.cantidad, {pct("c.cantidad", "(SELECT count(*) FROM messy)")} AS porcentaje,
  e.ejemplos
FROM (SELECT {DISTRICT} AS categoria, count(*) AS cantidad FROM messy GROUP BY 1) c
JOIN {examples("messy", DISTRICT, t("DISTRITO"), LINEAGE_ORDER, 4, " | ")} e ON e.label = c.categoria""")
ORACLES["pair_relation_classes"] = messy_oracle(f"""
SELECT {RELATION} AS relacion, count(*) AS cantidad,
  {pct("count(*)", "(SELECT count(*) FROM messy)")} AS porcentaje,
  (SELECT count(DISTINCT {DIV}) FROM messy) AS categorias_departamentales FROM messy GROUP BY 1""")
ORACLES["fold_keys"] = f"""
SELECT doc_id, {unaccented(t('text'))} AS sin_tildes, {comparison_key(t('text'))} AS clave_comparacion,
  {name_key(t('text'))} AS clave_nombre, {words(t('text'))} AS palabras FROM documents"""

# --- variants ---------------------------------------------------------------------------

EST = t("ESTABLECIMIENTO")

def variants_sql(source: str, value: str, keep: str, distinct: dict[str, str]) -> str:
    counts = "".join(f" count(DISTINCT {c}) AS {n}," for n, c in distinct.items())
    return f"""SELECT {name_key(value)} AS clave, count(DISTINCT {value}) AS escrituras,{counts}
      count(*) AS registros, array_to_string(list_sort(list(DISTINCT {value})), ' | ') AS formas
    FROM {source} WHERE {keep} GROUP BY 1 HAVING count(DISTINCT {value}) > 1"""


ORACLES["entity_variants"] = messy_oracle(f"""
SELECT *, CASE WHEN municipios = 1 THEN 'posible duplicado' ELSE 'homonimos' END AS categoria FROM (
{variants_sql("messy", t("ESTABLECIMIENTO"), f"{t('ESTABLECIMIENTO')} <> ''",
              {"codigos": "CODIGO", "municipios": "MUNICIPIO"})})""")
ORACLES["spelling_forms"] = messy_oracle(f"""
SELECT * FROM (SELECT clave, nombre, registros, count(*) OVER (PARTITION BY clave) AS escrituras FROM (
  SELECT {name_key(EST)} AS clave, {EST} AS nombre, count(*) AS registros FROM messy
  WHERE {EST} <> '' GROUP BY 1, 2)) WHERE escrituras > 1""")
for column in ("SUPERVISOR", "DIRECTOR"):
    inner = variants_sql(
        "messy", t(column), f"{name_class(column)} = 'nombre aparente'",
        {"jurisdicciones": "DEPARTAMENTAL"},
    )
    ORACLES[f"name_variants_{column.lower()}"] = messy_oracle(f"""
    SELECT *, CASE WHEN jurisdicciones = 1 THEN 'misma persona' ELSE 'revisar (homonimo?)' END
      AS categoria FROM ({inner})""")
WRITTEN = """(SELECT *, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name)
  WHEN p_partkey % 3 = 1 THEN concat(p_name, '.') ELSE p_name END AS escrito FROM part)"""
ORACLES["spelling_groups_part"] = variants_sql(
    WRITTEN, "escrito", "true", {"marcas": "p_brand", "tipos": "p_type"}
)
ORACLES["fuzzy_pairs"] = f"""
WITH n AS (SELECT {t('p_type')} AS bloque,
  {name_key(t("concat_ws(' ', p_name, CAST(p_size AS VARCHAR))"))} AS clave, count(*) AS registros
  FROM part GROUP BY 1, 2)
SELECT a.bloque, a.clave AS clave_a, b.clave AS clave_b, a.registros AS registros_a,
  b.registros AS registros_b, levenshtein(a.clave, b.clave) AS distancia
FROM n a JOIN n b ON a.bloque = b.bloque AND a.clave < b.clave
WHERE levenshtein(a.clave, b.clave) <= 1"""

# --- consistency --------------------------------------------------------------------------

COD = t("CODIGO")
ORACLES["fd_violations_registry"] = messy_oracle(f"""
SELECT 'valores vacios' AS revision, {count_if(f"{COD} = ''")} AS cantidad, 'esperado 0' AS resultado FROM messy
UNION ALL SELECT 'formato NN-NN-NNNN-NN', {count_if(full(COD, r"\d{2}-\d{2}-\d{4}-\d{2}"))},
  'debe coincidir con los registros no vacios' FROM messy
UNION ALL SELECT 'codigos duplicados', count(nullif({COD}, '')) - count(DISTINCT nullif({COD}, '')),
  'esperado 0' FROM messy
UNION ALL SELECT 'pares departamento-municipio con más de un prefijo', count(*), 'esperado 0' FROM (
  SELECT 1 FROM messy GROUP BY DEPARTAMENTO, MUNICIPIO HAVING count(DISTINCT substr({COD}, 1, 5)) > 1)
UNION ALL SELECT 'prefijos asociados a más de una geografia', count(*), 'esperado 0' FROM (
  SELECT 1 FROM messy GROUP BY substr({COD}, 1, 5)
  HAVING count(DISTINCT DEPARTAMENTO) > 1 OR count(DISTINCT MUNICIPIO) > 1)""")
ORACLES["fd_violations_events"] = """
SELECT user_id, count(DISTINCT event_type) AS distintos_event_type, count(DISTINCT props) AS distintos_props
FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1 OR count(DISTINCT props) > 1"""
OFFICIAL = in_list(R.DEPARTMENTS)
ACCENTED = in_list(R.ACCENTED_DEPARTMENTS)
OUTSIDE = f"{DEP} <> '' AND {DEP} NOT IN {OFFICIAL} AND {DEP} <> 'CIUDAD CAPITAL'"
ORACLES["department_checks"] = messy_oracle(f"""
SELECT 'categorias observadas' AS revision, count(DISTINCT nullif({DEP}, '')) AS cantidad,
  concat(count(DISTINCT {DEP}) FILTER (WHERE {DEP} IN {OFFICIAL}),
    ' departamentos oficiales y una categoria especial de la fuente') AS detalle FROM messy
UNION ALL SELECT 'registros en CIUDAD CAPITAL', {count_if(f"{DEP} = 'CIUDAD CAPITAL'")},
  'particion de la fuente; no es departamento oficial' FROM messy
UNION ALL SELECT 'departamentos sin tilde normativa', {count_if(f"{DEP} IN {ACCENTED}")},
  {q(", ".join(sorted(R.ACCENTED_DEPARTMENTS)))} FROM messy
UNION ALL SELECT 'valores fuera del catalogo preliminar', {count_if(OUTSIDE)},
  'excluye la categoria especial CIUDAD CAPITAL' FROM messy""")
MU, CAP = t("MUNICIPIO"), f"{DEP} = 'CIUDAD CAPITAL'"
ORACLES["municipality_checks"] = messy_oracle(f"""
SELECT 'valores vacios' AS revision, {count_if(f"{MU} = ''")} AS cantidad, 'esperado 0' AS detalle FROM messy
UNION ALL SELECT 'nombres unicos', count(DISTINCT nullif({MU}, '')),
  'incluye las zonas registradas por la fuente' FROM messy
UNION ALL SELECT 'pares departamento-municipio', count(*), 'conteo derivado de pares únicos observados'
  FROM (SELECT DISTINCT {DEP}, {MU} FROM messy WHERE {MU} <> '')
UNION ALL SELECT 'pares fuera de CIUDAD CAPITAL', count(*), 'municipios con establecimientos de Diversificado'
  FROM (SELECT DISTINCT {DEP}, {MU} FROM messy WHERE {MU} <> '' AND NOT {CAP})
UNION ALL SELECT 'zonas de Ciudad Capital', count(DISTINCT {MU}),
  'etiquetas ZONA que deben conservarse como sububicacion' FROM messy WHERE {CAP} AND {MU} <> ''
UNION ALL SELECT 'filas capitalinas que no tienen formato ZONA',
  {count_if(f"{CAP} AND NOT {full(MU, R.ZONE)}")}, 'esperado 0' FROM messy
UNION ALL SELECT 'nombres repetidos en distintos departamentos', count(*),
  'homonimos posibles; validar siempre junto a DEPARTAMENTO' FROM (
  SELECT 1 FROM messy WHERE {MU} <> '' AND NOT {CAP} GROUP BY {MU} HAVING count(DISTINCT {DEP}) > 1)
UNION ALL SELECT 'filas con vocal acentuada', {count_if(has(MU, R.ACCENTED_VOWEL))},
  'permite medir si la exportacion conserva tildes en municipios' FROM messy""")
ORACLES["homonyms"] = """
SELECT p_name AS nombre, count(DISTINCT p_brand) AS grupos FROM part
GROUP BY 1 HAVING count(DISTINCT p_brand) > 1"""
ORACLES["distinct_pairs"] = "SELECT DISTINCT p_name AS a, p_brand AS b FROM part"
RURAL_CAPITAL = f"{CAP} AND {t('AREA')} = 'RURAL'"
ORACLES["unspecified_area"] = messy_oracle(f"""
SELECT CODIGO, DEPARTAMENTO, MUNICIPIO, ESTABLECIMIENTO, AREA FROM messy
WHERE {t('AREA')} = 'SIN ESPECIFICAR'""")
ORACLES["rural_in_capital"] = messy_oracle(f"""
SELECT CODIGO, MUNICIPIO, ESTABLECIMIENTO, DIRECCION, AREA FROM messy WHERE {RURAL_CAPITAL}""")

# --- ledgers ----------------------------------------------------------------------------


def ledger_sql(columns: list[str], rows: list[tuple], counts: dict[str, str]) -> str:
    parts = []
    for row in rows:
        entry = dict(zip(columns, row))
        count = counts[entry["cantidad"]]
        fields = []
        for c in columns:
            if c == "cantidad":
                fields.append(f"CAST({count} AS BIGINT) AS cantidad")
            elif c == "porcentaje":
                share = pct(count, "count(*)" if entry[c] is None else count)
                fields.append(f"{share} AS porcentaje")
            elif c == "ejemplo":
                counted = count.removeprefix("count(*)")
                shown = f"min(nullif({t(entry['variable'])}, '')){counted}"
                known = count.startswith("count(*)")
                fields.append((f"coalesce({shown}, '')" if known else "''") + " AS ejemplo")
            else:
                fields.append(f"{q(entry[c])} AS {c}")
        parts.append(f"SELECT {', '.join(fields)} FROM messy")
    return union(parts)


CATEGORY_COUNTS = {
    "todas": "count(*)",
    "formato_irregular": count_if(" OR ".join(f"{c} <> upper({t(c)})" for c in ("SECTOR", "STATUS", "MODALIDAD"))),
    "sin_jornada": count_if(f"{t('JORNADA')} = 'SIN JORNADA'"),
    "sin_especificar": count_if(f"{t('AREA')} = 'SIN ESPECIFICAR'"),
    "rural_capital": count_if(RURAL_CAPITAL),
    "plan_generico": count_if(f"{t('PLAN')} = 'SEMIPRESENCIAL'"),
    "plan_raro": count_if(f"{t('PLAN')} IN {in_list(R.RARE_PLANS)}"),
    "status_temporal": count_if(f"{t('STATUS')} IN {in_list(R.TEMPORARY_STATUS)}"),
}
ORACLES["categorical_ledger"] = messy_oracle(
    ledger_sql(CATEGORICAL_LEDGER_COLUMNS, CATEGORICAL_LEDGER, CATEGORY_COUNTS)
)
ORACLES["geographic_ledger"] = messy_oracle(ledger_sql(
    GEOGRAPHIC_LEDGER_COLUMNS, GEOGRAPHIC_LEDGER,
    {
        "todas": "count(*)",
        "distrito_vacio": count_if(f"{t('DISTRITO')} = ''"),
        "distrito_no_vacio": count_if(f"{t('DISTRITO')} <> ''"),
        "distrito_incompleto": count_if(full(t("DISTRITO"), r"\d{2}-")),
        "capital": count_if(CAP),
        "sin_tilde": count_if(f"{DEP} IN {ACCENTED}"),
        "municipios": f"count(DISTINCT nullif({MU}, ''))",
        "departamental_distinta": count_if("DEPARTAMENTO <> DEPARTAMENTAL"),
    },
))


def merged(c: str, keep: str) -> str:
    return (
        f"(count(DISTINCT {t(c)}) FILTER (WHERE {keep})"
        f" - count(DISTINCT {name_key(t(c))}) FILTER (WHERE {keep}))"
    )


def absent(c: str) -> str:
    return f"{name_class(c)} <> 'nombre aparente'"


LEDGER_COUNTS = {
    **CATEGORY_COUNTS,
    "telefono_vacio": count_if(f"{TEL} = ''"),
    "telefono_no_estandar": count_if(NONSTANDARD),
    "nombre_tildes": count_if(has(EST, R.WRITING_PATTERNS["tiene tildes"])),
    "nombre_comillas": count_if(has(EST, R.WRITING_PATTERNS["comillas"])),
    "nombre_espacios": count_if(has(EST, r"\s{2,}")),
    "nombre_variantes": merged("ESTABLECIMIENTO", f"{EST} <> ''"),
    "direccion_vacia": count_if(
        f"upper({t('DIRECCION')}) IN {MISSING} OR {has(t('DIRECCION'), R.ADDRESS_MARKERS['solo puntuacion'])}"
    ),
    "direccion_municipio": count_if(f"{DIR} <> '' AND {DIR} = {MUN}"),
    "direccion_contiene": count_if(f"{DIR} <> {MUN} AND {MUN} <> '' AND contains({DIR}, {MUN})"),
    "direccion_fecha": count_if(has(DIR, R.CONTAMINATION["fecha incrustada"])),
    "direccion_letra_o": count_if(has(DIR, R.CONTAMINATION["letra O por cero"])),
    "supervisor_ausente": count_if(absent("SUPERVISOR")),
    "supervisor_variantes": merged("SUPERVISOR", f"NOT ({absent('SUPERVISOR')})"),
    "supervisor_raro": count_if(has(t("SUPERVISOR"), r"\p{L}0|0\p{L}|[ÀÈÌÒÙàèìòù´`]")),
    "director_ausente": count_if(absent("DIRECTOR")),
    "director_variantes": merged("DIRECTOR", f"NOT ({absent('DIRECTOR')})"),
    "director_titulo": count_if(has(t("DIRECTOR"), r"\b(?:LIC|PEM)\.")),
    "nivel_no_vacio": count_if(f"{t('NIVEL')} <> ''"),
    "sector_fuera": count_if(
        f"{t('SECTOR')} <> '' AND {t('SECTOR')} NOT IN {in_list(R.FIXED_DOMAINS['SECTOR'])}"
    ),
    "modalidad_fuera": count_if(
        f"{t('MODALIDAD')} <> '' AND {t('MODALIDAD')} NOT IN {in_list(R.FIXED_DOMAINS['MODALIDAD'])}"
    ),
}
FULL_LEDGER_SQL = ledger_sql(FULL_LEDGER_COLUMNS, FULL_LEDGER, LEDGER_COUNTS)
ORACLES["defect_ledger"] = messy_oracle(FULL_LEDGER_SQL)
ORACLES["ledger_variables"] = messy_oracle(f"""
SELECT count(*) AS defectos_registrados,
  count(DISTINCT variable) FILTER (WHERE requiere_limpieza = 'Si') AS variables_con_limpieza
FROM ({FULL_LEDGER_SQL})""")

# --- ingest -----------------------------------------------------------------------------

ORACLES["record_lineage"] = """
SELECT o_orderkey, 'orders.parquet' AS archivo_origen, row_number() OVER (ORDER BY o_orderkey) + 1 AS fila_origen FROM orders"""
ORACLES["file_profile"] = messy_oracle("""
SELECT archivo_origen AS archivo, count(*) AS registros, CAST(17 AS BIGINT) AS variables
FROM messy GROUP BY 1""")
INGEST = f"""
SELECT 'Variables originales' AS metrica, CAST(17 AS BIGINT) AS valor
UNION ALL SELECT 'Columnas de trazabilidad', 2
UNION ALL SELECT 'Registros crudos generados', count(*) FROM messy
UNION ALL SELECT 'Registros con información', {count_if(f"NOT ({BLANK_ROW})")} FROM messy
UNION ALL SELECT 'Filas completamente vacías conservadas', {count_if(BLANK_ROW)} FROM messy"""
ORACLES["ingest_summary"] = messy_oracle(
    INGEST + "\nUNION ALL SELECT 'Archivos unidos', count(DISTINCT archivo_origen) FROM messy"
)
ORACLES["csv_lineage"] = messy_oracle("""
SELECT archivo_origen AS origen, CODIGO, TELEFONO,
  row_number() OVER (PARTITION BY archivo_origen ORDER BY fila_origen) + 1 AS fila_origen FROM messy""")
ORACLES["csv_round_trip"] = messy_oracle(
    f"SELECT {COLS}, count(*) AS copias FROM messy GROUP BY {COLS}"
)

# --- cleaning ---------------------------------------------------------------------------


def known(c: str) -> str:
    return f"CASE WHEN upper({t(c)}) NOT IN {MISSING} THEN {t(c)} END"


def case_map(x: str, labels: dict[str, str], other: str) -> str:
    whens = " ".join(f"WHEN {x} = {q(k)} THEN {q(v)}" for k, v in labels.items())
    return f"CASE {whens} ELSE {other} END"


def is_name(x: str) -> str:
    """Name test on a nullable column."""
    return f"({x} IS NOT NULL AND {words(x)} >= 2 AND NOT regexp_matches({x}, '(?i)\\bSIN\\s+DAT'))"


TITLE_RE = "'^(LIC|PEM)\\.\\s*'"
RURAL_RE = ascii_pattern(R.ADDRESS_MARKERS["rural"])
HOUSE_RE = ascii_pattern(R.ADDRESS_MARKERS["numero de casa (N-N)"])
# One CTE per cleaning step; *_0 are the trimmed cells, null when missing.
STAGE_0 = ", ".join(f"{known(c)} AS {c}_0" for c in R.SOURCE_COLUMNS)
HEAD = "substr(d1, 1, length(d1) - length(MUNICIPIO_0))"
TAIL = "substr(d1, length(d1) - length(MUNICIPIO_0) + 1)"
REST = f"regexp_replace({HEAD}, '[\\s,.-]+$', '')"
CLEAN_CTES = f""",
c0 AS (SELECT *, {STAGE_0} FROM messy),
c1 AS (SELECT *, DEPARTAMENTO_0 = 'CIUDAD CAPITAL' AS capital,
  CASE WHEN DEPARTAMENTO_0 = 'CIUDAD CAPITAL' THEN 'Guatemala' ELSE DEPARTAMENTO_0 END AS dep1,
  nullif(trim(regexp_replace(DIRECCION_0, {ascii_pattern(TRAILING_DATE)}, '')), '') AS d1,
  {phone_numbers("coalesce(TELEFONO_0, '')")} AS tel_all,
  rtrim(regexp_replace(regexp_replace(translate(SUPERVISOR_0, 'ÀÈÌÒÙàèìòù´`', 'ÁÉÍÓÚáéíóú'''''),
    '(\\p{{L}})0', '\\1O', 'g'), '0(\\p{{L}})', 'O\\1', 'g'), ' ,;:') AS sup1,
  regexp_replace(DIRECTOR_0, {TITLE_RE}, '') AS dir1
  FROM c0),
c2 AS (SELECT *, {case_map("dep1", R.DEPARTMENTS, "dep1")} AS dep2,
  CASE WHEN capital THEN 'Guatemala' ELSE MUNICIPIO_0 END AS mun1,
  {case_map(comparison_key("DEPARTAMENTAL_0"), {k: v.upper() for k, v in R.DEPARTMENTS.items()}, "DEPARTAMENTAL_0")} AS div1,
  CASE WHEN MUNICIPIO_0 IS NOT NULL AND length(d1) > length(MUNICIPIO_0)
    AND regexp_matches({HEAD}, '[\\s,]$') AND {unaccented(TAIL)} = {unaccented("MUNICIPIO_0")}
    AND {REST} <> ''
    AND NOT regexp_matches({unaccented(REST)}, {ascii_pattern("(?:" + PLACE_WORD + r")\z")})
    THEN {REST} ELSE d1 END AS d2,
  list_filter(tel_all, lambda n: length(n) IN (7, 8)) AS tels,
  CASE WHEN {is_name("sup1")} THEN sup1 END AS sup2,
  CASE WHEN {is_name("dir1")} THEN dir1 END AS dir2 FROM c1),
c3 AS (SELECT *, regexp_replace(regexp_replace(d2, '^O(\\s+(?:CALLE|AV))', '0\\1'),
  '\\bO([A-Z]?-\\d)', '0\\1', 'g') AS d3 FROM c2),
c4 AS (SELECT *, CASE WHEN NOT (coalesce({unaccented("d3")} = {unaccented("MUNICIPIO_0")}, false)
  OR regexp_matches(d3, '^[\\W_]+$')) THEN d3 END AS d4,
  CASE WHEN len(tels) > 0 THEN TELEFONO_0 END AS tel1,
  nullif(AREA_0, 'SIN ESPECIFICAR') AS area1 FROM c3)
"""
CLEAN_SELECT = f"""SELECT CODIGO_0 AS CODIGO, DISTRITO_0 AS DISTRITO, dep2 AS DEPARTAMENTO,
  mun1 AS MUNICIPIO, div1 AS DEPARTAMENTAL, ESTABLECIMIENTO_0 AS ESTABLECIMIENTO, d4 AS DIRECCION,
  tel1 AS TELEFONO, sup2 AS SUPERVISOR, dir2 AS DIRECTOR, NIVEL_0 AS NIVEL, SECTOR_0 AS SECTOR,
  area1 AS AREA, STATUS_0 AS STATUS, MODALIDAD_0 AS MODALIDAD, JORNADA_0 AS JORNADA, PLAN_0 AS PLAN,
  {DISTRICT} AS DISTRITO_FORMATO,
  coalesce({full("DISTRITO_0", r"\d{2}-")}, false) AS DISTRITO_REVISAR,
  CASE WHEN capital AND {full("MUNICIPIO_0", R.ZONE)} THEN MUNICIPIO_0 END AS ZONA_CAPITAL,
  {name_key("ESTABLECIMIENTO_0")} AS ESTABLECIMIENTO_CLAVE,
  coalesce(area1 <> 'RURAL', false) AND d4 IS NOT NULL
    AND NOT coalesce(regexp_matches(d4, {HOUSE_RE}), false) AS DIRECCION_SIN_NUMERO,
  array_to_string(tels, ' | ') AS TELEFONOS,
  nullif(regexp_extract(coalesce(DIRECTOR_0, ''), {TITLE_RE}, 1), '') AS DIRECTOR_TITULO,
  CASE WHEN capital AND AREA_0 = 'RURAL' THEN
    CASE WHEN regexp_matches({unaccented("coalesce(DIRECCION_0, '')")}, {RURAL_RE})
      THEN 'con respaldo en DIRECCION' ELSE 'sin respaldo' END END AS AREA_REVISION,
  archivo_origen, fila_origen FROM c4"""
assert len(DERIVED_COLUMNS) == 8
ORACLES["clean_rows"] = messy_oracle(CLEAN_CTES + CLEAN_SELECT)

C1_TEXT = "Texto sin espacios extremos; vacio y marcador a NULL"
CHANGES = [
    *[("C1", c, C1_TEXT, c, f"{c}_0") for c in R.SOURCE_COLUMNS],
    ("C4", "DEPARTAMENTO", "CIUDAD CAPITAL al departamento oficial", "DEPARTAMENTO_0", "dep1"),
    ("C5", "DEPARTAMENTO", "Nombre oficial segun diccionario cerrado", "dep1", "dep2"),
    ("C4", "MUNICIPIO", "Zona capitalina a columna propia", "MUNICIPIO_0", "mun1"),
    ("C7", "DEPARTAMENTAL", "Tildes segun catalogo propio", "DEPARTAMENTAL_0", "div1"),
    ("C12", "DIRECCION", "Fecha final recortada", "DIRECCION_0", "d1"),
    ("C11", "DIRECCION", "Municipio final recortado", "d1", "d2"),
    ("C13", "DIRECCION", "Letra O por cero en contexto numerico", "d2", "d3"),
    ("C10", "DIRECCION", "Direccion sin informacion a NULL", "d3", "d4"),
    ("C15", "TELEFONO", "Celda sin numero recuperable a NULL", "TELEFONO_0", "tel1"),
    ("C18", "SUPERVISOR", "Grafias contaminadas corregidas", "SUPERVISOR_0", "sup1"),
    ("C19", "SUPERVISOR", "Nombre ausente a NULL", "sup1", "sup2"),
    ("C20", "DIRECTOR", "Titulo separado del nombre", "DIRECTOR_0", "dir1"),
    ("C19", "DIRECTOR", "Nombre ausente a NULL", "dir1", "dir2"),
    ("C23", "AREA", "SIN ESPECIFICAR a NULL", "AREA_0", "area1"),
]
LOG_SQL = union([
    f"""SELECT {q(v)} AS variable, {q(rule)} AS regla, {q(text)} AS transformacion,
    {count_if(f"{a} IS DISTINCT FROM {b}")} AS filas_afectadas FROM c4"""
    for rule, v, text, a, b in CHANGES
])
ORACLES["transformation_log"] = messy_oracle(CLEAN_CTES + LOG_SQL)

CATALOG_VALUES = """(VALUES ('PETEN', 'LA LIBERTAD', 'La Libertad'), ('PETEN', 'SAN JOSE', 'San José'),
  ('QUICHE', 'COBAN', 'Cobán'), ('IZABAL', 'COBAN', 'Cobán'), ('SOLOLA', 'CHISEC', 'Chisec'),
  ('JALAPA', 'SANTA BARBARA', 'Santa Bárbara')) AS k(d, m, o)"""
ORACLES["clean_municipality"] = messy_oracle(f"""
SELECT archivo_origen, fila_origen, DEPARTAMENTO, coalesce(o, MUNICIPIO) AS MUNICIPIO,
  o IS NOT NULL AS MUNICIPIO_EN_CATALOGO
FROM messy LEFT JOIN {CATALOG_VALUES} ON d = {comparison_key(DEP)} AND m = {comparison_key(MU)}""")
ORACLES["clean_supervisor"] = messy_oracle(f""",
s AS (SELECT archivo_origen, fila_origen,
  CASE WHEN DISTRITO <> '' THEN concat_ws('-', DISTRITO, substr(CODIGO, 9, 2)) ELSE '' END AS DISTRITO,
  CASE WHEN {name_class('SUPERVISOR')} = 'nombre aparente' THEN {t('SUPERVISOR')} END AS nombre FROM messy),
u AS (SELECT DISTRITO AS d, min(nombre) AS unico FROM s WHERE DISTRITO <> ''
  GROUP BY 1 HAVING count(DISTINCT nombre) = 1)
SELECT archivo_origen, fila_origen, DISTRITO, coalesce(nombre, unico) AS SUPERVISOR,
  nombre IS NULL AND unico IS NOT NULL AS SUPERVISOR_IMPUTADO FROM s LEFT JOIN u ON d = DISTRITO""")
ORACLES["clean_person_merge"] = messy_oracle(f""",
p AS (SELECT {t('DIRECTOR')} AS nombre, {t('DEPARTAMENTAL')} AS jur, {name_key(t('DIRECTOR'))} AS clave,
  count(*) AS n FROM messy WHERE {name_class('DIRECTOR')} = 'nombre aparente' AND {t('DEPARTAMENTAL')} <> ''
  GROUP BY ALL),
best AS (SELECT clave, jur, arg_max(nombre, (n, strlen(nombre), nombre)) AS preferido FROM p
  GROUP BY 1, 2 HAVING count(*) > 1)
SELECT archivo_origen, fila_origen, DIRECTOR,
  CASE WHEN {name_class('DIRECTOR')} = 'nombre aparente' THEN coalesce(preferido, {t('DIRECTOR')})
    ELSE nullif({t('DIRECTOR')}, '') END AS DIRECTOR_FUSIONADO
FROM messy LEFT JOIN best ON best.clave = {name_key(t('DIRECTOR'))} AND best.jur = {t('DEPARTAMENTAL')}""")
ORACLES["clean_duplicate_marks"] = messy_oracle(f""",
k AS (SELECT *, {name_key(EST)} AS clave, {t('DEPARTAMENTO')} AS dep, {t('MUNICIPIO')} AS mun FROM messy)
SELECT archivo_origen, fila_origen,
  clave <> '' AND dep <> '' AND mun <> '' AND count(*) OVER (PARTITION BY clave, dep, mun) > 1
    AS CANDIDATO_DUPLICADO,
  clave <> '' AND dep <> '' AND mun <> ''
    AND count(*) OVER (PARTITION BY clave, dep, mun, {t('JORNADA')}, {t('PLAN')}, {t('DIRECCION')}) > 1
    AS CONFIRMADO FROM k""")


# --- validation and before/after -----------------------------------------------------------

def sum_of(conditions: list[str]) -> str:
    return " + ".join(f"CAST(coalesce({c}, false) AS INT)" for c in conditions)


def duplicates_of(table: str) -> str:
    blank = " AND ".join(f"{t(c)} = ''" for c in R.SOURCE_COLUMNS)
    return f"""(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table}
      WHERE NOT ({blank}) GROUP BY {", ".join(f"coalesce({c}, '')" for c in R.SOURCE_COLUMNS)}
      HAVING count(*) > 1))"""


def equivalents_of(table: str) -> str:
    return f"""(SELECT count(*) FROM (SELECT variable, {name_key("valor")}, count(*) FROM
      ({frequency_sql(table, R.CATEGORICAL_COLUMNS, trim=True, share=False)})
      WHERE valor <> '' GROUP BY 1, 2 HAVING count(*) > 1))"""


# The checks of a row by rule and column. What a number and a cast identifier are is written out here.
WORDS = [c for c in R.SOURCE_COLUMNS if c not in ("CODIGO", "DISTRITO", "DIRECCION", "TELEFONO")]
AS_NUMBER = "'^[+-]?[0-9]+([.,][0-9]+)?([eE][+-]?[0-9]+)?$'"
AS_CAST = "'^([0-9]+[.][0-9]+|[0-9]+([.][0-9]+)?[eE][+]?[0-9]+)$'"
CODE = r"'^[0-9]{2}-[0-9]{2}-[0-9]{4}-[0-9]{2}$'"
GOOD_PHONES = f"(len({{n}}) > 0 AND len(list_filter({{n}}, lambda n: length(n) NOT IN (7, 8))) = 0)"


def row_checks_sql() -> list[tuple[str, str, str]]:
    address = "coalesce(DIRECCION, '')"
    good = GOOD_PHONES.format(n=phone_numbers(TEL))
    return [
        *[("V2", c, f"coalesce({c}, '') <> {t(c)}") for c in R.SOURCE_COLUMNS],
        ("V3", "TELEFONO", f"{TEL} <> '' AND NOT {good}"),
        ("V4", "DEPARTAMENTO", f"{DEP} <> '' AND {DEP} NOT IN {in_list(R.DEPARTMENTS.values())}"),
        *[("V5", c, f"regexp_matches({t(c)}, {AS_NUMBER})") for c in WORDS],
        *[("V5", c, f"regexp_matches({t(c)}, {AS_CAST})") for c in ("CODIGO", "DISTRITO", "TELEFONO")],
        *[("V7", c, f"upper({c}) IN {MISSING}") for c in R.SOURCE_COLUMNS],
        *[("V7", c, f"{c} IS NOT NULL AND {name_class(c)} <> 'nombre aparente'") for c in ("SUPERVISOR", "DIRECTOR")],
        ("V7", "DIRECCION", f"{address} <> '' AND {unaccented(address)} = {MUN}"),
        ("V7", "DIRECCION", has(address, TRAILING_DATE)),
        ("V7", "AREA", f"{t('AREA')} = 'SIN ESPECIFICAR'"),
        ("C2 formato", "CODIGO", f"{COD} <> '' AND NOT regexp_matches({COD}, {CODE})"),
    ]


def repeated_codes_sql(table: str) -> str:
    return f"(SELECT {COD} AS c, count(*) AS n FROM {table} WHERE {COD} <> '' GROUP BY 1 HAVING count(*) > 1)"


def misplaced_sql(table: str) -> str:
    seen = f"""(SELECT substr({COD}, 1, 5) AS p, {t('DEPARTAMENTO')} AS d, {t('MUNICIPIO')} AS m, count(*) AS n FROM {table}
      WHERE regexp_matches({COD}, {CODE}) GROUP BY 1, 2, 3)"""
    return f"""(SELECT * FROM {seen} x WHERE p IN (SELECT p FROM {seen} GROUP BY p HAVING count(*) > 1)
      OR (d, m) IN (SELECT (d, m) FROM {seen} GROUP BY d, m HAVING count(*) > 1))"""


def validation_sql(table: str, places: str | None = None) -> str:
    """`places`: the known pairs of department and municipality, as rows."""
    pair = f"({t('DEPARTAMENTO')}, {t('MUNICIPIO')})"
    unknown = "0" if places is None else f"""(SELECT {count_if(f"{t('MUNICIPIO')} <> '' AND {pair} NOT IN ({places})")} FROM {table})"""

    def own(rule: str) -> str:
        conditions = [x for r, _, x in row_checks_sql() if r == rule]
        return f"(SELECT coalesce(sum({sum_of(conditions)}), 0) FROM {table})"

    codes = " + ".join(
        [own("C2 formato")]
        + [f"(SELECT coalesce(sum(n), 0) FROM {x})" for x in (repeated_codes_sql(table), misplaced_sql(table))]
    )
    checks = [
        ("C2", "codigos con formato, unicos y de un solo lugar", codes),
        ("V1", "cero duplicados exactos", duplicates_of(table)),
        ("V2", "cero espacios al inicio o final", own("V2")),
        ("V3", "telefonos en formato aprobado", own("V3")),
        ("V4", "departamentos y municipios en catalogo", f"{own('V4')} + {unknown}"),
        ("V5", "tipos correctos", own("V5")),
        ("V6", "categorias sin variantes equivalentes", equivalents_of(table)),
        ("V7", "valores invalidos del diagnostico en cero", own("V7")),
    ]
    rows = union([
        f"SELECT {q(r)} AS regla, {q(d)} AS descripcion, CAST({n} AS BIGINT) AS violaciones"
        for r, d, n in checks
    ])
    return f"SELECT *, violaciones = 0 AS cumple FROM ({rows})"


PLACES = """('PETEN', 'LA LIBERTAD'),
  ('PETEN', 'SAN JOSE'), ('QUICHE', 'COBAN'), ('IZABAL', 'COBAN'), ('SOLOLA', 'CHISEC'),
  ('JALAPA', 'SANTA BARBARA'), ('QUICHÉ', 'COBÁN'), ('PETEN', 'CHISEC'), ('PETÉN', 'CHISEC')"""
_BLANK_ROW = " AND ".join(f"{t(c)} = ''" for c in R.SOURCE_COLUMNS)
_WHOLE_ROW = ", ".join(f"coalesce({c}, '')" for c in R.SOURCE_COLUMNS)
DIRTY = """, dirty AS (SELECT * REPLACE (CASE WHEN fila_origen % 9 = 0 THEN lower(SECTOR) ELSE SECTOR END AS SECTOR) FROM messy
  UNION ALL SELECT * FROM messy WHERE fila_origen % 40 = 0)\n"""
ORACLES["violations"] = messy_oracle(DIRTY + union([
    *[
        f"SELECT {q(r)} AS regla, {q(c)} AS columna, archivo_origen, fila_origen, {c} AS valor FROM dirty WHERE {x}"
        for r, c, x in row_checks_sql()
    ],
    f"""SELECT 'V1', 'CODIGO', archivo_origen, fila_origen, CODIGO FROM (SELECT *, count(*) OVER (PARTITION BY {_WHOLE_ROW}) AS n
      FROM dirty WHERE NOT ({_BLANK_ROW})) WHERE n > 1""",
    f"SELECT 'C2 unicidad', 'CODIGO', archivo_origen, fila_origen, CODIGO FROM dirty WHERE {COD} IN (SELECT c FROM {repeated_codes_sql('dirty')})",
    f"""SELECT 'C2 lugar', 'CODIGO', archivo_origen, fila_origen, CODIGO FROM dirty WHERE regexp_matches({COD}, {CODE})
      AND (substr({COD}, 1, 5), {t('DEPARTAMENTO')}, {t('MUNICIPIO')}) IN (SELECT (p, d, m) FROM {misplaced_sql('dirty')})""",
    *[
        f"""SELECT 'V6', {q(c)}, archivo_origen, fila_origen, {t(c)} FROM dirty WHERE {t(c)} <> '' AND {name_key(t(c))} IN (
          SELECT {name_key(t(c))} FROM dirty WHERE {t(c)} <> '' GROUP BY 1 HAVING count(DISTINCT {t(c)}) > 1)"""
        for c in R.CATEGORICAL_COLUMNS
    ],
    f"""SELECT 'V4', 'MUNICIPIO', archivo_origen, fila_origen, MUNICIPIO FROM dirty
      WHERE {t('MUNICIPIO')} <> '' AND ({t('DEPARTAMENTO')}, {t('MUNICIPIO')}) NOT IN ({PLACES})""",
]))
ORACLES["validate_raw"] = messy_oracle(validation_sql("messy"))
ORACLES["validate_places"] = messy_oracle(validation_sql("messy", PLACES))
CLEAN_TABLE = f"{CLEAN_CTES}, clean AS MATERIALIZED ({CLEAN_SELECT})\n"
ORACLES["validate_clean"] = messy_oracle(CLEAN_TABLE + validation_sql("clean"))


def metrics_sql(table: str) -> dict[str, str]:
    missing = [f"upper({t(c)}) IN {MISSING}" for c in R.SOURCE_COLUMNS]
    uneven = [
        f"coalesce({c}, '') <> {t(c)} OR {has(f'''coalesce({c}, '')''', chr(92) + 's{2,}')}"
        for c in R.SOURCE_COLUMNS
    ]

    def variables(conditions: list[str]) -> str:
        each = " + ".join(f"max(CAST({c} AS INT))" for c in conditions)
        return f"(SELECT {each} FROM {table})"

    groups = variants_sql(table, EST, f"{EST} <> ''", {"codigos": "CODIGO", "municipios": "MUNICIPIO"})
    values = [
        f"(SELECT count(*) FROM {table})",
        "17",
        f"(SELECT sum({sum_of(missing)}) FROM {table})",
        variables(missing),
        duplicates_of(table),
        f"(SELECT count(*) FROM ({groups}) WHERE municipios = 1)",
        variables(uneven),
        "0",
        equivalents_of(table),
    ]
    return dict(zip(METRICS, values))


BEFORE, AFTER = metrics_sql("messy"), metrics_sql("clean")
ORACLES["before_after"] = messy_oracle(CLEAN_TABLE + union([
    *[
        f"SELECT {q(m)} AS metrica, CAST({BEFORE[m]} AS BIGINT) AS antes, CAST({AFTER[m]} AS BIGINT) AS despues"
        for m in METRICS[:-1]
    ],
    f"""SELECT {q(METRICS[-1])}, 0, CAST((SELECT sum(filas_afectadas) FROM ({LOG_SQL})) AS BIGINT)""",
]))

# --- truncated names ----------------------------------------------------------------------

SHORTENED = f""", shortened AS (SELECT * REPLACE (CASE WHEN fila_origen % 3 = 0
  THEN regexp_replace({t('SUPERVISOR')}, ' [^ ]*$', '') ELSE SUPERVISOR END AS SUPERVISOR) FROM messy
), named AS (SELECT *, CASE WHEN {name_class('SUPERVISOR')} = 'nombre aparente' THEN {name_key(t('SUPERVISOR'))} ELSE '' END AS clave,
  {t('DEPARTAMENTAL')} AS jurisdiccion FROM shortened
), keys AS (SELECT jurisdiccion, clave, count(*) AS n FROM named WHERE clave <> '' AND jurisdiccion <> '' GROUP BY 1, 2
), cut AS (SELECT a.jurisdiccion, a.clave AS corta, b.clave AS completa, a.n AS registros_corta, b.n AS registros_completa
  FROM keys a JOIN keys b ON a.jurisdiccion = b.jurisdiccion AND starts_with(b.clave, a.clave || ' ')
  WHERE contains(a.clave, ' '))
"""
ORACLES["truncated_names"] = messy_oracle(SHORTENED + "SELECT * FROM cut")
ORACLES["clean_truncated_marks"] = messy_oracle(SHORTENED + """
SELECT archivo_origen, fila_origen, SUPERVISOR, n IS NOT NULL AS SUPERVISOR_TRUNCADO,
  CASE WHEN n = 1 THEN completa END AS SUPERVISOR_COMPLETO
FROM named LEFT JOIN (SELECT jurisdiccion, corta, count(*) AS n, min(completa) AS completa FROM cut GROUP BY 1, 2) c
  ON c.jurisdiccion = named.jurisdiccion AND c.corta = named.clave""")

# --- similar texts ------------------------------------------------------------------------

# All pairs of classes that have any shingle in common, counted.
SIMILAR = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '),
    lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5
    THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
), classes AS (SELECT s, min(doc_id) AS clase, CAST(len(s) AS INT) AS n FROM sets GROUP BY s
), tokens AS (SELECT clase, n, unnest(s) AS t FROM classes
), pairs AS (
  SELECT a.clase AS clase_a, b.clase AS clase_b, CAST(count(*) AS INT) AS comunes, a.n AS tamano_a, b.n AS tamano_b
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.clase < b.clase
  GROUP BY a.clase, b.clase, a.n, b.n HAVING 10 * count(*) >= 8 * (a.n + b.n - count(*))
)"""
ORACLES["similar_pairs"] = f"{SIMILAR} SELECT * FROM pairs"
ORACLES["similar_texts"] = f"""{SIMILAR}
SELECT doc_id, clase, (SELECT count(*) FROM pairs WHERE clase IN (clase_a, clase_b)) AS enlaces
FROM sets JOIN classes USING (s)"""
