"""The messy registry view: one row per order, every defect class reached."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Tasks for every split of a large table: a row of the view is made from eight bytes that are
#: read, and a split holds millions of them.
TASKS_PER_SPLIT = 16
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

MESSY_CTE = """
b AS (
  SELECT o_orderkey AS k, (o_orderkey % 500 = 0) AS e FROM {orders}
), g AS (
  SELECT k, e,
    CASE WHEN e THEN '' WHEN k % 8 = 0 THEN 'GUATEMALA' WHEN k % 8 = 1 THEN 'CIUDAD CAPITAL' WHEN k % 8 = 2 THEN 'PETEN' WHEN k % 8 = 3 THEN 'QUICHE' WHEN k % 8 = 4 THEN 'SOLOLA' WHEN k % 8 = 5 THEN 'IZABAL' WHEN k % 8 = 6 THEN ' JALAPA ' ELSE 'ATLANTIDA' END AS DEPARTAMENTO,
    CASE WHEN e THEN '' WHEN k % 8 = 1 AND k % 40 = 1 THEN 'CIUDAD GUATEMALA' WHEN k % 8 = 1 THEN concat('ZONA ', CAST(k % 25 + 1 AS STRING)) WHEN k % 5 = 0 THEN 'LA LIBERTAD' WHEN k % 5 = 1 THEN 'SAN JOSE' WHEN k % 5 = 2 THEN 'COBÁN' WHEN k % 5 = 3 THEN 'CHISEC' ELSE 'SANTA BARBARA' END AS MUNICIPIO
  FROM b
), messy AS (
SELECT
  CASE WHEN e THEN '' WHEN k % 97 = 1 THEN '01-01-0001-46' WHEN k % 89 = 2 THEN 'A1-01-0001-46' ELSE concat(lpad(CAST(k % 8 + 1 AS STRING), 2, '0'), '-', lpad(CAST(k % 5 + 1 AS STRING), 2, '0'), '-', lpad(CAST(k % 10000 AS STRING), 4, '0'), '-', lpad(CAST(CAST(floor(k / 10000) AS BIGINT) % 100 AS STRING), 2, '0')) END AS CODIGO,
  CASE WHEN e OR k % 6 = 0 THEN '' WHEN k % 6 = 1 THEN '01-' WHEN k % 6 = 2 THEN '16-006' WHEN k % 6 = 3 THEN '16-01-0924' WHEN k % 6 = 4 THEN 'X-9' ELSE concat(lpad(CAST(k % 22 + 1 AS STRING), 2, '0'), '-00', CAST(k % 9 + 1 AS STRING)) END AS DISTRITO,
  DEPARTAMENTO, MUNICIPIO,
  CASE WHEN e THEN '' WHEN k % 8 = 0 AND k % 3 = 0 THEN 'GUATEMALA' WHEN k % 8 = 0 THEN 'GUATEMALA NORTE' WHEN k % 8 = 1 THEN 'GUATEMALA SUR' WHEN k % 8 = 2 THEN 'PETÉN' WHEN k % 8 = 3 AND k % 3 = 0 THEN 'QUICHÉ NORTE' WHEN k % 8 = 3 THEN 'QUICHÉ' WHEN k % 8 = 4 THEN 'SOLOLÁ' WHEN k % 8 = 6 THEN 'JALAPA' ELSE 'IZABAL' END AS DEPARTAMENTAL,
  CASE WHEN e OR k % 9 = 8 THEN '' WHEN k % 9 = 0 THEN 'COLEGIO "LA INMACULADA"' WHEN k % 9 = 1 THEN 'COLEGIO LA INMACULADA' WHEN k % 9 = 2 THEN ' COLEGIO  LA INMACULADA. ' WHEN k % 9 = 3 THEN 'INSTITUTO SAN JOSÉ' WHEN k % 9 = 4 THEN 'INSTITUTO SAN JOSE' WHEN k % 9 = 5 THEN 'Escuela NRO. 5 (Anexo)' WHEN k % 9 = 6 THEN concat('CAÑAS ', CAST(k % 7 AS STRING)) ELSE concat('CANAS ', CAST(k % 7 AS STRING), ' *') END AS ESTABLECIMIENTO,
  CASE WHEN e OR k % 12 = 0 THEN '' WHEN k % 12 = 1 THEN '5A. CALLE 3-50 ZONA 5' WHEN k % 12 = 2 THEN 'ALDEA EL CARMEN' WHEN k % 12 = 3 THEN MUNICIPIO WHEN k % 12 = 4 THEN concat('AVENIDA CENTRAL ', MUNICIPIO) WHEN k % 12 = 5 THEN '12 AV. NORTE 22/02/20' WHEN k % 12 = 6 THEN 'O AV. 0-06' WHEN k % 12 = 7 THEN 'OC-150' WHEN k % 12 = 8 THEN 'KM. 45 RUTA AL NORTE' WHEN k % 12 = 9 THEN '---' WHEN k % 12 = 10 THEN 'BARRIO EL CENTRO' ELSE 'FRENTE AL PARQUE' END AS DIRECCION,
  CASE WHEN e OR k % 20 = 0 THEN '' WHEN k % 20 = 1 THEN '24328801-24329098' WHEN k % 20 = 2 THEN '232-1011' WHEN k % 20 = 3 THEN '24328801-02' WHEN k % 20 = 4 THEN '24328801 EXT 12' WHEN k % 20 = 5 THEN '2432-8801' WHEN k % 20 = 6 THEN '00000000' WHEN k % 20 = 7 THEN '0000000' WHEN k % 20 = 8 THEN '123' WHEN k % 20 = 9 THEN '2432880 24328801' WHEN k % 20 = 10 THEN 'SIN DATO' WHEN k % 20 = 11 THEN '24328801 Y 24329098' ELSE lpad(CAST(k % 90000000 + 10000000 AS STRING), 8, '0') END AS TELEFONO,
  CASE WHEN e OR k % 10 = 9 THEN '' WHEN k % 10 = 0 THEN 'CARLOS GONZÁLEZ DE LEÓN' WHEN k % 10 = 1 THEN 'CARLOS GONZALEZ DE LEON' ELSE concat('ANA PEREZ ', CAST(k % 6 AS STRING)) END AS SUPERVISOR,
  CASE WHEN e OR k % 10 = 9 THEN '' WHEN k % 10 = 0 THEN '---' WHEN k % 10 = 1 THEN '000000' WHEN k % 10 = 2 THEN 'X' WHEN k % 10 = 3 THEN 'SIN DATOS' WHEN k % 10 = 4 THEN 'LIC. ANA PEREZ' WHEN k % 10 = 5 THEN 'JOSÉ VASQUEZ' ELSE 'JOSE VASQUEZ' END AS DIRECTOR,
  CASE WHEN e THEN '' ELSE 'DIVERSIFICADO' END AS NIVEL,
  CASE WHEN e THEN '' WHEN k % 4 = 0 THEN 'PRIVADO' WHEN k % 4 = 1 THEN 'OFICIAL' WHEN k % 4 = 2 THEN 'COOPERATIVA' ELSE 'MUNICIPAL' END AS SECTOR,
  CASE WHEN e THEN '' WHEN k % 50 = 3 THEN 'SIN ESPECIFICAR' WHEN k % 3 = 0 THEN 'RURAL' ELSE 'URBANA' END AS AREA,
  CASE WHEN e THEN '' WHEN k % 7 = 0 THEN 'CERRADA' WHEN k % 7 = 1 THEN 'CERRADA TEMPORALMENTE' WHEN k % 7 = 2 THEN 'TEMPORAL TITULOS' WHEN k % 7 = 3 THEN 'TEMPORAL NOMBRAMIENTO' ELSE 'ABIERTA' END AS STATUS,
  CASE WHEN e THEN '' WHEN k % 13 = 0 THEN 'BILINGUE' ELSE 'MONOLINGUE' END AS MODALIDAD,
  CASE WHEN e THEN '' WHEN k % 11 = 0 THEN 'SIN JORNADA' WHEN k % 2 = 0 THEN 'MATUTINA' ELSE 'VESPERTINA' END AS JORNADA,
  CASE WHEN e THEN '' WHEN k % 1000 = 7 THEN 'MIXTO' WHEN k % 11 = 0 AND k % 3 = 0 THEN 'SEMIPRESENCIAL' WHEN k % 11 = 0 THEN 'SEMIPRESENCIAL (FIN DE SEMANA)' ELSE 'DIARIO' END AS PLAN,
  concat('f', lpad(CAST(k % 23 AS STRING), 2, '0'), '.csv') AS archivo_origen,
  CAST(floor(k / 23) AS BIGINT) + 2 AS fila_origen
FROM g
)"""


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """All cores get work even if the input has fewer splits than cores.

    A table of cluster size has more splits than cores and passes untouched;
    the check reads the plan, not the data.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def short_methods(spark: SparkSession) -> None:
    """Stages of many columns are generated in short methods, unless the session asks for something else.

    Whole-stage code puts all columns of the view into one method, and the JVM interprets methods
    beyond its limit of 8,000 bytes; Spark's own limit is higher.
    """
    if spark.conf.get(METHOD_LIMIT) == "65535":
        spark.conf.set(METHOD_LIMIT, "8000")


def spread_keys(orders: DataFrame) -> DataFrame:
    """Keys in tasks of like size, however the files are cut: the splits of a large table are few
    for their rows, and one may hold several row groups and others none."""
    cores, splits = orders.sparkSession.sparkContext.defaultParallelism, orders.rdd.getNumPartitions()
    return orders.repartition(cores if splits < cores else splits * TASKS_PER_SPLIT, "o_orderkey")


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as a lazy projection of the orders table."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    short_methods(spark)
    return spark.sql(f"WITH {MESSY_CTE} SELECT * FROM messy", orders=spread_keys(orders))


def messy_oracle(body: str) -> str:
    """A query over the same view, as a CTE for the comparison engine."""
    return f"WITH {MESSY_CTE.format(orders='orders')}{body}"
