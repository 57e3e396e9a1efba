"""The registry tools under the names their users know.

The text functions take and return a ``Column``, the reports a ``DataFrame``.
"""

from pyspark.sql import DataFrame, SparkSession

from tamiz.functions.codes import district_class as clasificar_distrito
from tamiz.functions.codes import region_relation as clasificar_relacion_departamental
from tamiz.functions.phone import phone_class as clasificar_telefono
from tamiz.functions.phone import split_numbers as separar_numeros
from tamiz.functions.text import comparison_key as normalizar_comparacion
from tamiz.functions.text import name_key as normalizar_nombre
from tamiz.functions.text import unaccented as sin_tildes
from tamiz.functions.text import words_with_letter as palabras_con_letra
from tamiz.plans.cleaning import limpiar_datos, registro_transformaciones
from tamiz.plans.diagnostics import (
    area_contradice_departamento,
    area_sin_especificar,
    diagnostico_codigo,
    diagnostico_departamental,
    diagnostico_departamento,
    diagnostico_distrito,
    diagnostico_municipio,
    direccion_contaminada,
    direccion_redundante,
    inventario_categorias,
    inventario_escritura,
    jornada_sin_jornada,
    marcadores_direccion,
    nombres_ausentes,
    plan_jerarquia_ambigua,
    resumen_variables,
    telefonos_no_estandar,
    variantes_establecimiento,
    variantes_nombre,
)
from tamiz.plans.registry import GEOGRAPHIC_COLUMNS
from tamiz.plans.reports import (
    generar_reportes,
    informe_calidad,
    libro_de_defectos,
    problemas_geograficos,
    resumen_calidad_categoricas,
)
from tamiz.plans.validation import validar_datos
from tamiz.sources.csv_union import load_text, read_union


def cargar_datos(spark: SparkSession, path: str) -> DataFrame:
    """The unified file as text, with the geographic columns required."""
    return load_text(spark, path, required=GEOGRAPHIC_COLUMNS)


def unir_csv(
    spark: SparkSession, path: str, archivos: int | None = None
) -> DataFrame:
    """Union of the raw files with lineage; `archivos` is the expected number."""
    return read_union(spark, path, expected_files=archivos)


__all__ = [
    "area_contradice_departamento", "area_sin_especificar", "cargar_datos",
    "clasificar_distrito", "clasificar_relacion_departamental", "clasificar_telefono",
    "diagnostico_codigo", "diagnostico_departamental", "diagnostico_departamento",
    "diagnostico_distrito", "diagnostico_municipio", "direccion_contaminada",
    "direccion_redundante", "generar_reportes", "informe_calidad",
    "inventario_categorias", "inventario_escritura", "jornada_sin_jornada",
    "libro_de_defectos", "limpiar_datos", "marcadores_direccion", "nombres_ausentes",
    "normalizar_comparacion", "normalizar_nombre", "palabras_con_letra",
    "plan_jerarquia_ambigua", "problemas_geograficos", "registro_transformaciones",
    "resumen_calidad_categoricas", "resumen_variables", "separar_numeros",
    "sin_tildes", "telefonos_no_estandar", "unir_csv", "validar_datos",
    "variantes_establecimiento", "variantes_nombre",
]
