"""The school registry preset: columns, catalogs, patterns and labels.

Everything below is a fixed value of the data contract; the operators take
them as parameters and work on any other table as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.text import found

# Source columns, in file order, and the two lineage columns.
SOURCE_COLUMNS = [
    "CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO", "DEPARTAMENTAL",
    "ESTABLECIMIENTO", "DIRECCION", "TELEFONO", "SUPERVISOR", "DIRECTOR",
    "NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD", "JORNADA", "PLAN",
]
LINEAGE = ["archivo_origen", "fila_origen"]
EXPECTED_FILES = 23

GEOGRAPHIC_COLUMNS = ["CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO", "DEPARTAMENTAL"]
CATEGORICAL_COLUMNS = ["NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD", "JORNADA", "PLAN"]
DOMAIN_COLUMNS = [
    "DEPARTAMENTO", "NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD",
    "JORNADA", "PLAN", "DEPARTAMENTAL",
]
FIXED_DOMAINS = {
    "SECTOR": ["PRIVADO", "OFICIAL", "COOPERATIVA", "MUNICIPAL"],
    "MODALIDAD": ["MONOLINGUE", "BILINGUE"],
}

# Markers that stand for a missing value, compared in upper case.
MISSING_MARKERS = [
    "", "N/A", "NA", "NULL", "-", ".", "SIN DATO", "S/D", "SD", "NO APLICA", "N.A.",
]

# Columns that hold words: a value that reads as a number has the wrong type.
WORD_COLUMNS = [c for c in SOURCE_COLUMNS if c not in ("CODIGO", "DISTRITO", "DIRECCION", "TELEFONO")]
NUMBER = r"[+-]?\d+([.,]\d+)?([eE][+-]?\d+)?"
# An identifier that was once read as a number: zeros lost, a fraction or an exponent.
CAST_IDENTIFIER = r"\d+\.\d+|\d+(\.\d+)?[eE]\+?\d+"
IDENTIFIERS = ["CODIGO", "DISTRITO", "TELEFONO"]

# Departments as exported and their official spelling.
DEPARTMENTS = {
    "ALTA VERAPAZ": "Alta Verapaz",
    "BAJA VERAPAZ": "Baja Verapaz",
    "CHIMALTENANGO": "Chimaltenango",
    "CHIQUIMULA": "Chiquimula",
    "EL PROGRESO": "El Progreso",
    "ESCUINTLA": "Escuintla",
    "GUATEMALA": "Guatemala",
    "HUEHUETENANGO": "Huehuetenango",
    "IZABAL": "Izabal",
    "JALAPA": "Jalapa",
    "JUTIAPA": "Jutiapa",
    "PETEN": "Petén",
    "QUETZALTENANGO": "Quetzaltenango",
    "QUICHE": "Quiché",
    "RETALHULEU": "Retalhuleu",
    "SACATEPEQUEZ": "Sacatepéquez",
    "SAN MARCOS": "San Marcos",
    "SANTA ROSA": "Santa Rosa",
    "SOLOLA": "Sololá",
    "SUCHITEPEQUEZ": "Suchitepéquez",
    "TOTONICAPAN": "Totonicapán",
    "ZACAPA": "Zacapa",
}
# Departments whose official spelling has an accent.
ACCENTED_DEPARTMENTS = [
    "PETEN", "QUICHE", "SACATEPEQUEZ", "SOLOLA", "SUCHITEPEQUEZ", "TOTONICAPAN",
]
CAPITAL_DEPARTMENT, CAPITAL_MUNICIPALITY = "Guatemala", "Guatemala"
ZONE = r"ZONA \d{1,2}"
ACCENTED_VOWEL = "[ÁÉÍÓÚÜ]"
PHONE_LETTERS = "[A-Za-zÁÉÍÓÚÑáéíóúñ]"

# Category tokens with a meaning of their own.
NO_SHIFT = "SIN JORNADA"
UNSPECIFIED_AREA = "SIN ESPECIFICAR"
RURAL = "RURAL"
GENERIC_PLAN = "SEMIPRESENCIAL"
RARE_PLANS = ["IRREGULAR", "INTERCALADO", "MIXTO"]
TEMPORARY_STATUS = ["TEMPORAL TITULOS", "TEMPORAL NOMBRAMIENTO"]

# Writing patterns of a name, on trimmed text.
WRITING_PATTERNS = {
    "espacios multiples": r"[\s\x1c-\x1f]{2,}",
    "termina en punto": r"\.[\s\x1c-\x1f]*\z",
    "comillas": r"[\"'“”]",
    "parentesis": r"[()]",
    "tiene minusculas": r"[a-z]",
    "tiene tildes": r"[ÁÉÍÓÚÜÑáéíóúüñ]",
    "abreviatura con punto": r"\b[A-ZÑ]{1,4}\.",
    "contiene digitos": r"\d",
    "caracter inusual": r"[^A-ZÑÁÉÍÓÚÜ0-9\s\x1c-\x1f.,\"'()\-/&]",
}

# Address markers, on unaccented upper-case text.
ADDRESS_MARKERS = {
    "numero de casa (N-N)": r"\d+\s*-\s*\d+",
    "via urbana": (
        r"\b(?:CALLE|CALLEJON|AVENIDA|AVDA|AV|CALZADA|CALZ|DIAGONAL|DIAG"
        r"|BULEVAR|BOULEVARD|BLVD|RUTA|VIA)\b"
    ),
    "kilometro": r"\bKM\b|\bKM\.|\bKILOMETRO\b",
    "zona": r"\bZONA\b|\bZ\.?\s*\d",
    "rural": (
        r"\b(?:ALDEA|CASERIO|CASERO|CANTON|PARAJE|FINCA|COMUNIDAD"
        r"|PARCELAMIENTO|MICROPARCELA|PARCELA|SECTOR|COOPERATIVA)\b"
    ),
    "barrio/colonia": r"\b(?:BARRIO|COLONIA|COL\.|RESIDENCIAL|LOTIFICACION|CONDOMINIO)\b",
    "cabecera/casco": r"\bCABECERA\b|\bCASCO\b|\bCENTRO URBANO\b",
    "solo puntuacion": r"\A[\W_]+\z",
}
NO_MARKER = "sin ningun marcador"

# Contamination that leaves a well-formed address, on unaccented text.
CONTAMINATION = {
    "fecha incrustada": r"\d{1,2}[/-]\d{1,2}[/-]\d{2,4}",
    "letra O por cero": r"\AO\s+(?:CALLE|AV)|\bO[A-Z]?-\d",
}

# Titles that precede a person's name.
TITLES = ["LIC", "PEM"]

# Odd characters in person names: zero inside a word, grave accents, acute
# accent used as an apostrophe.
ODD_NAME = r"(?<=\p{L})0|0(?=\p{L})|[ÀÈÌÒÙàèìòù´`]"


def predicates(patterns: dict[str, str]) -> dict[str, Column]:
    """Search predicates on the prepared column ``texto``."""
    return {label: found(F.col("texto"), p) for label, p in patterns.items()}
