"""Structure classes of codes, pairs of regions, and person names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.folding import let
from tamiz.functions.text import (
    SPACE,
    comparison_key,
    found,
    full_match,
    trimmed,
    words_with_letter,
)

# Code formats and class labels.
SCHOOL_CODE = r"\d{2}-\d{2}-\d{4}-\d{2}"
PREFIX_LENGTH = 5
INCOMPLETE_DISTRICT = r"\d{2}-"
DISTRICT_FORMATS = {
    "incompleto": INCOMPLETE_DISTRICT,
    "formato corto NN-NNN": r"\d{2}-\d{3}",
    "formato extendido NN-NN-NNNN": r"\d{2}-\d{2}-\d{4}",
}
DISTRICT_CLASSES = ("vacio", *DISTRICT_FORMATS, "otro formato")
CAPITAL = "CIUDAD CAPITAL"
SAME, ACCENTS_ONLY = "coincidencia exacta", "solo difiere por tildes"
SUBDIVISION, OTHER_RELATION = "subdivision administrativa", "otra relacion"
ABSENCE_PHRASE = rf"\bSIN{SPACE}+DAT"
NAME_CLASSES = (
    "vacia", "solo simbolos", "un solo token", "frase de ausencia", "nombre aparente",
)


def format_class(
    column: Column,
    formats: dict[str, str],
    blank: str = "vacio",
    other: str = "otro formato",
) -> Column:
    """Label of the first format that covers the whole cell."""
    text = trimmed(column)
    chain = F.when(text == "", blank)
    for label, pattern in formats.items():
        chain = chain.when(full_match(text, pattern), label)
    return chain.otherwise(other)


def district_class(column: Column) -> Column:
    return format_class(column, DISTRICT_FORMATS)


def code_prefix(column: Column, length: int = PREFIX_LENGTH) -> Column:
    return F.substring(trimmed(column), 1, length)


def region_relation(department: Column, division: Column) -> Column:
    """How an administrative division relates to its department (F8)."""
    dep, div = trimmed(department), trimmed(division)

    def by_keys(keys: Column) -> Column:
        dep_key, div_key = keys["dep"], keys["div"]
        part_of_capital = dep.isin("GUATEMALA", CAPITAL) & div_key.startswith("GUATEMALA ")
        north = (dep_key == "QUICHE") & (div_key == "QUICHE NORTE")
        return (
            F.when(dep_key == div_key, ACCENTS_ONLY)
            .when(part_of_capital | north, SUBDIVISION)
            .otherwise(OTHER_RELATION)
        )

    keys = F.struct(comparison_key(dep).alias("dep"), comparison_key(div).alias("div"))
    return F.when(dep == div, SAME).otherwise(let(keys, by_keys))


def has_absence_phrase(text: Column) -> Column:
    return found(text, ABSENCE_PHRASE, "iU")


def name_class(column: Column) -> Column:
    """One of five exclusive classes, from blank to apparent name (D-07)."""
    text = trimmed(column)
    words = words_with_letter(text)
    return (
        F.when(text == "", NAME_CLASSES[0])
        .when(words == 0, NAME_CLASSES[1])
        .when(words == 1, NAME_CLASSES[2])
        .when(has_absence_phrase(text), NAME_CLASSES[3])
        .otherwise(NAME_CLASSES[4])
    )


def is_name(column: Column) -> Column:
    return name_class(column) == NAME_CLASSES[4]
