"""Literal cases of every classifier."""

import pytest
from pyspark.sql import functions as F

from tamiz.functions import codes as C
from tamiz.functions import phone as P

PHONES = {
    "": ([], "vacio"),
    "24328801": (["24328801"], "valido"),
    "24328801-24329098": (["24328801", "24329098"], "varios numeros"),
    "232-1011": (["2321011"], "numero legado de 7 digitos"),
    "24328801-02": (["24328801", "24328802"], "varios numeros"),
    "2432880-1": (["2432880", "2432881"], "varios numeros"),
    "24328801 EXT 12": (["24328801"], "incluye extension"),
    "24328801EXT12": (["2432880112"], "no interpretable"),
    "EXT. 5": ([], "incluye extension"),
    "2432-8801": (["24328801"], "un numero de 8 digitos mal formateado"),
    "00000000": ([], "valido"),
    "0000000": ([], "incluye placeholder de ceros"),
    "123": (["123"], "no interpretable"),
    "2432880 24328801": (["24328802", "4328801"], "varios numeros"),
    "SIN DATO": ([], "sin numeros recuperables"),
    "24328801 Y 24329098": (["24328801", "24329098"], "varios numeros"),
    "24328801y24329098": (["24328801", "24329098"], "varios numeros"),
    "24328801 , 24329098 / 7": (["24328801", "24329098", "7"], "no interpretable"),
    "2" * 28: (["2" * 7] * 4, "varios numeros"),
    "2" * 40: (["2" * 40], "no interpretable"),
    "2" * 56: (["2" * 56], "no interpretable"),
}


def test_phones(rows_of):
    df = rows_of([(s,) for s in PHONES], "s string").select(
        "s", P.split_numbers(F.col("s")).alias("n"), P.phone_class(F.col("s")).alias("c")
    )
    assert {r.s: (r.n, r.c) for r in df.collect()} == PHONES


def test_null_phone(rows_of):
    df = rows_of([(None,)], "s string")
    row = df.select(P.split_numbers(F.col("s")).alias("n"), P.phone_class(F.col("s")).alias("c")).first()
    assert (row.n, row.c) == ([], "vacio")


@pytest.mark.parametrize(
    "build, cases",
    [
        (
            C.district_class,
            {
                "": "vacio", " 01- ": "incompleto", "16-006": "formato corto NN-NNN",
                "16-01-0924": "formato extendido NN-NN-NNNN", "X-9": "otro formato",
                "16-0060": "otro formato",
            },
        ),
        (
            C.name_class,
            {
                "": "vacia", "---": "solo simbolos", "000000": "solo simbolos",
                "X": "un solo token", "SIN DATOS": "frase de ausencia",
                "sin  datos (x)": "frase de ausencia", "LIC. ANA PEREZ": "nombre aparente",
            },
        ),
    ],
)
def test_exclusive_classes(rows_of, build, cases):
    df = rows_of([(s,) for s in cases], "s string").select("s", build(F.col("s")).alias("c"))
    assert {r.s: r.c for r in df.collect()} == cases


def test_region_relation(rows_of):
    cases = {
        ("JALAPA ", "JALAPA"): "coincidencia exacta",
        ("", ""): "coincidencia exacta",
        ("PETEN", "PETÉN"): "solo difiere por tildes",
        ("CIUDAD CAPITAL", "GUATEMALA SUR"): "subdivision administrativa",
        ("QUICHE", "QUICHÉ NORTE"): "subdivision administrativa",
        ("PETEN", "GUATEMALA SUR"): "otra relacion",
        (None, None): "coincidencia exacta",
    }
    df = rows_of(list(cases), "a string, b string").select(
        "a", "b", C.region_relation(F.col("a"), F.col("b")).alias("c")
    )
    assert {(r.a, r.b): r.c for r in df.collect()} == cases
