"""Text functions against the Python semantics they stand for."""

import re
import sys
import unicodedata

from pyspark.sql import functions as F

from tamiz.functions import text as T
from tamiz.functions.folding import UNUSUAL_RANGES, fold, fold_tables


def python_fold(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def test_fold_equals_decomposition_for_every_character(spark, rows_of):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    cells = ["".join(chars[i : i + 200]) for i in range(0, len(chars), 200)]
    df = rows_of([(s,) for s in cells], "s string").select("s", fold(F.col("s")).alias("f"))
    assert [r.s for r in df.collect() if r.f != python_fold(r.s)] == []


def test_characters_outside_the_short_class_never_expand():
    assert all(
        any(a <= ord(c) <= b for a, b in UNUSUAL_RANGES) for c in fold_tables().expansions
    )


def test_strip_and_words_follow_python(rows_of):
    letter = re.compile(T.LETTER)
    cells = [
        "", " ", "\t a \n", " x ", "\x1c y \x1f", "uno  dos", "-- 00 X", "ana-maría 3b",
        "ü", "Ü ü", "a\x1db", "sin\nsalto ",
    ]
    df = rows_of([(s,) for s in cells], "s string").select(
        "s", T.trimmed(F.col("s")).alias("t"), T.words_with_letter(F.col("s")).alias("w"),
        T.has_inner_run(T.trimmed(F.col("s"))).alias("r"),
    )
    for row in df.collect():
        assert row.t == row.s.strip()
        assert row.w == sum(bool(letter.search(x)) for x in row.s.split())
        assert row.r == bool(re.search(r"\s{2,}", row.s.strip()))


def test_keys(rows_of):
    cases = {
        'CAÑAS "A" 3-50': ('CANAS "A" 3-50', "CANAS A 3 50", 'CANAS "A" 3-50'),
        "  josé   peña. ": ("JOSE PENA.", "JOSE PENA", "  JOSE   PENA. "),
        '"…"': ('"..."', "", '"..."'),
        "ß ﬁ ½": ("SS FI 1⁄2", "SS FI 1 2", "SS FI 1⁄2"),
    }
    df = rows_of([(s,) for s in cases], "s string").select(
        "s", T.comparison_key(F.col("s")).alias("a"), T.name_key(F.col("s")).alias("b"),
        T.unaccented(F.col("s")).alias("c"),
    )
    for row in df.collect():
        assert (row.a, row.b, row.c) == cases[row.s]
        assert row.b == re.sub(r"[^A-Z0-9]+", " ", python_fold(row.s).upper()).strip()


def test_null_is_blank_and_full_match_refuses_a_final_newline(rows_of):
    df = rows_of([(None, "12\n"), ("  ", "12"), ("x", "٣4")], "a string, b string").select(
        T.is_blank(F.col("a")).alias("blank"), T.full_match(F.col("b"), r"\d{2}").alias("full")
    )
    assert [(r.blank, r.full) for r in df.collect()] == [(True, False), (True, True), (False, True)]


def test_digest_tells_null_from_blank_and_order(rows_of):
    data = [(None, "a"), ("", "a"), ("a", None), ("a", ""), ("a", "a")]
    df = rows_of(data, "x string, y string").select(*T.digest(F.col("x"), F.col("y")))
    assert df.distinct().count() == len(data)


def test_percentage_of_nothing_is_null(spark):
    row = spark.range(0).agg(T.percentage(F.count("*"), F.count("*")).alias("p")).first()
    assert row.p is None
