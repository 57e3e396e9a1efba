"""Text accessors, predicates and comparison keys.

Null and blank are the same thing everywhere: each function starts from
``plain``, which turns a null into "". Trimming and ``\\s`` follow the Unicode
definition of white space, of which Spark's ``trim`` knows only the space.
"""

from __future__ import annotations

import sys
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.folding import fold

# Every white-space character (from a rule: what str.isspace accepts).
BLANKS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
# The same set as a regex class; Java's \s leaves out the four separators.
SPACE = r"[\s\x1c-\x1f]"


def plain(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _solid(char: Column) -> Column:
    """Begins with a visible ASCII character; compares bytes and makes no new text."""
    return (char >= "!") & (char < "\x7f")


def trimmed(column: Column) -> Column:
    """The cell as text without white space at its ends, "" for null.

    `strip` looks up both ends in the list of all white space, which takes longer than
    most rules; texts that begin and end with a visible ASCII character need not go there.
    """
    text = plain(column)
    ends = _solid(text) & _solid(F.substring(text, -1, 1))
    return F.when(ends | (text == ""), text).otherwise(strip(text))


def is_blank(column: Column) -> Column:
    return trimmed(column) == ""


def all_blank(columns: list[Column]) -> Column:
    return reduce(and_, [is_blank(c) for c in columns])


def found(text: Column, pattern: str, flags: str = "U") -> Column:
    """The pattern occurs anywhere in the text, with Unicode classes."""
    return text.rlike(f"(?{flags}){pattern}")


def full_match(text: Column, pattern: str) -> Column:
    """The pattern covers the whole text; `$` would let a newline slip through."""
    return text.rlike(rf"(?U)\A(?:{pattern})\z")


def has_edge_space(column: Column) -> Column:
    text = plain(column)
    ends = _solid(text) & _solid(F.substring(text, -1, 1))
    return (text != "") & ~ends & (text != strip(text))


def has_inner_run(text: Column) -> Column:
    return found(text, SPACE + "{2,}")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U){SPACE}+", " ")


def unaccented(text: Column) -> Column:
    """Accents dropped and upper case, punctuation kept."""
    return F.upper(fold(text))


def comparison_key(text: Column) -> Column:
    """Accents dropped, upper case, single spaces, punctuation kept (F1)."""
    return strip(collapse_spaces(unaccented(text)))


def name_key(text: Column) -> Column:
    """Only A-Z, 0-9 and single spaces; groups spellings of one name (F2)."""
    return F.btrim(F.regexp_replace(unaccented(text), "[^A-Z0-9]+", " "))


# Letters that make a token count as a word (no lower-case u with
# diaeresis, as in the data contract).
LETTER = "[A-Za-zÑÁÉÍÓÚÜáéíóúñ]"


def words_with_letter(text: Column) -> Column:
    """How many white-space separated tokens hold at least one letter.

    A match starts at the first letter of a token and runs to its end.
    """
    return F.regexp_count(text, F.lit(rf"(?U){LETTER}[^\s\x1c-\x1f]*"))


def percentage(count: Column, total: Column, places: int = 2) -> Column:
    """Share in percent of all rows; null when there are none."""
    return F.round(F.lit(100.0) * count / F.nullif(total, F.lit(0)), places)


def digest(*columns: Column) -> list[Column]:
    """128-bit fingerprint as two longs; nulls are told apart from any value.

    Sixteen bytes travel through a shuffle in place of the values, and both
    parts are fixed-width, which keeps hash aggregation in generated code.
    """
    parts = [p for c in columns for p in (c.isNull(), c)]
    return [
        F.xxhash64(F.lit(seed), *parts).alias(name)
        for seed, name in ((1, "h1"), (2, "h2"))
    ]
