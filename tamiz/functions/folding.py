"""Accent folding: compatibility decomposition without combining marks.

Spark has no ``normalize`` function. The decomposition of a character never
depends on its neighbours once combining marks are dropped, so folding is a
character map. The map is derived from ``unicodedata`` on first use:

* characters that fold to one character or to none go to ``translate``;
* characters that fold to several (fractions, ligatures, the ellipsis, ...) go
  to a literal map that is consulted only for cells holding such a character;
* Hangul syllables are split by the arithmetic of the Unicode standard.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the Unicode standard for Hangul syllable decomposition.
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
LEADS = "".join(chr(0x1100 + i) for i in range(19))
VOWELS = "".join(chr(0x1161 + i) for i in range(21))
TAILS = "".join(chr(0x11A8 + i) for i in range(27))

ENTRY, PAIR = "\u0001", "\u0002"

# Every character that expands lies in here. This short class is tried first,
# as the full one has some two hundred ranges and is ten times slower.
UNUSUAL_RANGES = ((0xBC, 0xBE), (0x132, sys.maxunicode))
UNUSUAL = "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in UNUSUAL_RANGES) + "]"


def fold_character(char: str) -> str:
    decomposed = unicodedata.normalize("NFKD", char)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


@dataclass(frozen=True)
class FoldTables:
    source: str
    target: str
    expansions: dict[str, str]

    @property
    def expansion_class(self) -> str:
        """Regex class of all characters that fold to several characters."""
        codes = sorted(map(ord, self.expansions))
        spans = [[HANGUL_FIRST, HANGUL_LAST]]
        for code in codes:
            if spans[-1][1] + 1 == code:
                spans[-1][1] = code
            else:
                spans.append([code, code])
        return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans) + "]"


@lru_cache(maxsize=1)
def fold_tables() -> FoldTables:
    single, dropped, expansions = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if HANGUL_FIRST <= code <= HANGUL_LAST:
            continue
        if not unicodedata.decomposition(char) and not unicodedata.combining(char):
            continue
        folded = fold_character(char)
        if folded == char:
            continue
        if not folded:
            dropped.append(char)
        elif len(folded) == 1:
            single.append((char, folded))
        else:
            expansions[char] = folded
    source = "".join(c for c, _ in single) + "".join(dropped)
    return FoldTables(source, "".join(f for _, f in single), expansions)


def _expand(char: Column) -> Column:
    tables = fold_tables()
    lookup = F.str_to_map(
        F.lit(ENTRY.join(c + PAIR + f for c, f in tables.expansions.items())),
        F.lit(ENTRY),
        F.lit(PAIR),
    )
    index = F.ascii(char) - HANGUL_FIRST
    tail = index % 28
    hangul = F.concat(
        F.substring(F.lit(LEADS), F.floor(index / 588).cast("int") + 1, F.lit(1)),
        F.substring(F.lit(VOWELS), F.floor(index % 588 / 28).cast("int") + 1, F.lit(1)),
        F.when(tail > 0, F.substring(F.lit(TAILS), tail, F.lit(1))).otherwise(""),
    )
    return F.when(index.between(0, HANGUL_LAST - HANGUL_FIRST), hangul).otherwise(
        F.coalesce(F.try_element_at(lookup, char), char)
    )


def let(value: Column, body) -> Column:
    """`body(value)` with the value worked out once, however often it is used.

    Keeps nested expressions linear in size; without it each level would
    repeat its whole input, at run time and in the plan.
    """
    return F.transform(F.array(value), body)[0]


def _fold_accented(text: Column) -> Column:
    tables = fold_tables()
    # Texts without unusual characters need the short begin of the table alone: the engine
    # compares the whole table with the one it used last, for every text.
    few = sum(ord(c) < UNUSUAL_RANGES[1][0] for c in tables.source[: len(tables.target)])
    expanded = F.when(
        text.rlike(tables.expansion_class),
        F.array_join(F.transform(F.split(text, ""), _expand), ""),
    ).otherwise(text)
    return F.when(
        text.rlike(UNUSUAL), F.translate(expanded, tables.source, tables.target)
    ).otherwise(F.translate(text, tables.source[:few], tables.target[:few]))


def fold(text: Column) -> Column:
    """Decompose and drop combining marks; pure ASCII cells pass untouched."""
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(
        let(text, _fold_accented)
    )
