"""Licence scan by canonical digest.

A text is brought to a canonical form (case, punctuation, white space,
copyright lines and equivalent spellings do not matter) and its digest is
looked up among those of known licences. Whole documents are looked up and, as
texts of their own, each of their lines: notices are mostly one line.
"""

from __future__ import annotations

import re
from importlib import resources
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as the same word.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "licencing": "licensing",
    "sublicence": "sublicense",
    "organisation": "organization",
    "favour": "favor",
    "honour": "honor",
    "whilst": "while",
    "cancelled": "canceled",
    "judgement": "judgment",
    "analogue": "analog",
    "centre": "center",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
}
_YEAR = r"[<\[{(]?(\d{4}|year|yyyy)"
#: Lines that name who holds the rights and are left out. Licence wording that happens to begin a
#: line with "copyright" or an item "(c)" stays: a sign, a year, "by" or a company must follow.
COPYRIGHT_LINE = (
    rf"^\s*(copyright[\s:,]*(\(c\)|©|{_YEAR}|by\s)"
    r"|copyright\s.*\s((19|20)\d\d|inc|llc|ltd|gmbh|corp|corporation|foundation|other contributors)\.?\s*$"
    rf"|\(c\)\s*(copyright\s|{_YEAR}|by\s)|©|all rights reserved\W*$)"
)

#: Names that notices give to licences.
NAMES = {
    "MIT": ("MIT", "MIT License", "MIT License (MIT)", "Expat License"),
    "ISC": ("ISC", "ISC License"),
    "0BSD": ("0BSD", "BSD Zero Clause License", "Zero-Clause BSD License"),
    "BSD-2-Clause": ("BSD-2-Clause", "BSD-2-Clause License", "BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": (
        "BSD-3-Clause", "BSD-3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License",
    ),
    "Zlib": ("Zlib", "zlib License"),
    "BSL-1.0": ("BSL-1.0", "Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "Unlicense": ("Unlicense",),
    "NCSA": ("NCSA", "University of Illinois/NCSA Open Source License"),
    "OFL-1.1": ("OFL-1.1", "SIL Open Font License 1.1", "SIL Open Font License, Version 1.1"),
    "Unicode-3.0": ("Unicode-3.0", "Unicode License v3"),
    "Artistic-1.0-Perl": ("Artistic-1.0-Perl",),
    "Artistic-2.0": ("Artistic-2.0", "Artistic License 2.0"),
    "Apache-2.0": (
        "Apache-2.0", "Apache 2.0", "Apache 2.0 License", "Apache-2.0 License", "Apache License 2.0",
        "Apache License, Version 2.0", "Apache License v2.0",
    ),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal"),
} | {
    f"MPL-{v}": (f"MPL-{v}", f"Mozilla Public License {v}", f"Mozilla Public License, Version {v}", f"Mozilla Public License v{v}")
    for v in ("1.1", "2.0")
} | {
    f"EPL-{v}": (f"EPL-{v}", f"Eclipse Public License {v}", f"Eclipse Public License v{v}", f"Eclipse Public License, Version {v}")
    for v in ("1.0", "2.0")
}
for _code, _title, _versions in (
    ("GPL", "GNU General Public License", ("1.0", "2.0", "3.0")),
    ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
    ("LGPL", "GNU Library General Public License", ("2.0",)),
    ("AGPL", "GNU Affero General Public License", ("3.0",)),
    ("GFDL", "GNU Free Documentation License", ("1.2", "1.3")),
):
    for _v in _versions:
        _shorts = {_v, _v.removesuffix(".0")}
        _long = [f"{_title}{sep}{v}" for v in _shorts for sep in (" ", ", version ", " v")]
        _short = [f"{p}{_code}{sep}{v}" for p in ("", "GNU ") for v in _shorts for sep in ("-", "v")]
        NAMES[f"{_code}-{_v}"] = (*_long, *_short, f"{_code}-{_v}-only")
        NAMES[f"{_code}-{_v}-or-later"] = (f"{_code}-{_v}-or-later", *(f"{n}{e}" for n in _long for e in (" or later", " or any later version")))
for _code, _title in (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
):
    for _v, _port in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        _cc = [f"CC {_code} {_v}", f"CC {_code} {_v} {_port}", f"CC {_code} {_v} License"]
        _long = [f"Creative Commons {_title} {_v}", f"Creative Commons {_title} {_v} {_port}"]
        NAMES[f"CC-{_code}-{_v}"] = (*_cc, *_long, *(f"{n} License" for n in _long))
#: How a notice comes to the name.
NOTICES = (
    "License: ",
    "SPDX-License-Identifier: ",
    *(
        " ".join(x).lstrip() + " "
        for x in product(
            ("", "This work is", "This project is", "This software is"),
            ("licensed under", "released under", "distributed under"),
            ("", "the", "a"),
        )
    ),
)
#: Titles that a text without one may get.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT", "Expat License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
#: How many lines with words are the title of a text in ``licenses``.
TITLE_LINES = {
    "Apache": 3, "Artistic": 1, "CC-BY": 1, "CC0": 2, "GFDL": 2, "GPL": 2, "LGPL": 2, "MPL-1.1": 2, "MPL-2.0": 1, "OFL": 2, "Unicode": 2,
}


def _published() -> list[tuple[str, str]]:
    """The texts in ``licenses`` (name.txt, a further layout name.2.txt), each with and without title and appendix.

    An appendix is what follows the end of the terms; links are taken with https and http.
    """
    found = []
    for file in sorted(resources.files("tamiz.llm").joinpath("licenses").iterdir(), key=lambda f: f.name):
        name = file.name.removesuffix(".txt").removesuffix(".2")
        lines = file.read_text("utf-8").split("\n")
        worded = [i for i, line in enumerate(lines) if any(map(str.isalnum, line))]
        body = worded[next((n for start, n in TITLE_LINES.items() if name.startswith(start)), 0)]
        end = next((i + 1 for i, line in enumerate(lines) if line.strip() == "END OF TERMS AND CONDITIONS"), len(lines))
        for a, b in product({0, body}, {end, len(lines)}):
            text = "\n".join(lines[a:b])
            found += [(name, t) for t in {text, text.replace("https://", "http://")}]
    return found


def _notices() -> list[tuple[str, str]]:
    """Every name in every notice, once for spellings that differ in punctuation alone."""
    pairs = ((name, notice + spelled) for name, many in NAMES.items() for spelled in many for notice in NOTICES)
    return list({(name, re.sub(r"[\W_]+", " ", text.lower())): (name, text) for name, text in pairs}.values())


#: Names and texts of common licences and notices.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
        THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
        ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    *_notices(),
    *_published(),
)
KNOWN += tuple((name, f"{title}\n{text}") for name, text in KNOWN if "\n" in text for title in TITLES.get(name, ()))


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN), "license string, text string")


def canonical(text: Column) -> Column:
    """Lower-cased words with one blank between, in one spelling, without copyright lines; null gives ''."""
    lines = F.filter(
        F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"), lambda line: ~line.rlike(COPYRIGHT_LINE)
    )
    plain = F.regexp_replace(F.array_join(lines, " "), r"[^\p{L}\p{N}]+", " ")
    spaced = F.concat(F.lit(" "), F.replace(F.trim(plain), F.lit(" "), F.lit("  ")), F.lit(" "))
    for spelling, common in SPELLINGS.items():
        one, other = (f" {x.replace(' ', '  ')} " for x in (spelling, common))
        spaced = F.replace(spaced, F.lit(one), F.lit(other))
    return F.trim(F.replace(spaced, F.lit("  "), F.lit(" ")))


def scan(
    docs: DataFrame, known: DataFrame, broadcast_rows: int = 100_000, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, scope, line, license): every known licence that a whole text (line 0) or one of its lines equals.

    ``scope`` is 'text' or 'line'; lines count from 1. ``known`` (license,
    text) is made canonical likewise and broadcast if it has at most
    ``broadcast_rows`` digests. Texts without a word match nothing; texts of
    one line can match in both scopes. Repeated rows give their matches again,
    null ids stay null; a text known by two names gives both; empty tables give
    no rows.
    """
    digests = known.select(F.md5(canonical(F.col("text"))).alias("digest"), "license")
    digests = digests.where(canonical(F.col("text")) != "").distinct()
    if digests.limit(broadcast_rows + 1).count() <= broadcast_rows:
        digests = F.broadcast(digests)
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    units = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.posexplode(F.concat(F.array(value), F.split(value, "\n"))).alias("line", "unit"),
    )
    marked = units.select("doc_id", "line", F.md5(canonical(F.col("unit"))).alias("digest"))
    scope = F.when(F.col("line") == 0, "text").otherwise("line")
    return marked.join(digests, "digest").select("doc_id", scope.alias("scope"), "line", "license")
