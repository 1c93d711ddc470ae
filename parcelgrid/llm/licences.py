"""Licence scans: Dice coefficient over word bigrams against licence templates.

Compared are the lines of a text, its paragraphs of several lines (cut at blank
lines) and the whole text. A unit is put in lower case (A-Z) and cut into words
of ASCII letters and digits; its bigrams are a set. Dice can reach ``least``
only if the sizes of the two sets are within a factor of (2 - least) / least,
so templates sorted by size are cut down to a short run before any comparison.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelgrid.llm.licence_texts import FULL_TEXTS
from parcelgrid.llm.texts import slices, utf8

LEAST = Fraction(4, 5)
TOKEN = re.compile(rb"[a-z0-9]+")
BLANK_LINE = re.compile(rb"\n[ \t\r]*\n")

# Notices, headers and full texts of public licences, by name.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
}

#: Names and versions as short notices and headers write them.
GNU = {
    "GPL-2.0": ("General Public License", "2"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
    "AGPL-3.0": ("Affero General Public License", "3"),
}
CREATIVE_COMMONS = {
    f"CC-{code}-{version}": (code, words, version)
    for code, words in {
        "BY": "Attribution",
        "BY-SA": "Attribution-ShareAlike",
        "BY-NC": "Attribution-NonCommercial",
        "BY-ND": "Attribution-NoDerivatives",
        "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
        "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    }.items()
    for version in ("3.0", "4.0")
}
REACH = {"3.0": "Unported", "4.0": "International"}
RELEASED = {
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "BSL-1.0": "Boost Software License, Version 1.0",
    "ISC-short": "ISC License",
    "MPL-1.1": "Mozilla Public License, Version 1.1",
    "MPL-2.0": "Mozilla Public License, Version 2.0",
    "Unlicense": "Unlicense",
    "Zlib": "zlib License",
    "Artistic-1.0": "Artistic License 1.0",
    "Artistic-2.0": "Artistic License 2.0",
}


def gnu_header(licence: str, version: str) -> str:
    """The header for source files with one GNU licence named in it."""
    found = NOTICES["GPL-3.0-header"].replace("version 3 of", f"version {version} of")
    # up to 2.1, the lesser licence speaks of a library
    found = found.replace("This program", "This library") if version == "2.1" else found
    return found.replace("General Public License", licence)


TEMPLATES = {
    **NOTICES,
    **{
        name: f"This work is licensed under the GNU {licence}, version {version}."
        for name, (licence, version) in GNU.items()
    },
    **{f"{name}-header": gnu_header(licence, version) for name, (licence, version) in GNU.items()},
    **{f"{name}-short": f"Licensed under CC {code} {version}." for name, (code, _, version) in CREATIVE_COMMONS.items()},
    **{
        f"{name}-notice": f"This work is licensed under a Creative Commons {words} {version} {REACH[version]} License."
        for name, (_, words, version) in CREATIVE_COMMONS.items()
    },
    **{name: f"Released under the {licence}." for name, licence in RELEASED.items()},
    **{f"{name}-licensed": f"Licensed under the {licence}." for name, licence in RELEASED.items()},
    "MIT-licensed": "Licensed under the MIT License.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "BSL-1.0-header": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy "
        "at http://www.boost.org/LICENSE_1_0.txt)"
    ),
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "CC0-1.0-short": "Licensed under CC0 1.0.",
    **FULL_TEXTS,
}
#: A licence may have one text under two names; the first stays.
_seen: set[str] = set()
TEMPLATES = {n: t for n, t in TEMPLATES.items() if t not in _seen and not _seen.add(t)}


def bigrams(unit: bytes) -> set[tuple[bytes, bytes]]:
    words = TOKEN.findall(unit.lower())
    return set(zip(words, words[1:]))


class Templates:
    """Bigram sets in order of size."""

    def __init__(self, texts: dict[str, str], least: Fraction) -> None:
        found = sorted((len(b), name, b) for name, text in texts.items() if (b := bigrams(text.encode())))
        self.sizes = [size for size, _, _ in found]
        self.names = [name for _, name, _ in found]
        self.sets = [own for _, _, own in found]
        self.least = least
        self.fewest = min((self.bounds(size)[0] for size in self.sizes), default=0)

    def bounds(self, size: int) -> tuple[Fraction, Fraction]:
        """Sizes of a set that can reach the least coefficient with one of ``size``."""
        ratio = self.least / (2 - self.least)
        return size * ratio, size / ratio

    def matches(self, unit: bytes) -> list[tuple[float, str]]:
        """Coefficient and name of each template that the unit reaches."""
        own = bigrams(unit)
        low, high = self.bounds(len(own))
        run = range(bisect_left(self.sizes, low), bisect_right(self.sizes, high)) if own else ()
        found = []
        for i in run:
            common = len(own & self.sets[i])
            if 2 * common >= self.least * (len(own) + self.sizes[i]):
                found.append((2.0 * common / (len(own) + self.sizes[i]), self.names[i]))
        return found


def units(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Number of the first line, from 1, and text of each unit."""
    lines = text.split(b"\n")
    yield from enumerate(lines, 1)
    if len(lines) > 1:
        yield 1, text
        at, paragraphs = 1, BLANK_LINE.split(text)
        gaps = [gap.count(b"\n") for gap in BLANK_LINE.findall(text)]
        for number, paragraph in enumerate(paragraphs):
            inner = paragraph.count(b"\n")
            if inner and len(paragraphs) > 1:
                yield at, paragraph
            at += inner + (gaps[number] if number < len(gaps) else 0)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    least: Fraction = LEAST,
) -> DataFrame:
    """``id, licence, dice, line, n_matches``, one row per row of ``docs``.

    ``licence`` is the template of the highest coefficient, the first by name
    among equals; ``line`` the first line of the first unit that reaches it;
    ``n_matches`` counts pairs of unit and template at or above ``least``.
    Without a match, as for null and empty texts, they are null and 0. Repeated
    rows repeat, an empty table gives no rows, other columns are not looked at.
    """
    table = Templates(templates, least)
    source = docs.select(docs[id_col].alias(id_col), docs[text_col].cast("string").alias("_text"))
    schema = T.StructType(
        [source.schema[id_col], *T._parse_datatype_string("licence string, dice double, line long, n_matches long")]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            rows = []
            for text in utf8(part.column("_text")):
                found = [(-dice, name, line) for line, unit in units(text) for dice, name in table.matches(unit)]
                dice, name, line = min(found, default=(None, None, None))
                rows.append((name, dice and -dice, line, len(found)))
            columns = list(zip(*rows))
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), *(pa.array(c, kind) for c, kind in zip(columns, kinds))], schema.names
            )

    return source.mapInArrow(find, schema)
