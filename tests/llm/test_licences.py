import random
import re
from fractions import Fraction

from helpers import rows_of, sentence

from parcelgrid.llm import licences as L


def grams(text):
    own = re.findall("[a-z0-9]+", "".join(c.lower() if c.isascii() else c for c in text))
    return set(zip(own, own[1:]))


def brute(text):
    if text is None:
        return None, None, None, 0
    lines = text.split("\n")
    units = list(enumerate(lines, 1))
    if len(lines) > 1:
        units.append((1, text))
        at, parts = 1, re.split("\n[ \t\r]*\n", text)
        for part in parts:
            if "\n" in part and len(parts) > 1:
                units.append((at, part))
            at += part.count("\n") + 2
    found = []
    for line, unit in units:
        for name, template in L.TEMPLATES.items():
            a, b = grams(unit), grams(template)
            if a and Fraction(2 * len(a & b), len(a) + len(b)) >= Fraction(4, 5):
                found.append((-2.0 * len(a & b) / (len(a) + len(b)), name, line))
    best = min(found, default=None)
    return (best[1], -best[0], best[2], len(found)) if best else (None, None, None, 0)


def test_against_all_templates(spark, docs, empty, clashing):
    rng = random.Random(4)
    texts = list(L.TEMPLATES.values())
    texts += [t.upper().replace(" ", "\n", 3) for t in L.TEMPLATES.values()]
    texts += [f"{sentence(rng, 30)}\n\n{t[:90]}\n{t[90:]}\n \n{sentence(rng, 9)}" for t in L.TEMPLATES.values()]
    texts += [" ".join(w for w in t.split() if rng.random() > 0.07) for t in L.TEMPLATES.values() for _ in range(4)]
    texts += [None, "", "\n", "license", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[0])]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS line", "2 AS dice")
    assert rows_of(L.scan(table)) == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    plain = [(r.doc_id, *brute(r.text)) for r in docs.collect()]
    assert rows_of(L.scan(clashing)) == sorted(plain, key=repr)
    assert L.scan(empty).count() == 0


def test_near_relatives_get_their_own_name(spark):
    header = L.NOTICES["GPL-3.0-header"]
    lesser = header.replace("General Public License", "Lesser General Public License")
    affero = header.replace("General Public License", "Affero General Public License")
    texts = {
        "LGPL-3.0-header": lesser,
        "AGPL-3.0-header": affero,
        "GPL-2.0-header": header.replace("version 3 of", "version 2 of"),
        "GPL-3.0-header": header,
        "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
        "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "BSD-3-Clause": "Released under the BSD 3-Clause License.",
        "MPL-2.0": "Released under the Mozilla Public License, Version 2.0.",
        "BSD-2-Clause-full": L.FULL_TEXTS["BSD-2-Clause-full"].replace("<year> <owner>", "2020 Someone"),
        "BSD-3-Clause-full": L.FULL_TEXTS["BSD-3-Clause-full"].replace(". ", ".\n\n"),
    }
    assert {n for n in L.FULL_TEXTS} >= {"Apache-2.0-full", "GPL-2.0-full", "CC0-1.0-full", "Unlicense-full", "BSL-1.0-full"}
    texts = L.FULL_TEXTS | texts
    found = L.scan(spark.createDataFrame(list(texts.items()), "doc_id string, text string")).collect()
    assert {r.doc_id: r.licence for r in found} == {n: n for n in texts}
