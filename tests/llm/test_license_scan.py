from __future__ import annotations

import random

import pytest

from cases import EDGE_TEXTS, alnum_words, frame, lowered, some_texts, with_clashes
from salestrata.llm import license_rules, license_scan

TEXTS = EDGE_TEXTS + [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "gnu general\npublic -- LICENSE",
    "SPDX-License-Identifier: GPL-3.0-or-later\n// MIT", "the mit license, the mit license and cc by", "mit licenses", "emit license",
    "CC  BY", "ccby cc-by cc by sa 4.0", "Apache License apache license", "commit mit lizenz", "é mit license é", "mit licenseé",
    "GNU GPL v2 or GPLv3", "GNU Lesser General Public License version 2.1", "Mozilla Public License 2.0", "All rights reserved.",
    "Creative Commons Attribution-NonCommercial-ShareAlike", "BSD 3-Clause", "3-clause BSD license", "dual: MIT License / Apache License 2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of", "http://www.apache.org/licenses/LICENSE-2.0",
]


def base(text):
    words = alnum_words(text)
    places = [(i, label) for phrase, label in license_scan.PHRASES.items()
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({name for _, name in places})))


def brute_detections(text):
    raw = sorted((-r.priority, m.start() - m.end(), m.start(), n, r.label)
                 for n, r in enumerate(license_rules.rules()) for m in r.pattern.finditer(text))
    taken = []
    for priority, size, start, _, label in raw:
        if not any(a <= start and start - size <= b for a, b, _, _ in taken):
            taken.append((start, start - size, label, -priority))
    return sorted(taken)


def test_scan_equals_brute_force(spark):
    texts = TEXTS + some_texts(spark)
    found = license_scan.license_scan(with_clashes(frame(spark, texts), ["labels", "score", "n_base"])).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), repr(text)
        want = brute_detections(lowered(text or ""))
        assert [tuple(d) for d in r.detections] == want, repr(text)
        assert r.labels == ",".join(sorted({*filter(None, base(text)[-1].split(",")), *(d[2] for d in want)}))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("the new BSD license", "bsd-3-clause"),
    ("commit mit lizenz", ""),
])
def test_labels(spark, text, labels):
    assert license_scan.license_scan(frame(spark, [text])).first().labels == labels


def test_suppression_equals_its_definition():
    rng = random.Random(6)
    for _ in range(300):
        raw = sorted((-rng.randint(1, 3), -rng.randint(1, 9), rng.randint(0, 20), n, str(n)) for n in range(25))
        taken = []
        for priority, size, start, _, label in raw:
            if not any(a <= start and start - size <= b for a, b, _, _ in taken):
                taken.append((start, start - size, label, -priority))
        assert list(license_scan.suppressed(raw)) == taken


def test_rules_are_hundreds_and_each_has_its_keyword():
    rules = license_rules.rules()
    assert len(rules) >= 300
    assert len({(r.label, r.pattern.pattern, r.priority) for r in rules}) == len(rules)


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = frame(spark, ["mit license", "mit license", None], ids=[None, 1, 1])
    assert sorted((r.doc_id or 0, r.labels) for r in license_scan.license_scan(docs).collect()) == [(0, "mit"), (1, ""), (1, "mit")]
    assert license_scan.license_scan(docs.limit(0)).collect() == []


def expansions(pattern):
    """Texts that a line's pattern takes, with every optional part in and out, " ?" as a space or nothing."""
    import re._parser as parser

    def of(items):
        found = [""]
        for kind, value in items:
            name = str(kind)
            if name == "LITERAL":
                parts = [chr(value)]
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                low, _, body = value
                inner = of(body)
                parts = [x * max(low, 1) for x in inner] + [""] * (low == 0)
            elif name == "SUBPATTERN":
                parts = of(value[3])
            elif name == "BRANCH":
                parts = [x for branch in value[1] for x in of(branch)]
            elif name == "IN":
                parts = ["1" if str(k) == "CATEGORY" else chr(v) for k, v in value]
            else:
                assert name == "ANY"
                parts = ["x"]
            found = [a + b for a in found for b in parts]
        return found
    return of(parser.parse(pattern))


def test_every_expansion_of_a_pattern_has_its_keyword():
    lost = []
    for label, keyword, pattern in license_rules._lines(license_rules.NAMES) + license_rules._lines(license_rules.NOTICES):
        compiled, keyword = license_rules._compiled(pattern), keyword.replace("\\", "")
        for text in expansions(pattern):
            for written in (text, text.replace(" ", "-"), text.replace(" ", "\n")):
                assert compiled.search(written), (pattern, written)
                if keyword not in license_scan.found_keywords(written.encode()):
                    lost.append((label, keyword, written))
    assert not lost


@pytest.mark.parametrize("text", ["CreativeML Open RAIL-M License", "Licensed under the OpenRAIL license", "open rail", "OpenRAIL-M"])
def test_openrail_in_every_spelling(text):
    assert {d[2] for d in license_scan.detect(lowered(text).encode())} == {"openrail"}
