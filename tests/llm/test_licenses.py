"""Operator 6: sibling versions, whole notices and terms, and passages within passages."""

import numpy as np
import pytest

from segmenta.llm import licenses

BSD_3 = licenses.TEMPLATES["bsd-3-clause-notice"].replace("the copyright holder nor", "Example Works Ltd nor")


def hits(text, threshold=0.8):
    scanner = licenses.scanner_of(tuple(sorted(licenses.TEMPLATES.items())), threshold)
    found = scanner.scan(np.array([scanner.word.get(w, 0) for w in licenses.words(text)], np.int64))
    return [scanner.names[p[1]] for p in found]


@pytest.mark.parametrize("text,want", [
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0-line"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "lgpl-2.1-line"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "agpl-3.0-line"),
    ("This work is licensed under the GNU General Public License.", "gpl-line"),
    ("Licensed under the Apache License, Version 1.1", "apache-1.1-line"),
    ("Licensed under CC BY-NC-ND 4.0.", "cc-by-nc-nd-4.0-line"),
    ("Copyright (c) 2020 Example Works Ltd. " + BSD_3, "bsd-3-clause-notice"),
])
def test_sibling_versions_are_told_apart(text, want):
    assert hits("some words before it. " + text + " Other words follow.") == [want]


@pytest.mark.parametrize("name", ["gpl-2.0", "gpl-3.0", "lgpl-2.1", "agpl-3.0", "mpl-2.0", "epl-1.0", "epl-2.0", "apache-2.0", "cc-by-4.0",
                                  "cc-by-nc-4.0", "cc-by-sa-4.0"])
def test_terms_alone_are_found(name):
    words = licenses.TEMPLATES[name + "-terms"].split()
    altered = " ".join(w for i, w in enumerate(words) if i % 40)  # a word in 40 is lost
    assert hits("An intro. " + altered + " The end.") == [name + "-terms"]


def test_terms_and_the_notice_after_them_are_two_hits():
    text = licenses.TEMPLATES["gpl-2.0-terms"] + " How to Apply These Terms to Your New Programs. " + licenses.TEMPLATES["gpl-2.0"]
    assert hits(text) == ["gpl-2.0-terms", "gpl-2.0"]


def test_scan_names_siblings(spark):
    rows = [(0, "This work is licensed under the GNU General Public License, version 2."), (1, BSD_3)]
    got = {r["doc_id"]: r["license"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: "gpl-2.0-line", 1: "bsd-3-clause-notice"}
