"""License scan against a plain search, and expressions against nested evaluation."""

import re

import pytest

from haulstat.llm import licenses as L
from tests.llm.helpers import docs

SF01 = "/root/testdata/sf0.01"
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TEXTS = ["", "MIT License", "the mit\tLICENSE; mit-license, Mit license cc by cc by", "CC BY-NC 4.0 and cc  by", "mît license",
         "gnu general public licenses", "é\x85mit license", "a\xa0apache license", "İ mit license", "_mit_license_",
         "GNU General Public License GNU General Public License", "apache license " * 400]


def plain(text):
    """Base columns by trying every phrase at every word."""
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    found = [(i, label) for phrase, label in L.BASE.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})))


def test_base_equals_plain_search(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    df = df.unionByName(docs(spark, [(9000 + i, t, "en", "a") for i, t in enumerate([None, *TEXTS])]))
    want = {r["doc_id"]: plain(r["text"]) for r in df.collect()}
    got = L.license_scan(df).collect()
    assert {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) for r in got} == want
    assert sum(w[1] > 0 for w in want.values()) > 20
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) for r in got if r["base_labels"])
    assert all(0 <= r["score"] <= 1 and (r["labels"] == "") == (r["score"] == 0 and not r["n_bad"]) or "proprietary" in r["labels"]
               for r in got)


@pytest.mark.parametrize("text, labels, value, ok", [
    ("MIT", {"mit"}, 0.9, True),
    ("MIT OR GPL-2.0-only AND BSD-3-Clause", {"mit", "gpl", "bsd"}, max(0.9, min(0.4, 0.9)), True),
    ("(MIT OR GPL-2.0-only) AND AGPL-3.0-or-later", {"mit", "gpl", "agpl"}, min(max(0.9, 0.4), 0.3), True),
    ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", {"gpl", "mit"}, 0.7, True),
    ("((LGPL-2.1+))", {"lgpl"}, 0.6, True),
    ("licenseref-Own or cc-by-nc-sa-4.0", {"licenseref-own", "cc-by-nc-sa"}, 0.2, True),
    ("(MIT AND Apache-2.0", {"mit", "apache"}, 0.9, False),
    ("MIT OR", {"mit"}, 0.9, False),
    ("MIT or (GPL-3.0-only) */ more words", {"mit", "gpl"}, 0.9, True),
    ("MIT\tOR  Apache-2.0. Other words", {"mit", "apache"}, 0.9, True)])
def test_expressions(text, labels, value, ok):
    got = L.statement(L.read_expression(text))
    assert got == (pytest.approx(value), labels, ok)


def test_expression_without_ids():
    for text in ("", "()", "and", ")", "* MIT"):
        assert L.statement(L.read_expression(text)) is None


def nested(e):
    """An expression tree as text and its value."""
    if isinstance(e, str):
        return e, L.OPEN.get(L.family(e), L.UNKNOWN)
    op, a, b = e
    (ta, va), (tb, vb) = nested(a), nested(b)
    return f"({ta} {op} {tb})", max(va, vb) if op == "OR" else min(va, vb)


def test_random_expressions_equal_their_trees():
    import random

    rng = random.Random(5)

    def tree(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(["MIT", "GPL-3.0-only", "Apache-2.0", "CC-BY-NC-4.0", "MPL-2.0", "X-1"])
        return rng.choice(["AND", "OR"]), tree(depth - 1), tree(depth - 1)

    for _ in range(300):
        text, value = nested(tree(5))
        got = L.statement(L.read_expression(text))
        assert got[0] == value and got[2]


def test_tags_and_notices():
    keys = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_tags", "n_bad", "terms"]

    def scan(text):
        return dict(zip(keys, L.scan(text.encode())))

    got = scan("x\n# SPDX-License-Identifier: GPL-2.0-only OR MIT\nfoo SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception\n")
    assert (got["labels"], got["score"], got["n_tags"], got["n_bad"]) == ("apache,gpl,mit", 0.9, 2, 0)
    got = scan("Under the MIT License or, at your option, the GNU General Public License.")
    assert got["terms"] == "mit or gpl" and got["score"] == 0.9
    got = scan("MIT License. Apache License and the GNU General Public License v2 or later. All rights reserved")
    assert got["terms"] == "mit; apache and gpl; proprietary" and got["score"] == 0.0
    got = scan("Licensed under CC BY-NC-SA 4.0.")
    assert (got["base_labels"], got["labels"], got["n_base"], got["score"]) == ("cc-by", "cc-by,cc-by-nc,cc-by-nc-sa", 1, 0.2)
    assert scan("SPDX-License-Identifier")["labels"] == "" and scan("a" * 3_000_000)["n_words"] == 1
