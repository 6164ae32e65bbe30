"""License scan: Aho-Corasick over whole texts for notice phrases and identifier tags, expressions by shunting-yard.

One automaton holds all phrases. It runs over a text's words (A-Z lower-cased;
runs of digits, letters and everything beyond ASCII) joined by single blanks,
each phrase between blanks, so a phrase is found where its words stand
consecutively, whatever separates them. All places are found, overlapping ones too.

Statements of a document:

* an identifier tag (``SPDX-License-Identifier``): the rest of its line is an
  expression over licence ids with ``and``, ``or``, ``with`` and parentheses;
* notices: phrases form one expression if only connecting words stand between them, ``or`` or ``and``
  among them (``under the MIT License or, at your option, the Apache License``); others are
  statements of their own. Of phrases that overlap the longest counts here.

A shunting-yard parser (``with`` binds before ``and`` before ``or``) turns an
expression into postfix order, which is evaluated to how open the terms are, 0
(all rights reserved) to 1 (public domain): ``or`` leaves the choice (the
larger value), ``and`` binds to both (the smaller), ``with`` an exception goes half
the way to 1. A tag's expression ends where it cannot go on; one with
unbalanced parentheses or a missing operand is counted in ``n_bad`` and binds to all of its ids.
``score`` is the smallest value of the document's statements, 0 without any.

Scale: one pass in Arrow batches, no shuffle; memory is a few copies of the longest text.

Null text, empty text: no words, null first and last word, empty labels, score 0. Null and repeated ids: a row each.
Very long texts: scanned whole, in time proportional to their length. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases of the base scan and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: More notice phrases and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl", "gnu gpl": "gpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "bsd license": "bsd", "2 clause bsd": "bsd", "3 clause bsd": "bsd",
    "redistribution and use in source and binary forms": "bsd", "isc license": "isc", "zlib license": "zlib",
    "boost software license": "bsl", "permission is hereby granted free of charge": "mit", "the unlicense": "unlicense",
    "released into the public domain": "public-domain", "dedicated to the public domain": "public-domain",
    "cc0": "cc0", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd", "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa", "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution non commercial": "cc-by-nc",
    "creative commons zero": "cc0", "all rights reserved": "proprietary"}
TAG = "spdx license identifier"

#: How open a label's terms are; any other id counts as UNKNOWN.
OPEN = {"public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0, "mit": 0.9, "isc": 0.9, "zlib": 0.9, "bsd": 0.9,
        "bsl": 0.9, "apache": 0.9, "cc-by": 0.8, "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4,
        "cc-by-nd": 0.3, "agpl": 0.3, "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2, "cc-by-nc-nd": 0.1, "proprietary": 0.0}
UNKNOWN = 0.1

#: Words that may stand between two notices of one expression.
BETWEEN = frozenset("a an and any at by either for later license licensed licence of only option or s terms the this under v "
                    "version with works your".split())
MAX_GAP = 12
RANK = {"or": 1, "and": 2, "with": 3}

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")  # of lower-cased bytes
BLANKS = re.compile(rb"  +")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes to words' bytes: A-Z lower-cased, separators to blanks, the rest as is.
TO_WORDS = bytes(c if WORD.match(bytes([c])) else 32 for c in LOWER)
TOKEN = re.compile(r"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+-]*))")


def family(name: str) -> str:
    """Label of a licence id: that of its longest known beginning (``apache-2.0`` is ``apache``), else the id itself."""
    name = name.lower().rstrip("+")
    parts = name.split("-")
    for end in range(len(parts), 0, -1):
        if (head := "-".join(parts[:end])) in OPEN:
            return head
    return name


def read_expression(text: str) -> list[str]:
    """Tokens of the expression that ``text`` begins with: parentheses, operators in lower case, ids as they are."""
    out, at, operand = [], 0, False  # operand: an id or a closing parenthesis came last
    while m := TOKEN.match(text, at):
        mark, word = m.groups()
        if mark or word.lower() in RANK:
            if (mark == "(") == operand:  # "id (" or an operator without a left operand ends it
                break
            operand = mark == ")"
        elif operand:
            break
        else:
            word = word.rstrip(".")
            operand = True
        out.append(mark or (word.lower() if word.lower() in RANK else word))
        at = m.end()
    return out


def postfix(tokens: list[str]) -> list[str] | None:
    """The tokens in postfix order; None if parentheses or operands do not fit together."""
    out, waiting, depth = [], [], 0
    for t in tokens:
        if t == "(":
            waiting.append(t)
        elif t == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif t in RANK:
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[t]:
                out.append(waiting.pop())
            waiting.append(t)
        else:
            out.append(t)
    while waiting:
        if waiting[-1] == "(":
            return None
        out.append(waiting.pop())
    for t in out:
        depth += -1 if t in RANK else 1
        if depth < 1:
            return None
    return out if depth == 1 else None


def evaluate(order: list[str]) -> tuple[float, set[str]]:
    """Value and labels of an expression in postfix order; an exception after ``with`` is no label."""
    held: list[tuple[float, set[str]]] = []
    for t in order:
        if t not in RANK:
            label = family(t)
            held.append((OPEN.get(label, UNKNOWN), {label}))
            continue
        (b, more), (a, labels) = held.pop(), held.pop()
        held.append(((1 + a) / 2, labels) if t == "with" else (max(a, b) if t == "or" else min(a, b), labels | more))
    return held[0]


def statement(tokens: list[str]) -> tuple[float, set[str], bool] | None:
    """Value, labels and whether it is well formed; None without an id."""
    ids = [t for t in tokens if t not in RANK and t not in "()"]
    if not ids:
        return None
    order = postfix(tokens)
    if order is not None:
        return *evaluate(order), True
    labels = {family(t) for t in ids}
    return min(OPEN.get(x, UNKNOWN) for x in labels), labels, False


@lru_cache(maxsize=1)
def automaton():
    """All phrases, each between blanks, over bytes taken as Latin-1 characters."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        a.add_word(f" {phrase} ", phrase)
    a.make_automaton()
    return a


def notice_expressions(places: list[tuple[int, str]], words: list[str]) -> list[list[str]]:
    """Expressions of (first word, phrase) places; ``words`` are the text's words."""
    out, end = [], -1  # end: the word after the last phrase taken
    for first, phrase in sorted(places, key=lambda p: (p[0], -len(p[1]))):
        label = BASE.get(phrase) or NOTICES[phrase]
        if first < end:
            continue
        gap = words[end:first] if out else []
        either = any(w == "or" and gap[i + 1:i + 2] not in (["later"], ["any"]) for i, w in enumerate(gap))
        if 0 < len(gap) <= MAX_GAP and (either or "and" in gap) and all(w in BETWEEN or w.isdigit() for w in gap):
            out[-1] += ["or" if either else "and", label]
        else:
            out.append([label])
        end = first + phrase.count(" ") + 1
    return out


def scan(raw: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, n_tags, n_bad, terms of one text."""
    joined = BLANKS.sub(b" ", b" " + raw.translate(TO_WORDS) + b" ")
    n_words = joined.count(b" ") - 1
    found, at, words_before = [], 0, 0
    for end, phrase in automaton().iter(joined.decode("latin-1")):
        start = end - len(phrase) - 1  # of the blank before it
        if start >= at:
            words_before += joined.count(b" ", at, start)
            first = words_before
            at = start
        else:
            first = words_before - joined.count(b" ", start, at)
        found.append((first, phrase))
    if not found:
        return n_words, 0, None, None, "", "", 0.0, 0, 0, ""
    base = [p for p in found if p[1] in BASE]
    tags = [p for p in found if p[1] == TAG]
    told = []
    if tags:
        spans = [m.end() for m in WORD.finditer(raw.translate(LOWER))]
        for first, _ in tags:
            line = raw[spans[first + 2]:].split(b"\n", 1)[0].decode("utf-8", "replace")
            told.append(read_expression(line.lstrip(": \t")))
    notices = [p for p in found if p[1] != TAG]
    if notices:
        told += notice_expressions(notices, joined.decode("latin-1").strip(" ").split(" "))
    terms = [s for s in map(statement, told) if s]
    labels = {x for _, more, _ in terms for x in more} | {BASE.get(p) or NOTICES[p] for _, p in notices}
    starts = [f for f, _ in base]
    return (n_words, len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({BASE[p] for _, p in base})), ",".join(sorted(labels)),
            min((v for v, _, _ in terms), default=0.0), len(tags), sum(not ok for _, _, ok in terms),
            "; ".join(" ".join(t) for t in told if t))


KINDS = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
         "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "n_tags": pa.int64(),
         "n_bad": pa.int64(), "terms": pa.string()}
SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "n_tags long, n_bad long, terms string")


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: its id and what ``scan`` finds in its whole text; ``terms`` are the statements' expressions."""
    docs = df.select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("__raw"))

    def run(batches):
        for b in batches:
            rows = [scan(x.as_py() or b"") for x in b.column(1)]
            cols = list(zip(*rows)) if rows else [()] * len(KINDS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, KINDS.values()))],
                                             ["__id", *KINDS])

    kind = docs.schema["__id"].dataType.simpleString()
    return docs.mapInArrow(run, f"__id {kind}, {SCHEMA}").withColumnRenamed("__id", id_col)
