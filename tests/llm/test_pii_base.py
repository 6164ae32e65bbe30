"""Base spans of personal data: the contract's patterns as they stand, on the table, on random texts and on very long runs."""

import hashlib
import random
import re
import time

from haulstat.llm import pii
from tests.llm.helpers import docs

SF01 = "/root/testdata/sf0.01"
# The patterns of the base kinds.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def checks(kind, span):
    digits = [int(c) for c in span if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "")
             if checks(kind, m.group())]
    return sorted(found)


def test_random_texts():
    rng = random.Random(7)
    pieces = ["a", "b.c", "@", "@x", ".", "1", "25", "255", "300", "0", "-", " ", "+", "+1", "(", ")", "4111111111111111",
              "1.2.3.4", "01.002.3.4", "_%", "é", "a@b.c", "123 456 789 012 34", "\n", "@@", ".."]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(text) == plain(text), text


def test_table(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    df = df.unionByName(docs(spark, [(9000, None, "en", "a"), (9001, "", "en", "a"), (9002, "x@y.z " * 3000, "en", "a"),
                                     (9003, "+1 (555) 010-2030 4111-1111-1111-1111 10.0.0.256 10.0.0.25", "en", "a")]))
    names = list(PATTERNS)
    want = {}
    for r in df.collect():
        spans = plain(r["text"])
        told = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        want[r["doc_id"]] = (*(sum(k == i for _, k, _ in spans) for i in range(4)), hashlib.sha256(told.encode()).hexdigest(),
                             {x for x in told.split(",") if x})
    got = pii.personal_data(df).collect()
    assert len(got) == len(want)
    for r in got:
        *counts, sha, base = want[r["doc_id"]]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]] == [*counts, sha]
        spans = [x for x in r["spans"].split(",") if x]
        assert base <= set(spans) and len(set(spans)) == len(spans)
        place = [(int(s), pii.KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in spans)]
        assert place == sorted(place) and all(0 <= s < e for s, _, e in place)
    assert sum(w[0] + w[1] + w[2] + w[3] for w in want.values()) > 50


def test_very_long_runs_take_linear_time():
    for text in ("1" * 1_000_000, "a" * 1_000_000 + "@", "a" * 1_000_000 + " x@y", "1." * 500_000, "1 " * 500_000, "+1" + "(" * 1_000_000,
                 "a@" * 500_000, "+1 " * 300_000, "1.2.3." * 200_000, "a1_" * 300_000, "Mr Aa " * 150_000):
        began = time.time()
        spans = pii.base_spans(text)
        assert len(pii.further_spans(text, spans, True)) >= 0
        assert time.time() - began < 2.5, text[:12]
