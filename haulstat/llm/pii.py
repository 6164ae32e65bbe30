"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Base kinds (email, ip, card, phone) are defined by pattern and check digit
alone; their spans always stay. Further candidates (secrets, phone numbers in
national form, identity numbers, titled names) and the base spans themselves
are voted on by five labelers, each of which says yes, no or nothing:

* ``shape``: a stricter regular expression of the kind;
* ``entropy``: the characters' entropy and share of digits;
* ``gazetteer``: list of first names, mail providers and card-issuer digits;
* ``context``: a cue word shortly before the span;
* ``edges``: quotation marks or white space on both sides, or part of a path.

A candidate's *pattern* is its kind, length class and votes. Patterns are
counted over all documents in Spark; there are at most
kinds x lengths x 3 ** labelers of them, so this table is bounded however many
texts there are. On it expectation-maximisation runs on the driver (per
labeler and class the probability of each vote, per kind the share of true
spans). Its posteriors are the targets of the final classifier, a logistic
regression that sees no votes but the span itself: kind, length, the shape of
its characters, how many differ, and the words before and after it, hashed
into ``BINS`` features. So it also tells spans apart on which the labelers agree, by
what spans like them were given elsewhere. It is fitted on about ``FIT_SPANS``
different (pattern, features) rows, chosen by a hash of their content and weighted by the
logarithm of their counts; fewer are all taken. A candidate is added if the
classifier gives it at least ``THRESHOLD`` and it overlaps no base span.

Texts are read once, in ``mapInArrow``; what is found (one small row per
document) is written to the shared folder and read again to decide.

Null text: treated as empty. Repeated rows: each gives its own row. Very long texts are searched
whole, in time linear in their length. Empty table: no rows. Extra columns are ignored, whatever their names. Nothing
found: counts 0, empty ``spans``. Ties between spans at one start: in the order
of ``KINDS``, longer first, and the later one is dropped where they overlap.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulstat.llm.common import stored

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "local_phone", "identity", "name")
LABELERS = ("shape", "entropy", "gazetteer", "context", "edges")
THRESHOLD = 0.5
EM_ROUNDS, FIT_ROUNDS = 50, 300
FIT_SPANS, BINS, RATE, L2 = 20_000, 1 << 12, 0.5, 1e-5
LONG_SHAPE = 16  # longer shapes, of random characters, are told by their length alone
AROUND = 48  # characters before and after a span in which its neighbouring words are looked for
PRIOR = ((3.0, 9.0), (9.0, 3.0))  # pseudo-votes (yes, no) of each labeler on false and on true spans

LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+)(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])")
IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Señor|Señora|Monsieur|Madame)\.? [A-Z]\w+(?: [A-Z]\w+)?")

#: Fixed lists of the gazetteer and context labelers.
FIRST_NAMES = frozenset("""James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Susan
    Thomas Anna Peter Maria Hans Ursula Karl Sabine Jean Marie Pierre Claire José Carmen Juan Lucía""".split())
MAIL_PROVIDERS = ("gmail.", "yahoo.", "hotmail.", "outlook.", "mail", "example.", "gmx.", "icloud.")
CARD_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65")
CUES = {"email": ("mail", "@", "contact"), "ip": ("ip", "host", "server", "addr"),
        "card": ("card", "visa", "karte", "carte", "tarjeta"), "phone": ("tel", "phone", "call", "fon", "mobil"),
        "secret": ("token", "key", "secret", "passw", "auth", "bearer", "credential"),
        "local_phone": ("tel", "phone", "call", "fon", "mobil"), "identity": ("ssn", "social", "ident", "dni"),
        "name": ("dear", "name", "signed", "lieber", "cher", "estimado")}
SHAPES = {"email": re.compile(r"[\w.%+-]+@[\w-]+(\.[\w-]+)*\.[A-Za-z]{2,}"), "ip": re.compile(r"[1-9]\d{0,2}(\.\d{1,3}){3}"),
          "card": re.compile(r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}"), "phone": re.compile(r"\+\d{1,3}[ (.-]*\d{2,4}\)?[ .-].*"),
          "secret": re.compile(r"[0-9a-f]{32,}|(sk|pk|gh[pousr]|AKIA|xox)[-_A-Za-z0-9]{16,}"),
          "local_phone": re.compile(r"\(?[2-9]\d\d\)?[ .-][2-9]\d\d[.-]\d{4}"),
          "identity": re.compile(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}"), "name": re.compile(r"\S+ [A-Z][a-z]+( [A-Z][a-z]+)?")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses that do not overlap: from each @ back over its local part, and on over its domain."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        head = text[last:at]
        start = last + len(head.rstrip(LOCAL_PART))
        m = DOMAIN.match(text, at + 1) if start < at else None
        last = m.end() if m else at + 1
        if m:
            out.append((start, last))
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end) of the base kinds, sorted; time grows with the text's length.

    No pattern is tried anew inside a run of characters that it has seen: a match can only begin where a run of digits
    begins, or at the local part before an @.
    """
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15]
    return sorted(out)


def further_spans(text: str, base: list[tuple[int, int, int]], any_digit: bool) -> list[tuple[int, int, int]]:
    """Candidates of the other kinds that overlap neither a base span nor an earlier candidate, sorted."""
    found = []
    if any_digit:
        for k, pattern in ((4, SECRET), (5, LOCAL_PHONE), (6, IDENTITY)):
            found += [(m.start(), k, m.end()) for m in pattern.finditer(text)]
    found += [(m.start(), 7, m.end()) for m in NAME.finditer(text)]
    if not found:
        return found
    out, taken, at = [], base, 0
    last = -1
    for s, k, e in sorted(found, key=lambda x: (x[0], x[1], -x[2])):
        while at < len(taken) and taken[at][2] <= s:
            at += 1
        # base spans of different kinds may overlap each other, so look on while they start before e
        if s >= last and not any(a < e and s < b for a, _, b in taken[max(at - 8, 0):at + 8]):
            out.append((s, k, e))
            last = e
    return out


def votes(text: str, start: int, kind: int, end: int) -> str:
    """One character per labeler: y, n or - (no vote)."""
    span, name = text[start:end], KINDS[kind]
    counts = np.array(list(Counter(span).values()), dtype=float) / len(span)
    entropy = float(-(counts * np.log2(counts)).sum())
    digits = len(digits_of(span)) / len(span)
    before = text[max(0, start - 24):start].lower()
    left, right = text[start - 1:start], text[end:end + 1]
    shape = "y" if SHAPES[name].fullmatch(span) else "n"
    if name == "secret":
        random = "y" if entropy >= 3.2 and 0.1 < digits < 0.95 else "n"
    else:
        random = "-" if name in ("email", "name") else "y" if len(set(digits_of(span))) >= 3 else "n"
    if name == "email":
        listed = "y" if span.split("@")[1].startswith(MAIL_PROVIDERS) else "-"
    elif name == "card":
        listed = "y" if span.startswith(CARD_ISSUERS) else "n"
    elif name == "name":
        listed = "y" if any(w in FIRST_NAMES for w in span.split()) else "-"
    elif name == "ip":
        listed = "n" if span.startswith(("0.", "127.", "255.")) else "-"
    else:
        listed = "-"
    cue = "y" if any(c in before for c in CUES[name]) else "-"
    edges = "n" if left in "/=-_" and left or right in "/_" and right else "y" if (
        (not left or left.isspace() or left in "\"'(<") and (not right or right.isspace() or right in "\"')>.,;")) else "-"
    return shape + random + listed + cue + edges


def pattern(text: str, start: int, kind: int, end: int) -> str:
    size = min(3, int(math.log2(max(1, (end - start) / 8)))) if end - start >= 8 else 0
    return f"{KINDS[kind]}/{size}/{votes(text, start, kind, end)}"


RUNS = (re.compile("[A-Z]+"), re.compile("[a-z]+"), re.compile("[0-9]+"))
WORD = re.compile(r"\w+")


def marks(text: str, start: int, kind: int, end: int) -> list[int]:
    """Hashed features of a span that no labeler sees: its characters' shape and variety, the words around it."""
    span, name = text[start:end], KINDS[kind]
    shape = span
    for runs, one in zip(RUNS, "Aa9"):
        shape = runs.sub(one, shape)
    whole = shape if len(shape) <= LONG_SHAPE else f"long/{len(shape).bit_length()}"
    before = ["", "", *WORD.findall(text[max(0, start - AROUND):start].lower())]
    after = WORD.search(text[end:end + AROUND].lower())
    told = (name, f"{name}/{(end - start).bit_length()}", f"{name}/shape/{whole}", f"head/{shape[:4]}", f"tail/{shape[-4:]}",
            f"{name}/differ/{len(set(span)) // 3}", f"before/{before[-1]}", f"{name}/before/{before[-1]}",
            f"before/{before[-2]} {before[-1]}", f"after/{after.group() if after else ''}")
    return [zlib.crc32(t.encode()) % BINS for t in told]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


FOUND = ("n_email long, n_ip long, n_card long, n_phone long, base string, "
         "known array<struct<pattern:string,marks:array<int>>>, "
         "further array<struct<start:int,kind:int,stop:int,pattern:string,marks:array<int>>>")


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base counts and spans, the base spans' and the further candidates' patterns and features."""
    any_digit = re.compile("[0-9]")
    seen = [("pattern", pa.string()), ("marks", pa.list_(pa.int32()))]
    further_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), *seen]))

    def told(text, s, k, e):
        return {"pattern": pattern(text, s, k, e), "marks": marks(text, s, k, e)}

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in b.column(1).to_pylist():
                text = text or ""
                digit = any_digit.search(text) is not None
                base = base_spans(text) if digit or "@" in text else []
                further = further_spans(text, base, digit)
                kinds = Counter(k for _, k, _ in base)
                for col, v in zip(out, (*(kinds[k] for k in range(4)), joined(base),
                                        [told(text, s, k, e) for s, k, e in base],
                                        [{"start": s, "kind": k, "stop": e, **told(text, s, k, e)}
                                         for s, k, e in further])):
                    col.append(v)
            types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct(seen)), further_type]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(v, t) for v, t in zip(out, types)]],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "known", "further"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FOUND}")


def estimate(patterns: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of every pattern, and P(yes or no | labeler, class): expectation-maximisation over counted patterns.

    A labeler that says nothing counts for neither class. The start is the share of yes among the votes cast;
    base spans are true by definition and stay so; ``PRIOR`` says that labelers are better than chance.
    """
    votes_ = np.array([["yn-".index(c) for c in p.split("/")[2]] for p, _ in patterns])
    cast = votes_ < 2
    kind = np.array([KINDS.index(p.split("/")[0]) for p, _ in patterns])
    weight = np.array([n for _, n in patterns], dtype=float)
    yes, no = (votes_ == 0).sum(1), (votes_ == 1).sum(1)
    known = kind < len(BASE)
    post = np.where(known, 1.0, (yes + 0.5) / (yes + no + 1.0))
    said = np.zeros((len(LABELERS), 2, 2))
    for _ in range(EM_ROUNDS):
        for j in range(len(LABELERS)):
            for c, p in ((0, 1 - post), (1, post)):
                n = np.bincount(votes_[cast[:, j], j], weights=(weight * p)[cast[:, j]], minlength=2) + PRIOR[c]
                said[j, c] = n / n.sum()
        share = np.array([(np.sum((weight * post)[kind == k]) + 1) / (weight[kind == k].sum() + 2)
                          for k in range(len(KINDS))])[kind]
        log = np.log(np.stack([1 - share, share]))
        for j in range(len(LABELERS)):
            log[:, cast[:, j]] += np.log(said[j][:, votes_[cast[:, j], j]])
        new = np.where(known, 1.0, 1 / (1 + np.exp(np.clip(log[0] - log[1], -35, 35))))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post, said


def fit(rows: list[tuple[list[int], float, float]]) -> np.ndarray:
    """Weights of the final classifier from (features, target, weight) rows: logistic loss, adaptive steps over all rows."""
    w = np.zeros(BINS)
    if not rows:
        return w
    x = np.array([r[0] for r in rows])
    target, weight = (np.array([r[i] for r in rows], dtype=float) for i in (1, 2))
    weight /= weight.sum()
    squares = np.full(BINS, 1e-12)
    for _ in range(FIT_ROUNDS):
        miss = weight * (1 / (1 + np.exp(-np.clip(w[x].sum(1), -35, 35))) - target)
        g = np.bincount(x.ravel(), np.repeat(miss, x.shape[1]), BINS) + L2 * w
        squares += g * g
        w -= RATE * g / np.sqrt(squares)
    return w


def probability(w: np.ndarray, features: list[int]) -> float:
    return 1 / (1 + math.exp(-min(35.0, max(-35.0, float(w[features].sum())))))


def span_classifier(found: DataFrame) -> np.ndarray:
    """Weights fitted on what ``find`` found. To the driver go the counted patterns (a bounded table) and the bounded sample."""
    every = F.concat("known", F.transform("further", lambda x: F.struct(x["pattern"].alias("pattern"), x["marks"].alias("marks"))))
    counted = stored(found.select(F.explode(every).alias("x")).groupBy("x.pattern", "x.marks").count(), "pii-spans")
    by_pattern = counted.groupBy("pattern").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    patterns = sorted((r["pattern"], r["n"]) for r in by_pattern)
    if not patterns:
        return fit([])
    posterior = dict(zip([p for p, _ in patterns], estimate(patterns)[0].tolist()))
    share = min(1.0, FIT_SPANS / sum(r["rows"] for r in by_pattern))
    some = counted.where(F.pmod(F.xxhash64("pattern", "marks"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return fit([(m, posterior[p], math.log1p(n)) for p, m, n in sorted(
        (r["pattern"], r["marks"], r["count"]) for r in some.collect())])


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, base counts, ``base_spans``, ``base_sha256``, ``spans`` (all) and ``n_further``."""
    found = stored(find(df, id_col, text_col), "pii")
    w = span_classifier(found)

    def run(batches):
        for b in batches:
            base, sha, spans, n = b.column(5).to_pylist(), [], [], []
            for known, further in zip(base, b.column(6).to_pylist()):
                more = [(x["start"], x["kind"], x["stop"]) for x in further
                        if probability(w, x["marks"]) >= THRESHOLD]
                own = [(int(s), KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in known.split(",") if x)]
                sha.append(hashlib.sha256(known.encode()).hexdigest())
                spans.append(joined(own + more))
                n.append(len(more))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(6)), pa.array(sha, pa.string()), pa.array(spans, pa.string()),
                 pa.array(n, pa.int64())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_spans", "base_sha256", "spans", "n_further"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.drop("known").mapInArrow(
        run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_spans string, "
             "base_sha256 string, spans string, n_further long")
