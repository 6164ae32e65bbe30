"""The final classifier of personal data: fitted on spans, against the same steps without Spark."""

import math
import random
from collections import Counter

import numpy as np

from haulstat.llm import pii
from tests.llm.helpers import SF, docs

TEXTS = ['api key: sk_live_0a1b2c3d4e5f6a7b8c9d and nothing else', "call me on 555-234-5678 today or 555-234-5679",
         "ssn 123-45-6789 is mine", "Dear Mr John Smith, thanks", "build 20190101aaaaaaaaaaaaaaaaaaaaaaaaaa done",
         "path /var/lib/aaaaaaaa1bbbbbbbbbbbbbbbbbbbbbb/", "mail a.b@example.com +1 555 010 2030 10.1.2.3 4111 1111 1111 1111"]


def without_spark(texts):
    """Spans per text: all candidates, their posteriors, a fit on all different rows, decisions."""
    found = []
    for t in texts:
        t = t or ""
        base = pii.base_spans(t)
        found.append((t, base, pii.further_spans(t, base, any("0" <= c <= "9" for c in t))))
    seen = Counter((pii.pattern(t, *x), tuple(pii.marks(t, *x))) for t, base, more in found for x in [*base, *more])
    patterns = Counter()
    for (p, _), n in seen.items():
        patterns[p] += n
    order = sorted(patterns.items())
    posterior = dict(zip([p for p, _ in order], pii.estimate(order)[0].tolist()))
    w = pii.fit([(list(m), posterior[p], math.log1p(n)) for (p, m), n in sorted(seen.items())])
    return [pii.joined([*base, *(x for x in more if pii.probability(w, pii.marks(t, *x)) >= pii.THRESHOLD)])
            for t, base, more in found]


def test_equal_to_the_same_steps_without_spark(spark):
    planted = [*TEXTS * 3, None, "", "y" * 50_000 + " token 0123456789abcdef0123456789abcdef"]
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    df = df.unionByName(docs(spark, [(90_000 + i, t, "en", "a") for i, t in enumerate(planted)]))
    rows = df.orderBy("doc_id").collect()
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(df).collect()}
    assert [got[r["doc_id"]] for r in rows] == without_spark([r["text"] for r in rows])
    assert any("secret:" in got[r["doc_id"]] for r in rows)


def test_fit_learns_the_words_around_spans():
    """Half of the targets say what the word before tells, half say nothing: held-out spans follow the word."""
    rng = random.Random(3)

    def row(word):
        text = f"{word} {''.join(rng.choice('0123456789abcdef') for _ in range(32))} end"
        return pii.marks(text, len(word) + 1, 4, len(word) + 33)

    rows = [(row(word), target if rng.random() < 0.5 else 0.5, 1.0) for _ in range(400)
            for word, target in (("token", 1.0), ("commit", 0.0))]
    w = pii.fit(rows)
    assert min(pii.probability(w, row("token")) for _ in range(50)) > 0.6
    assert max(pii.probability(w, row("commit")) for _ in range(50)) < 0.4


def test_fit_of_nothing_and_of_ties():
    assert not pii.fit([]).any()
    same = pii.marks("a 555-234-5678 b", 2, 5, 14)
    w = pii.fit([(same, 1.0, 1.0), (same, 0.0, 1.0)])
    assert abs(pii.probability(w, same) - 0.5) < 1e-6
    assert np.isfinite(pii.fit([(same, 1.0, 1e9)])).all()


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(pii, "FIT_SPANS", 50)
    taken = []
    monkeypatch.setattr(pii, "fit", lambda rows: taken.append(len(rows)) or np.zeros(pii.BINS))
    rng = random.Random(1)
    texts = [(i, "key " + "".join(rng.choice("0123456789abcdef") for _ in range(rng.randrange(24, 60))), "en", "a") for i in range(2000)]
    pii.span_classifier(pii.find(docs(spark, texts)))
    assert 20 <= taken[0] <= 100
