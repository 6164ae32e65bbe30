"""Language identification, quality classifier and personal data."""

import itertools
import math
import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from haulstat.llm import language_id as li
from haulstat.llm import pii
from haulstat.llm import quality_classifier as qc
from tests.llm.helpers import docs

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SF01 = "/root/testdata/sf0.01"


def segmentations(word, pieces):
    """Every way to cut a word into pieces of the vocabulary, as lists of piece numbers."""
    if not word:
        return [[]]
    out = []
    for n in range(1, len(word) + 1):
        node = 0
        for c in word[:n]:
            node = pieces.step[node, pieces.letter.get(c, 0)] if node or c == word[0] else 0
            if not node:
                break
        if node and pieces.piece[node] >= 0:
            out += [[int(pieces.piece[node]), *rest] for rest in segmentations(word[n:], pieces)]
    return out


def test_forward_sums_all_segmentations():
    pieces = li.load_pieces(VOCABULARY)
    probs = np.random.default_rng(1).random((pieces.size + 1, 2))
    for word in ("the", "house", "aber", "nación", "x"):
        want = [math.log(sum(math.prod(probs[p, g] for p in s) for s in segmentations(li.START + word, pieces)))
                for g in range(2)]
        assert np.allclose(li.word_scores([word], probs, pieces)[0], want)


def test_long_runs_sum_all_segmentations():
    """Beyond LONGEST letters too: equal to the plain forward pass where that does not underflow, and finite far beyond."""
    pieces = li.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(2)
    probs = np.vstack([rng.dirichlet(np.ones(pieces.size), 3).T, np.full(3, li.UNKNOWN)])
    for word in ("donaudampfschifffahrtsgesellschaftskapitänswitwe", "語日本" * 20, "ab" * 21, "x" * li.LONGEST):
        codes, length = li.encode([li.START + word], pieces)
        want = np.log(li.forward(codes, length, probs, pieces)[length, 0])
        assert np.allclose(li.word_scores([word], probs, pieces), want)
    long = li.word_scores(["straße" * 20_000], probs, pieces)
    assert np.isfinite(long).all() and np.allclose(long / 20_000, li.word_scores(["straße" * 200], probs, pieces) / 200, rtol=0.02)


def test_expected_counts_are_posteriors():
    pieces = li.load_pieces(VOCABULARY)
    probs = np.random.default_rng(2).random(pieces.size + 1)
    codes, length = li.encode([li.START + "house"], pieces)
    got = li.expected_counts(codes, length, np.array([3.0]), probs, pieces)
    ways = segmentations(li.START + "house", pieces)
    weight = [math.prod(probs[p] for p in s) for s in ways]
    want = np.zeros(pieces.size + 1)
    for s, w in zip(ways, weight):
        for p in s:
            want[p] += 3.0 * w / sum(weight)
    assert np.allclose(got, want)


def test_language_held_out(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    got = li.language_id(df, VOCABULARY).join(df, "doc_id").where("held_out")
    right = got.where("lang = lang_pred").count()
    assert right >= 0.98 * got.count()
    assert got.where("score < 0 OR score > 1").count() == 0


def test_every_letter_of_the_vocabulary_counts(spark):
    """Languages of scripts with rarer letters are told apart by their own pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    texts = [sp.id_to_piece(i).removeprefix(li.START) for i in range(sp.get_piece_size())]
    pieces = li.load_pieces(VOCABULARY)
    assert {c for t in texts if li.LETTERS.fullmatch(t) and t == t.lower() for c in t} <= set(pieces.letter)
    words = {"he": "של את על לא הוא היא בית יום שלום ילד".split(), "ru": "что это как дом день мир был она они вода".split(),
             "ja": "これ それ です ます した から まで いる ある する".split(),
             "ko": "이 그 는 을 를 에 의 가 한 다".split(), "th": "มา ไป ของ และ การ ความ บาน นา ตา ปลา".split()}
    r = random.Random(5)
    rows = [(i, " ".join(r.choices(words[g], k=3 + 3 * (g == "he"))), g, "a") for i, g in enumerate(sorted(words) * 60)]
    df = docs(spark, rows)
    got = li.language_id(df, VOCABULARY).join(df, "doc_id").where("held_out")
    assert got.count() > 50 and got.where("lang <> lang_pred OR score < 0.9").count() == 0


def test_words_beyond_the_table(monkeypatch):
    pieces = li.load_pieces(VOCABULARY)
    model = li.LanguageModel(["a", "b"], np.random.default_rng(3).random((pieces.size + 1, 2)), VOCABULARY)
    words = [["alpha", "beta", "x" * 100], [], ["gamma", "alpha"]]
    want = np.array([li.word_scores(w, model.probs, pieces).sum(0) if w else [0, 0] for w in words])
    for size in (2, 3, 100):
        table = np.zeros((size, 2))
        seen = {}
        for _ in range(2):
            assert np.allclose(li.text_scores(words, model, pieces, seen, table), want)


def test_ftrl_matches_plain_updates():
    p = qc.Ftrl()
    t = qc.Trainer(p)
    z, n = {}, {}
    r = random.Random(4)
    for _ in range(200):
        index = np.array(sorted(r.sample(range(30), 5)))
        value = np.array([r.random() for _ in range(5)])
        label = r.randrange(2)
        w = {}
        for i in index:
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            w[i] = 0.0 if abs(zi) <= p.l1 else -(zi - math.copysign(p.l1, zi)) / ((p.beta + math.sqrt(ni)) / p.alpha + p.l2)
        error = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(index, value)))) - label
        for i, v in zip(index, value):
            g = error * v
            z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / p.alpha * w[i]
            n[i] = n.get(i, 0.0) + g * g
        t.update(index, value, label)
    assert np.allclose(t.z[:30], [z.get(i, 0.0) for i in range(30)])


def test_classifier_held_out(spark):
    df, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = qc.quality_classifier(df, labels).join(labels, "doc_id").where("held_out")
    assert got.where("predicted = quality").count() >= 0.96 * got.count()


def test_base_spans():
    text = ("mail a.b+c@x-y.example.org, a@b no; 10.0.255.1 and 1.2.3.256 and 1.2.3.4.5; 4111 1111-1111 1111 4111111111111112; "
            "+1 (555) 010-9999 or +12; é 12@34.56")
    got = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.base_spans(text)]
    assert got == [("email", "a.b+c@x-y.example.org"), ("ip", "10.0.255.1"), ("ip", "1.2.3.4"),
                   ("phone", "+1 (555) 010-9999"), ("email", "12@34.56")]


def test_card_is_greedy_without_retries():
    assert [k for _, k, _ in pii.base_spans("4111 1111-1111 1111")] == [2]
    assert pii.base_spans("4111 1111-1111 1111 4111111111111112") == []  # one match of 32 digits, dropped


def test_base_spans_on_table(spark):
    import re

    df = spark.read.parquet(f"{SF01}/documents.parquet")
    got = {r["doc_id"]: r for r in pii.personal_data(df).collect()}
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    secret = re.compile(r'token = "([0-9a-f]{40})"')
    for r in df.collect():
        want = [f"email:{m.start()}:{m.end()}" for m in email.finditer(r["text"])]
        assert [s for s in got[r["doc_id"]]["base_spans"].split(",") if s.startswith("email")] == want
        base, every = (set(filter(None, got[r["doc_id"]][c].split(","))) for c in ("base_spans", "spans"))
        assert base <= every
        for m in secret.finditer(r["text"]):
            assert f"secret:{m.start(1)}:{m.end(1)}" in got[r["doc_id"]]["spans"].split(",")


def test_estimate_recovers_reliabilities():
    """Votes drawn from known reliabilities: the posterior separates the classes, unreliable labelers count little."""
    r = random.Random(6)
    rates = [(0.95, 0.05), (0.9, 0.1), (0.5, 0.5), (0.85, 0.1), (0.9, 0.2)]
    counts, truth = {}, {}
    for _ in range(20_000):
        c = r.random() < 0.4
        v = "".join("y" if r.random() < (a if c else b) else "n" for a, b in rates)
        key = f"secret/1/{v}"
        counts[key] = counts.get(key, 0) + 1
        truth.setdefault(key, [0, 0])[c] += 1
    patterns = sorted(counts.items())
    post, said = pii.estimate(patterns)
    assert abs(said[0, 1, 0] - 0.95) < 0.05 and abs(said[2, 1, 0] - said[2, 0, 0]) < 0.1
    wrong = sum(truth[p][0] if q >= 0.5 else truth[p][1] for (p, _), q in zip(patterns, post))
    best = sum(min(t) for t in truth.values())
    assert wrong <= 1.1 * best + 50


def test_further_spans_do_not_overlap(spark):
    text = 'call 555-234-5678 or ssn 123-45-6789, key = "abcdef0123456789abcdef0123456789" Mr John Smith'
    df = docs(spark, [(1, text, "en", "a")])
    spans = [s.split(":") for s in pii.personal_data(df).first()["spans"].split(",") if s]
    ranges = sorted((int(a), int(b)) for _, a, b in spans)
    assert all(b <= c for (_, b), (c, _) in itertools.pairwise(ranges))
    assert pii.find(df).select(F.size("further")).first()[0] == 4
