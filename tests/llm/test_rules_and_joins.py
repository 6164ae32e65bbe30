"""Quality rules, n-gram join and decontamination against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from haulstat.llm import ngram_join as nj
from haulstat.llm import quality_rules as qr
from haulstat.llm.components import components
from haulstat.llm.decontamination import MIN_SCORE, decontamination
from tests.llm import brute
from tests.llm.helpers import PROSE, SF, docs


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def check_rules(df):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]
    want = brute.quality(rows, qr.Limits(), qr.MIN_SHARE, qr.WORD_BINS,
                         ["A-ZÀ-ÖØ-Þ", "0-9", qr.CLASSES["punct"], qr.CLASSES["symbol"]])
    for r in qr.quality_rules(df).collect():
        counts, failed, kept = want[r["doc_id"]]
        assert {k: r[k] for k in counts} == counts, r["doc_id"]
        assert (r["base_failed"], r["kept"]) == (failed, kept), r["doc_id"]


def test_quality_rules(small):
    check_rules(small)


def test_repeated_words(spark, monkeypatch):
    monkeypatch.setattr(qr, "LOOKED_UP", 3)
    r = random.Random(5)
    check_rules(docs(spark, [(i, " ".join(r.choice("abcde") for _ in range(n)), "en", "a")
                             for i, n in enumerate([0, 1, 2, 3, 4, 6, 9, 30, 60, 400])]))


def test_junk_goes_clean_stays(spark):
    docs_, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    r = qr.quality_rules(docs_).join(labels, "doc_id").where("n_words >= 50")
    assert r.where("quality = 1 AND NOT kept").count() == 0
    assert r.where("quality = 0 AND kept").count() == 0


def near_copies(seed, n, words=60):
    """Copies of a text of three lines, each with up to a fifth of its words changed; ids spread."""
    r = random.Random(seed)
    base = [f"w{r.randrange(500)}" for _ in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for _ in range(r.randrange(0, 5)):
            own[r.randrange(words)] = f"x{r.randrange(10 ** 6)}"
        out.append((seed * 1000 + k, " ".join(own), "en", "a"))
    return out


@pytest.mark.parametrize("block", [512, 3])
def test_join(spark, small, monkeypatch, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = near_copies(1, 40) + near_copies(2, 12) + [(5000 + i, f"{passage} {' '.join(f'q{i}x{k}' for k in range(60))}", "en", "a")
                                                     for i in range(12)] + [(6000, "a b", "en", "a"), (6001, "A  b", "en", "a")]
    df = docs(spark, rows).unionByName(small.select("doc_id", "text", "lang", "source", "n_chars").withColumn(
        "doc_id", F.col("doc_id") + 10_000))
    want = brute.components([(r["doc_id"], r["text"]) for r in df.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.ngram_join(df).collect()}
    assert got == want


def test_components_of_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7)], "x long, y long")
    got = {r["node"]: r["component"] for r in components(edges, "x", "y").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}


def test_decontamination(spark, small):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    first = items.first()["text"].split()
    edited = " ".join(w if k % 6 else "changed" for k, w in enumerate(first))
    half = " ".join(first[:max(14, len(first) // 3)])
    more = docs(spark, [(900, f"{PROSE} {edited} {PROSE}", "en", "a"), (901, f"{PROSE} {half} {PROSE}", "en", "a")])
    df = small.select(*more.columns).unionByName(more)
    want = brute.linked_items([(r["doc_id"], r["text"]) for r in df.collect()],
                              [(r["item_id"], r["text"]) for r in items.collect()], MIN_SCORE)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination(df, items, block_words=300).collect()}
    assert (900, 0) in got and (901, 0) in got
    assert got == want


@pytest.mark.parametrize("n", [120, 60, 30, 13, 8])
def test_long_part_of_a_longer_item(spark, n):
    """A verbatim or lightly edited passage of an item is found whatever share of the item it is."""
    r = random.Random(n)
    item = [f"w{r.randrange(4000)}" for _ in range(250)]
    part = item[70:70 + n]
    edited = [w if k % 6 != 3 else "changed" for k, w in enumerate(item[40:40 + n])]
    df = docs(spark, [(1, f"{PROSE} {' '.join(part)} {PROSE}", "en", "a"), (2, PROSE * 2, "en", "a"),
                      (3, f"{PROSE} {' '.join(edited)} {PROSE}", "en", "a")])
    items = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontamination(df, items).collect()}
    assert set(got) == ({1, 3} if n >= 30 else {1} if n >= 13 else set())
    if n >= 13:
        assert got[1]["last_word"] - got[1]["first_word"] == n


def test_join_of_repeated_ids(spark):
    """Every row is compared, not one for each id; links of an id's rows are links of the id."""
    a, b, c = "q r s t u v w x y z q1 q2 q3", "a b c d e f", "one two three four five six"
    df = docs(spark, [(1, b, "en", "a"), (2, a, "en", "a"), (2, b, "en", "a"), (3, c, "en", "a"), (3, a, "en", "a"),
                      (4, "", "en", "a"), (4, c, "en", "a"), (5, None, "en", "a"), (5, None, "en", "a"), (None, a, "en", "a")])
    got = sorted((tuple(r) for r in nj.ngram_join(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (2, 9, 1), (2, 2, 1), (3, 2, 1), (3, 9, 1), (4, 0, 1), (4, 2, 1), (5, 0, 5), (5, 0, 5),
                          (None, None, None)], key=repr)
