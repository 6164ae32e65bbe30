"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing extra columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from haulstat.llm import token_store
from haulstat.llm.common import shared_path
from haulstat.llm.decontamination import decontamination
from haulstat.llm.language_id import language_id
from haulstat.llm.licenses import license_scan
from haulstat.llm.merkle import manifest
from haulstat.llm.mixing import mixing
from haulstat.llm.ngram_join import ngram_join
from haulstat.llm.pii import personal_data
from haulstat.llm.preference import preferences
from haulstat.llm.quality_classifier import quality_classifier
from haulstat.llm.quality_rules import quality_rules
from haulstat.llm.sharding import sharding
from tests.llm.helpers import PROSE, clashing, odd


def tokens(df):
    path = shared_path(df.sparkSession, "test-store")
    token_store.write(df, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.digests(df.sparkSession, path)


def labels_for(df):
    return df.sparkSession.createDataFrame([(4, 1), (5, 0), (4, 0), (6, None), (None, 1)], "doc_id long, quality int")


def items_for(df):
    return df.sparkSession.createDataFrame([(1, PROSE), (2, None), (3, ""), (1, PROSE)], "item_id long, text string")


OPERATORS = {
    "tokens": tokens,
    "language": lambda df: language_id(df, public_tokenizers.path("piece_bpe_32k.model")),
    "sharding": lambda df: sharding(df, 4000),
    "rules": quality_rules,
    "mixing": mixing,
    "classifier": lambda df: quality_classifier(df, labels_for(df)),
    "join": ngram_join,
    "decontamination": lambda df: decontamination(df, items_for(df)),
    "pii": personal_data,
    "licenses": license_scan,
    "merkle": manifest,
}
PER_ROW = set(OPERATORS) - {"join", "decontamination"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    df = odd(spark)
    plain = sorted(map(repr, OPERATORS[name](df).collect()))
    if name in PER_ROW:
        assert len(plain) == df.count()
    extra = OPERATORS[name](clashing(df))
    got = sorted(map(repr, extra.collect()))
    assert got == plain


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](odd(spark).limit(0)).count() == 0


def test_defined_results(spark):
    df = odd(spark)
    lang = {r["doc_id"]: r for r in OPERATORS["language"](df).collect()}
    assert lang[1]["lang_pred"] == lang[2]["lang_pred"] == lang[9]["lang_pred"] == "und" and lang[9]["score"] == 0
    rules = {r["doc_id"]: r for r in quality_rules(df).collect()}
    assert rules[1]["n_words"] == 0 and rules[1]["base_failed"] and not rules[1]["kept"]
    join = {r["doc_id"]: r for r in ngram_join(df).collect()}
    assert len(join) == 10 and join[1]["n_shingles"] == 0 and join[1]["component_id"] == 1
    assert join[6]["component_id"] == 4 and join[7]["n_shingles"] == 1 and join[None]["component_id"] is None
    links = decontamination(df, items_for(df)).collect()
    assert sorted((r["doc_id"], r["item_id"], r["score"]) for r in links if r["doc_id"]) == [(4, 1, 1.0), (6, 1, 1.0)]
    assert [r["item_id"] for r in links if r["doc_id"] is None] == [1]
    pii = personal_data(df).where(F.col("doc_id") == 1).first()
    assert pii["spans"] == "" and pii["base_sha256"].startswith("e3b0c442")
    mix = {r["doc_id"]: r for r in mixing(df).collect()}
    assert mix[2]["source"] == "(none)" and mix[3]["lang"] == "(none)" and mix[1]["n_tokens"] == 0


def test_preference_odd(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 1, "assistant", "a"), (1, 0, None, None),
            (1, 1, "assistant", None), (2, 0, "user", "alone"), (None, 0, "user", "x"), (4, 0, "assistant", "no neighbour")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: r for r in preferences(clashing(df)).collect()}
    assert set(got) == {0, 1, 2, 4}
    assert got[4]["chosen"] == "<|assistant|>\nno neighbour\n<|end|>\n" and got[4]["prompt"] == ""  # its partner asks first
    assert got[2]["chosen"] == "<|user|>\nalone\n<|end|>\n" and got[2]["chosen_mask"] == ""
    assert got[2]["rejected"] == got[4]["chosen"] and got[2]["rejected_mask"] == "14:26"
    assert got[1]["n_prompt_turns"] in (0, 1) and got[1]["chosen"].endswith("<|assistant|>\n\n<|end|>\n")
    one = preferences(df.where("conv_id = 2")).first()
    assert one["prompt"] == "<|user|>\nalone\n<|end|>\n" and one["chosen"] == one["rejected"] == "" and one["n_prompt_turns"] == 1
    three = preferences(df.where("conv_id IN (0, 1, 2)")).collect()
    assert {r["pair_id"] for r in three} == {0, 1, 2}  # the one left over takes the first one's branch
    assert preferences(df.limit(0)).count() == 0
