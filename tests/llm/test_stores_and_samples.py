"""Token store, sharding, mixing and preference pairs."""

import itertools
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from haulstat.llm import mixing, preference, sharding, token_store
from haulstat.llm.common import shared_path
from tests.llm.helpers import docs

SF01 = "/root/testdata/sf0.01"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", "a   b", " a", "a ", "a \n b", "x\n\n  y", "\t a\t b", "don't  we'll", "é è  z", "12 345  6",
       "\r\n a", "a\x1c b", "<|endoftext|> a <|endoftext|>", "a　b c", "x \x1f y", "foo\n bar \nbaz", "  lead", "trail  ",
       "'s 's", "a <|endoftext|> b", "x<|endoftext|>\n y", "<|endoftext|", "a\0b \0c", "\0", "one\ntwo three.\nfour, \nfive", "line\n's\n12\n é.",
       "a\x85b", "so\u2028 b", "a, b. c; d!! e?! f'. g.' h-, i)) 12. 3, x2, don't. .. . !a ,b", "\n", "a\n\nb,\n c"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    return [e.ids + [token_store.END] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_whole_texts():
    e = token_store.Encoder(VOCABULARY)
    want = ids_of(ODD)
    for _ in range(2):
        assert [np.frombuffer(x, dtype=e.type).tolist() for x in e.encode(ODD)] == [w[:-1] for w in want]


def test_encoder_equals_whole_texts_on_random_marks():
    rng = random.Random(11)
    pieces = ["a", "Word", "é", "12", "'", "'s", "'ll", "$$$", "###", "%", "&", "*", "-", "/", "<", ">", "=", "@", "^", "_", "|", "~", "(",
              ")", "[", "]", "{", "}", '"', ".", ",", "!", "?", ";", ":", " ", " ", " ", "\n", "ª", "º", "²", "٣", "ʼ"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 24))) for _ in range(20_000)]
    e = token_store.Encoder(VOCABULARY)
    assert [np.frombuffer(x, dtype=e.type).tolist() for x in e.encode(texts)] == [w[:-1] for w in ids_of(texts)]


def test_store_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_store, "BUCKET_BYTES", 300_000)
    monkeypatch.setattr(token_store, "SEGMENT_BYTES", 50_000)
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(5000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string"))
    path = shared_path(spark, "test-store")
    token_store.write(df, path, VOCABULARY)
    rows = sorted((r["doc_id"], r["text"]) for r in df.collect())
    want = ids_of([t for _, t in rows])
    got = {r["doc_id"]: r for r in token_store.digests(spark, path).collect()}
    starts = [0, *itertools.accumulate(map(len, want))]
    for (i, _), ids, start in zip(rows, want, starts):
        assert (got[i]["start"], got[i]["n_tokens"]) == (start, len(ids))
        assert got[i]["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert {r["doc_id"]: r["ids"] for r in token_store.read(spark, path).collect()} == {i: w for (i, _), w in zip(rows, want)}
    assert token_store.read_one(spark, path, rows[17][0]) == want[17]
    segments = spark.read.parquet(f"{path}/segments")
    assert segments.count() > 10 and segments.agg(F.max(F.octet_length("payload"))).first()[0] <= 50_000
    ends = sorted((r["bucket"], r["segment"], r["ids"]) for r in segments.select("bucket", "segment", "ids").collect())
    order = [i for _, _, ids in ends for i in ids]
    assert order == sorted(order)
    with pytest.raises(KeyError):
        token_store.read_one(spark, path, -1)


@pytest.mark.parametrize("limit", [sharding.SHARD_BYTES, 60_000])
def test_sharding_equals_sql(spark, con, limit):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    got = sharding.sharding(df, limit)
    want = con.execute(sharding.oracle(limit)).fetchall()
    cols = ["doc_id", "n_bytes", "depth", "prefix", "part", "shard"]
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(want)
    assert got.groupBy("shard").agg(F.sum("n_bytes").alias("b")).agg(F.max("b")).first()[0] <= limit


def test_sharding_of_one_id(spark):
    """Rows that no hash bit tells apart are cut into parts that fit; a row above the limit is alone."""
    df = docs(spark, [(1, "x" * (10 + i % 30), "en", "a") for i in range(400)] + [(1, "y" * 5000, "en", "a"), (2, "z", "en", "a")])
    got = sharding.sharding(df, 1000)
    assert got.count() == 402
    sums = {r["shard"]: (r["b"], r["n"]) for r in got.groupBy("shard").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).collect()}
    assert all(b <= 1000 or n == 1 for b, n in sums.values()) and len(sums) < 60


def test_mixing_equals_sql(spark, con):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    cols = ["doc_id", "source", "lang", "topic", "n_tokens", "probability", "sampled"]
    got = sorted(tuple(r[c] for c in cols) for r in mixing.mixing(df).collect())
    want = sorted(con.execute(mixing.oracle()).fetchall())
    assert got == want
    tokens = sum(g[4] for g in got)
    assert sum(g[4] * g[5] for g in got) == pytest.approx(mixing.SHARE * tokens, rel=1e-4)


def test_mixing_meets_given_targets(spark):
    df = docs(spark, [(i, "word " * (1 + i % 7) + ("9" if i % 5 == 0 else ""), "en" if i % 3 else "fr", f"s{i % 4 == 0}")
                      for i in range(3000)])
    goal = {"lang": {"en": 0.5, "fr": 0.5}, "source": {"sTrue": 1.0, "sFalse": 3.0}}
    got, cells = mixing.plan(df, goal, None, "doc_id", "text", "source", "lang", None, 0.3)
    got = got.cache()
    expected = F.sum(F.col("n_tokens") * F.col("probability"))
    total = got.agg(expected).first()[0]
    shares = {(c, r[c]): r["e"] / total for c in ("lang", "source") for r in got.groupBy(c).agg(expected.alias("e")).collect()}
    assert shares["lang", "en"] == pytest.approx(0.5, abs=1e-3) and shares["source", "sTrue"] == pytest.approx(0.25, abs=1e-3)
    told = {(r["dimension"], r["value"]): r for r in mixing.report(cells).collect()}
    assert told["lang", "en"]["raked"] == pytest.approx(0.5, abs=1e-9) == told["lang", "en"]["target"]
    assert told["source", "sTrue"]["expected"] == pytest.approx(0.25, abs=1e-3)
    sampled = got.where("sampled").agg(F.sum("n_tokens")).first()[0]
    assert sampled == pytest.approx(total, rel=0.08)
    assert mixing.mixing(df, {"lang": {"en": 1.0}}).where("lang = 'fr' AND sampled").count() == 0


def test_a_tiny_cell_does_not_set_the_sample(spark):
    df = docs(spark, [(i, "word " * 50, "en", "a" if i % 2 else "b") for i in range(2000)] + [(5000, "only ten words " * 3, "en", "new")])
    got = mixing.mixing(df)
    sampled = {r["source"]: r["n"] for r in got.where("sampled").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert sampled["new"] == 1 and 900 < sampled["a"] + sampled["b"] < 1100
    for share in (0.0, 1.0):
        assert mixing.mixing(df, share=share).where("sampled").count() == share * 2001


def test_contradicting_targets_end(spark):
    """Targets that no weights reach (a source holds one language only) end in a result."""
    df = docs(spark, [(i, "word " * 5, "en" if i % 2 else "fr", "a" if i % 2 else "b") for i in range(40)])
    got = mixing.mixing(df, {"lang": {"en": 0.9, "fr": 0.1}, "source": {"a": 0.2, "b": 0.8}}).collect()
    assert len(got) == 40 and all(0 <= r["probability"] <= 1 for r in got)


def test_preferences_equal_sql(spark, con):
    got = preference.preferences(spark.read.parquet(f"{SF01}/conversations.parquet")).collect()
    want = con.execute(preference.oracle())
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(want.fetchall())
    ids = con.execute("SELECT count(DISTINCT conv_id) FROM conversations").fetchone()[0]
    assert len(got) == ids and len({r["n_prompt_turns"] for r in got}) > 3  # every conversation, branches at many depths


def test_preference_prefix_and_masks(spark):
    kind = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    a, b, c = ("user", "hé?"), ("assistant", "yes"), ("assistant", "no")
    cases = [(1, [a, b], [a, c]), (2, [a, b], [a, b]), (3, [a, b, a, c], [a, b]), (4, [b], [c, a]), (5, None, [a]), (6, [], [])]
    got = {r["pair_id"]: r for r in preference.preference_format(spark.createDataFrame(cases, kind)).collect()}
    assert [got[i]["n_prompt_turns"] for i in range(1, 7)] == [1, 2, 2, 0, 0, 0]
    for i, chosen, rejected in cases:
        for side, turns in (("chosen", chosen or []), ("rejected", rejected or [])):
            after = turns[got[i]["n_prompt_turns"]:]
            learned = [got[i][side][m["start"]:m["stop"]] for m in got[i][f"{side}_mask"]]
            assert learned == [t for role, t in after if role == "assistant"]
            assert got[i]["prompt"] + got[i][side] == "".join(f"<|{r}|>\n{t}\n<|end|>\n" for r, t in turns)


@pytest.mark.parametrize("limit", [60_000, 3_000, 1 << 40])
def test_written_shards(spark, tmp_path, limit):
    """Every row once with all its columns; a shard is one file within the limit, unless one row is larger; the directory says the same."""
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        docs(spark, [*((None, "n" * 900, None, "a") for _ in range(150)), *((7, "s" * 500, "en", None) for _ in range(100)),
                     (8, None, "en", "a"), (9, "", "en", "a"), (10, "x" * 100_000, "en", "a")]))
    df = df.withColumns({"shard": F.lit("?"), "__h": F.lit("h"), "depth": F.lit(1), "h": F.lit(2), "row": F.lit(3)})
    df.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    sharding.write(df, str(tmp_path / "out"), limit)
    out = sharding.read(spark, str(tmp_path / "out"))
    assert out.columns == [*df.columns, "_shard"]
    assert sorted(map(repr, out.select(*df.columns).collect())) == sorted(map(repr, df.collect()))
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))
    held = {r["_shard"]: (r["n"], r["b"], r["f"]) for r in out.withColumn("file", F.input_file_name()).groupBy("_shard").agg(
        F.count(F.lit(1)).alias("n"), size.alias("b"), F.countDistinct("file").alias("f")).collect()}
    told = spark.read.parquet(str(tmp_path / "out" / "directory")).collect()
    assert {r["shard"]: (r["n_rows"], r["n_bytes"], 1) for r in told} == held
    assert all(b <= limit or n == 1 for n, b, _ in held.values())
    plain = {(r["doc_id"], r["n_bytes"], r["depth"]) for r in sharding.sharding(df, limit).collect()}
    depths = {r["shard"]: r["depth"] for r in told}
    got = out.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"), "_shard").collect()
    assert {(r["doc_id"], r["n_bytes"], depths[r["_shard"]]) for r in got} == plain
    one = next(iter(held))
    assert sharding.read(spark, str(tmp_path / "out"), one).count() == held[one][0]


def test_written_shards_of_an_empty_table(spark, tmp_path):
    sharding.write(docs(spark, []), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "directory")).count() == 0
