"""The pipeline and the registered queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as cp
from haulstat.llm import mixing, quality_rules as qr, queries, sharding
from haulstat.llm.decontamination import MIN_SCORE
from tests.llm import brute
from tests.llm.helpers import SF


def test_registered():
    names = {n.split("_")[0] for n in queries.QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "ngram_join", "decontamination", "mixing", "sharding"]


def test_pipeline_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = brute.quality([d[:3] for d in docs], qr.Limits(), qr.MIN_SHARE, qr.WORD_BINS,
                         ["A-ZÀ-ÖØ-Þ", "0-9", qr.CLASSES["punct"], qr.CLASSES["symbol"]])
    docs = [d for d in docs if good[d[0]][2]]
    groups = brute.components([d[:2] for d in docs])
    docs = [d for d in docs if groups[d[0]][1] == d[0]]
    leaks = {d for d, _ in brute.linked_items([d[:2] for d in docs], items, MIN_SCORE)}
    docs = [d for d in docs if d[0] not in leaks]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", docs)
    con.execute(f"CREATE TABLE kept AS SELECT * FROM documents WHERE doc_id IN "
                f"(SELECT doc_id FROM ({mixing.oracle()}) WHERE sampled)")
    want = con.execute(f"SELECT doc_id, n_bytes, depth, shard FROM ({sharding.oracle(documents='kept')})").fetchall()
    got = cp.run(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "depth", "shard"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def texts(df):
    return sorted((r["text"] or "") for r in df.collect())


@pytest.mark.parametrize("new_id", ["CAST(NULL AS BIGINT)", "doc_id % 7", "IF(doc_id % 2 = 0, doc_id, NULL)"])
@pytest.mark.parametrize("stage", [cp.quality_stage, cp.join_stage, cp.decontamination_stage])
def test_null_and_repeated_ids_are_judged_by_row(spark, tmp_path, stage, new_id):
    """Whatever the ids, the same texts are kept as under distinct ids; each text's copies are as many as they were."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120)
    items = [(1, docs.first()["text"])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = docs.limit(1).select(F.lit(10 ** 6).cast("long").alias("doc_id"), *[c for c in docs.columns if c != "doc_id"])
    docs = docs.unionByName(extra).unionByName(extra.withColumns({"doc_id": F.lit(10 ** 6 + 1).cast("long"), "text": F.lit("")}))
    want = texts(stage(spark, docs, str(tmp_path)))
    got = texts(stage(spark, docs.withColumn("doc_id", F.expr(new_id)), str(tmp_path)))
    if stage is cp.join_stage:  # which of a group stays is told by the id
        assert len(got) == len(want) < docs.count() and got.count(items[0][1]) <= 1
    else:
        assert got == want and 0 < len(want) < docs.count()


def test_join_survivor_has_the_smallest_id(spark):
    rows = [(None, "a b c d e f g h"), (9, "a b c d e f g h"), (3, "a b c d e f g h"), (3, "a b c d e f g h"),
            (3, "q r s t u v w x"), (None, "q r s t u v w x"), (None, "i j k l m n o p"), (None, "i j k l m n o p"), (3, "lone")]
    got = cp.join_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(3, "a b c d e f g h"), (3, "q r s t u v w x"), (None, "i j k l m n o p"), (3, "lone")], key=repr)


def test_mixing_draws_rows_without_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert 0 < cp.mixing_stage(spark, nameless, SF).count() < docs.count()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    from tests.test_entry import _rows

    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert _rows(E.queries()[name](spark, SF).toPandas()) == _rows(con.execute(E.oracle_sql()[name]).df())
