"""The forest grown from histograms: counts against plain routing, Spark ML's own forest, odd rows."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from haulstat.operators import forest as FO

COLS = ["a", "b", "c"]


def _assembled(df):
    return VectorAssembler(inputCols=COLS, outputCol="features", handleInvalid="keep").transform(df)


def _rows(spark, n, classes=2):
    """``a`` has 5 values and ``b`` many, both tell about the label; ``c`` is constant; a tenth of the labels are turned."""
    u = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    y = (F.col("a") + F.col("b")) * classes / 5
    return (spark.range(n).repartition(3, "id").select("id", (F.col("id") % 5).cast("double").alias("a"), u.alias("b"),
                                                       F.lit(1.0).alias("c"))
            .withColumn("y", F.floor(F.least(y, F.lit(classes - 0.5))))
            .withColumn("y", F.when(F.col("id") % 10 == 3, classes - 1 - F.col("y")).otherwise(F.col("y")).cast("double")))


def _forest(trees=20, depth=4, **more):
    return RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=trees, maxDepth=depth,
                                  featureSubsetStrategy="sqrt", seed=42, **more)


@pytest.mark.parametrize("classes", [2, 3])
def test_nodes_hold_the_drawn_rows_that_reach_them(spark, monkeypatch, classes):
    monkeypatch.setattr(FO, "BLOCK_ROWS", 1)  # every batch a block
    df = _rows(spark, 600, classes)
    cuts = FO.fit_bins(df, COLS, 8)
    assert cuts[0].tolist() == [0.5, 1.5, 2.5, 3.5] and len(cuts[1]) == 7 and len(cuts[2]) == 0
    blocks = FO.binned(df, COLS, "y", cuts, classes)
    trees = FO.grow(blocks, [(len(c) + 1) * classes for c in cuts], classes, num_trees=4, max_depth=3, per_node=2, seed=7)
    stored = [(r["part"], r["seq"], np.frombuffer(r["codes"], np.uint8).reshape(3, r["n"])) for r in blocks.collect()]
    assert sum(codes.shape[1] for _, _, codes in stored) == 600 and len(stored) > 1
    for number, tree in enumerate(trees):
        seen = np.zeros((len(tree.left), classes))
        for part, seq, codes in stored:
            for row, times in zip(codes.T, FO.bootstrap(codes.shape[1], 7, number, part, seq)):
                node = 0
                while True:
                    seen[node, row[0] % classes] += times
                    if not tree.left[node]:
                        break
                    node = tree.left[node] + int(row[tree.feature[node]] // classes > tree.bin[node])
        assert np.array_equal(seen, np.array(tree.stats)) and len(tree.left) > 3


def test_the_chosen_split_is_the_best_of_all():
    h = np.random.default_rng(3).integers(0, 9, (40, 2, 6, 2)).astype(float)
    h[:, 1] = h[:, 0, ::-1]  # both features hold the same rows
    place, at, gain, total, left = FO.choose(h, 1)
    gini = lambda c: 1 - sum((x / sum(c)) ** 2 for x in c)
    for i in range(len(h)):
        n, best = h[i, 0].sum(), -1.0
        for f in range(2):
            for b in range(5):
                lo, hi = h[i, f, :b + 1].sum(axis=0), h[i, f, b + 1:].sum(axis=0)
                if lo.sum() and hi.sum():
                    best = max(best, gini(total[i]) - (lo.sum() * gini(lo) + hi.sum() * gini(hi)) / n)
        assert abs(gain[i] - best) < 1e-12 and np.array_equal(left[i], h[i, place[i], :at[i] + 1].sum(axis=0))


def test_bootstrap_counts_are_poisson_and_repeat():
    w = FO.bootstrap(200_000, 42, 1, 0, 0)
    assert np.array_equal(w, FO.bootstrap(200_000, 42, 1, 0, 0)) and not np.array_equal(w, FO.bootstrap(200_000, 42, 2, 0, 0))
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01


def test_all_rows_train_and_spark_ml_only_lends_the_form(spark, monkeypatch):
    """Spark ML's trainer keeps a count a row and tree: it must not be given the rows."""
    df, fitted, fit = _rows(spark, 3000), [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, d, *a: fitted.append(d.count()) or fit(self, d, *a))
    model = FO.fit_forest(df, COLS, _forest())
    assert fitted == [2]
    own = fit(_forest(), _assembled(df))
    scored = _assembled(df)
    p = [np.array([r[0] for r in m.transform(scored).select(vector_to_array("probability")[1]).collect()]) for m in (model, own)]
    y = np.array([r[0] for r in df.select("y").collect()])
    assert abs(p[0] - p[1]).mean() < 0.05 and abs(((p[0] > 0.5) == y).mean() - ((p[1] > 0.5) == y).mean()) < 0.02
    assert abs(model.featureImportances.toArray() - own.featureImportances.toArray()).max() < 0.1
    assert (model.numClasses, model.numFeatures, model.getNumTrees) == (2, 3, 20)


def test_odd_rows(spark):
    nan = spark.createDataFrame([(float("nan") if i % 2 else float(i % 12), 0.0, 1.0, float(i % 2)) for i in range(60)], [*COLS, "y"])
    model = FO.fit_forest(nan, COLS, _forest())
    assert model.transform(_assembled(nan)).where("prediction != y").count() == 0  # NaN lies above all values
    one = FO.fit_forest(nan.withColumn("y", F.lit(1.0)), COLS, _forest(trees=3))
    assert one.totalNumNodes == 3 and one.predict(_assembled(nan).first()["features"]) == 1.0
    assert FO.fit_forest(nan.limit(1), COLS, _forest(trees=30)).getNumTrees == 30  # some trees draw no row
    for bad in (None, -1.0, 0.5):
        with pytest.raises(ValueError, match="without a class"):
            FO.fit_forest(nan.withColumn("y", F.when(F.col("b") == 0, F.lit(bad))), COLS, _forest())
    with pytest.raises(ValueError, match="no rows"):
        FO.fit_forest(nan.limit(0), COLS, _forest())
