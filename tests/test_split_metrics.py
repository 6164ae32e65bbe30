"""Time split, distributed rank, confusion metrics against the published numbers, ROC AUC."""

import random

import pytest

from haulstat.operators.metrics import class_report, confusion_metrics, metrics_from_counts, roc_auc
from haulstat.operators.order import ordered_rank
from haulstat.operators.split import split_cutoff, time_split
from tests.conftest import ts


@pytest.mark.parametrize("n,expected", [(12308, 9846), (10, 8), (5, 4)])
def test_cutoff(n, expected):
    assert split_cutoff(n, 0.2) == expected


def test_split_boundary_ties_by_key(spark):
    rows = [(i, ts("2024-01-01 07:00:00")) for i in range(6)] + [(10 + i, ts("2024-01-02 07:00:00")) for i in range(4)]
    df = spark.createDataFrame(rows, "trip_id int, d timestamp_ntz")
    out = {r["trip_id"]: r["split"] for r in time_split(df, "d", ["trip_id"]).collect()}
    assert sum(v == "train" for v in out.values()) == 8
    assert [out[10], out[11], out[12], out[13]] == ["train", "train", "test", "test"]


def test_split_rows_without_time_sort_last(spark):
    rows = [(1, ts("2024-01-01 07:00:00")), (2, ts("2024-01-02 07:00:00")), (3, None), (4, None), (5, None)]
    df = spark.createDataFrame(rows, "trip_id int, d timestamp_ntz")
    out = {r["trip_id"]: r["split"] for r in time_split(df, "d", ["trip_id"]).collect()}
    assert out == {1: "train", 2: "train", 3: "train", 4: "train", 5: "test"}


def test_ordered_rank_is_global(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(20)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, v int")
    got = {r["id"]: r["rank"] for r in ordered_rank(df, ["v", "id"]).collect()}
    expected = {rid: k + 1 for k, (rid, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == expected


@pytest.mark.parametrize("tp,fp,fn,tn,acc,prec,rec,f1", [
    (245, 136, 723, 1358, 0.6511, 0.6430, 0.2531, 0.3632),
    (522, 91, 446, 1403, 0.7819, 0.8515, 0.5393, 0.6603),
])
def test_published_rates_from_counts(spark, tp, fp, fn, tn, acc, prec, rec, f1):
    counts = spark.createDataFrame([(tp, fp, fn, tn)], "tp long, fp long, fn long, tn long")
    m = metrics_from_counts(counts).first()
    assert round(m["accuracy"], 4) == acc and round(m["precision"], 4) == prec
    assert round(m["recall"], 4) == rec and round(m["f1"], 4) == f1


def test_zero_divisor_gives_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    m = confusion_metrics(df, "y", "p").first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0 and m["accuracy"] == 1.0


def test_class_report_shape(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (0, 0), (0, 0)], "y int, p int")
    rows = {r["class"]: r for r in class_report(df, "y", "p").collect()}
    assert set(rows) == {"0", "1", "macro avg", "weighted avg"}
    assert rows["1"]["support"] == 2 and rows["0"]["support"] == 3


def test_auc_matches_rank_formula_with_ties(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(2), rnd.randrange(30) / 10.0) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = roc_auc(df, "y", "s", num_partitions=5).first()[0]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(expected)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_matches_python_sort(spark, seed):
    import datetime as dt
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1, 7)
    rows = [(i, None if rnd.random() < 0.03 else base + dt.timedelta(days=rnd.randrange(6), hours=rnd.choice([0, 0, 5])))
            for i in range(rnd.randrange(50, 200))]
    df = spark.createDataFrame(rows, "trip_id int, d timestamp_ntz")
    got = {r["trip_id"]: r["split"] for r in time_split(df, "d", ["trip_id"], test_size=0.2).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or base, r[0]))
    cutoff = split_cutoff(len(rows), 0.2)
    expected = {r[0]: ("train" if i < cutoff else "test") for i, r in enumerate(order)}
    assert got == expected
