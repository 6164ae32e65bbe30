"""Classification metrics over (label, prediction, score) columns, computed in Spark.

Confusion counts are four ``count_if`` in one pass. ROC AUC aggregates per
distinct score first (a hot score value collapses to one row), then needs the
number of negatives below each score: a prefix sum over buckets with literal
cut points (see ``order``): totals per bucket, offsets, a window inside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulstat.operators.order import bucket_of, buckets_for, cut_points
from haulstat.functions.columns import value_map  # noqa: F401  (re-exported)

# Text label of each predicted class.
LABELS = {0: "On Time", 1: "Delayed"}


def predict_label(df: DataFrame, score: str, threshold: float = 0.5,
                  out: str = "predicted_delay") -> DataFrame:
    return df.withColumn(out, (F.col(score) >= F.lit(threshold)).cast("int"))


def label_predictions(df: DataFrame, pred: str = "predicted_delay", score: str = "probability",
                      places: int = 3) -> DataFrame:
    """Rounded probability (half-even) and a text label; unmapped values give null."""
    return (df.withColumn("delay_probability", F.bround(F.col(score), places))
            .withColumn("predicted_delay_label", value_map(pred, LABELS)))


def _safe_div(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: tp, fp, fn, tn."""
    y = F.col(label)
    p = F.col(pred)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                  F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"),
                  F.count_if((y == 0) & (p == 0)).alias("tn"))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; 0 on a zero divisor."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return counts.select(
        "tp", "fp", "fn", "tn",
        _safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def confusion_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    return metrics_from_counts(confusion_counts(df, label, pred))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per-class precision / recall / F1 / support, plus macro and weighted averages."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    rows = []
    for cls, (t, fpos, fneg) in {"0": (tn, fn, fp), "1": (tp, fp, fn)}.items():
        prec = _safe_div(t, t + fpos)
        rec = _safe_div(t, t + fneg)
        rows.append(c.select(F.lit(cls).alias("class"), prec.alias("precision"), rec.alias("recall"),
                             _safe_div(2 * t, 2 * t + fpos + fneg).alias("f1"),
                             (t + fneg).cast("long").alias("support")))
    per_class = rows[0].unionByName(rows[1])
    avg = per_class.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        _safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
        _safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
        _safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"),
        F.sum("support").cast("long").alias("n"))
    macro = avg.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support"))
    weighted = avg.select(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support"))
    return per_class.unionByName(macro).unionByName(weighted)


def roc_auc(df: DataFrame, label: str, score: str, num_partitions: int | None = None) -> DataFrame:
    """One row ``roc_auc``: area under the ROC curve, tied scores counted half.

    AUC = sum over scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N).
    """
    per_score = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
                 .groupBy(F.col(score).alias("__s"))
                 .agg(F.count_if(F.col(label) == 1).alias("__pos"),
                      F.count_if(F.col(label) != 1).alias("__neg")))
    cuts = cut_points(per_score, ["__s"], buckets_for(df, num_partitions))
    placed = per_score.withColumn("__b", bucket_of(["__s"], cuts))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("__b").agg(F.sum("__neg").alias("__pn"))
               .select("__b", F.coalesce(F.sum("__pn").over(before), F.lit(0)).alias("__off")))
    w = Window.partitionBy("__b").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("__below", F.coalesce(F.sum("__neg").over(w), F.lit(0)))
    scored = local.join(F.broadcast(offsets), "__b")  # one row per bucket
    contrib = F.col("__pos") * (F.col("__off") + F.col("__below") + F.col("__neg") / 2.0)
    return scored.agg(
        F.try_divide(F.sum(contrib), F.sum("__pos").cast("double") * F.sum("__neg").cast("double"))
        .alias("roc_auc"))
