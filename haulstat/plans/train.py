"""Training, evaluation, persistence and scoring of the delay classifiers on Spark ML.

Models: logistic regression (L2, C = 1 as regParam = 1 / n_train, no internal
standardisation because inputs are already scaled) and a random forest
(300 trees, depth 10, sqrt features, seed 42). Both are trained on the same
scaled inputs, because scoring always scales. Everything fitted (categories,
traffic threshold, scaler statistics, feature list, model) is saved next to
the model so scoring applies exactly the training transformation.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulstat.operators import metrics as M
from haulstat.operators.features import Scaler, align_columns, fit_categories, fit_scaler, quantile_value
from haulstat.operators.forest import fit_forest
from haulstat.operators.split import time_split
from haulstat.plans import trips as P
from haulstat.plans.bindings import CATEGORICAL_COLUMNS, TRIP_KEYS
from haulstat.sources.snapshots import stored

TARGET = "delay"


@dataclass
class Artifacts:
    """Everything scoring needs besides the model itself."""

    feature_columns: list[str]
    categories: dict[str, list[str]]
    traffic_threshold: float | None
    scaler_means: dict[str, float] = field(default_factory=dict)
    scaler_stds: dict[str, float] = field(default_factory=dict)

    @property
    def scaler(self) -> Scaler:
        return Scaler(self.feature_columns, self.scaler_means, self.scaler_stds)


def make_classifier(kind: str, n_train: int, *, num_trees: int = 300, max_depth: int = 10, seed: int = 42):
    if kind == "logistic_regression":
        return LogisticRegression(featuresCol="features", labelCol=TARGET, maxIter=1000,
                                  regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                  standardization=False)
    if kind == "random_forest":
        return RandomForestClassifier(featuresCol="features", labelCol=TARGET, numTrees=num_trees,
                                      maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed)
    raise ValueError(kind)


def _with_probability(pred: DataFrame) -> DataFrame:
    return pred.withColumn("probability_1", vector_to_array("probability")[1]) \
               .withColumn("predicted_delay", F.col("prediction").cast("int"))


def evaluate(pred: DataFrame) -> DataFrame:
    """One row: confusion counts, accuracy, precision, recall, F1 and ROC AUC."""
    m = M.confusion_metrics(pred, TARGET, "predicted_delay")
    auc = M.roc_auc(pred, TARGET, "probability_1").scalar()
    return m.withColumn("roc_auc", auc)


def feature_importances(spark: SparkSession, model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """Forest importances (normalised to sum 1) by feature name, largest first."""
    forest = model.stages[-1]
    values = forest.featureImportances.toArray().tolist()
    return (spark.createDataFrame(list(zip(columns, [float(v) for v in values])), "feature string, importance double")
            .orderBy(F.desc("importance"), "feature"))


ROWS_PER_PART = 500_000  # at most about so many rows of training data in one partition


def even_parts(df: DataFrame) -> int:
    """Partitions for many passes over ``df``: a multiple of the cores, so that all of them work until a pass ends."""
    cores = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    return cores * max(-(-df.count() // (cores * ROWS_PER_PART)), 1)


def train_and_evaluate(full: DataFrame, *, test_size: float = 0.2, kinds: Sequence[str] = (
        "logistic_regression", "random_forest"), num_trees: int = 300, max_depth: int = 10,
        categories: Mapping[str, Sequence[str]] | None = None, keys: Sequence[str] = TRIP_KEYS):
    """Split by time, scale on train, fit each model, evaluate on test.

    Returns (models by kind, artifacts, metrics DataFrame with one row per model).
    """
    split = time_split(full, "departure_date", list(keys), test_size=test_size)
    split = P.materialize(split.repartition(even_parts(full), *keys))
    cats = {k: list(v) for k, v in (categories or fit_categories(split, CATEGORICAL_COLUMNS)).items()}
    matrix = P.model_matrix(split, categories=cats)
    feature_cols = [c for c in matrix.columns if c not in (TARGET, "split", "trip_id")]
    train = matrix.where(F.col("split") == "train")
    test = matrix.where(F.col("split") == "test")
    scaler = fit_scaler(train, feature_cols)
    assembler = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep")
    # the fits and scores pass over the scaled rows many times
    train_s = stored(scaler.transform(train, fill_mean=True).select(F.col(TARGET).cast("double").alias(TARGET), *feature_cols),
                     "scaled-train")
    n_train = train_s.count()
    test_s = scaler.transform(test, fill_mean=True).withColumn(TARGET, F.col(TARGET).cast("double"))
    models, rows = {}, []
    for kind in kinds:
        classifier = make_classifier(kind, n_train, num_trees=num_trees, max_depth=max_depth)
        model = (PipelineModel([assembler, fit_forest(train_s, feature_cols, classifier)]) if kind == "random_forest"
                 else Pipeline(stages=[assembler, classifier]).fit(train_s))
        # the training summary refers to the whole session, which tasks that score with the model cannot take along
        model.stages[-1]._java_obj.setSummary(full.sparkSession._jvm.scala.Option.apply(None))
        models[kind] = model
        train_acc = (_with_probability(model.transform(train_s))
                     .agg(F.avg((F.col("predicted_delay") == F.col(TARGET)).cast("double"))).scalar())
        scored = _with_probability(model.transform(test_s)).select(TARGET, "predicted_delay", "probability_1")
        rows.append(evaluate(stored(scored, f"scored-{kind}"))  # several passes: the rows go through the trees once
                    .withColumn("model", F.lit(kind)).withColumn("train_accuracy", train_acc))
    metrics = rows[0]
    for r in rows[1:]:
        metrics = metrics.unionByName(r)
    threshold = quantile_value(full, "no_of_vehicles", 0.75).first()[0] if "no_of_vehicles" in full.columns else None
    art = Artifacts(feature_cols, cats, threshold, scaler.means, scaler.stds)
    return models, art, metrics


def save(models: Mapping[str, PipelineModel], art: Artifacts, path: str,
         spark: SparkSession | None = None) -> None:
    """Each model under ``{path}/{kind}`` plus ``{path}/artifacts`` (Hadoop paths work)."""
    for kind, model in models.items():
        model.write().overwrite().save(f"{path.rstrip('/')}/{kind}")
    spark = spark or SparkSession.getActiveSession()
    (spark.createDataFrame([(json.dumps(asdict(art)),)], "artifacts string")
     .coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/artifacts"))


def load(spark: SparkSession, path: str, kind: str = "random_forest") -> tuple[PipelineModel, Artifacts]:
    model = PipelineModel.load(f"{path.rstrip('/')}/{kind}")
    text = spark.read.text(f"{path.rstrip('/')}/artifacts").first()[0]
    return model, Artifacts(**json.loads(text))


def load_reference_tables(spark: SparkSession, paths) -> dict[str, DataFrame]:
    """Cleaned static tables that new trips are joined against (every table but the schedule)."""
    from haulstat.operators.clean import clean_tables
    from haulstat.sources.tables import load_all
    tables = clean_tables(load_all(spark, paths))
    tables.pop("truck_schedule", None)
    return tables


def build_features_for_new_trips(new_trips: DataFrame, tables: Mapping[str, DataFrame],
                                 art: Artifacts, **kwargs) -> DataFrame:
    """New schedule rows through the same joins and features, with the training threshold."""
    t = dict(tables)
    t["truck_schedule"] = new_trips
    merged = P.build_trips(t, **kwargs)
    return P.engineer_features(merged, traffic_threshold=art.traffic_threshold)


def predict_delay(new_trips: DataFrame, tables: Mapping[str, DataFrame], model: PipelineModel,
                  art: Artifacts, keep: Sequence[str] = ("truck_id", "route_id", "departure_date",
                                                         "estimated_arrival"), **kwargs) -> DataFrame:
    """Predicted label, probability (3 places, half-even) and text label per new trip.

    The trip keys ride along as extra columns (the assembler ignores them);
    categories come from training and the columns are aligned to the fitted
    feature list, so a batch with one category or a missing column still
    produces the training layout.
    """
    feats = build_features_for_new_trips(new_trips, tables, art, **kwargs)
    keys = [c for c in keep if c in feats.columns]
    matrix = P.model_matrix(feats, categories=art.categories,
                            id_columns=[c for c in P.ID_COLUMNS if c in feats.columns and c not in keys])
    aligned = align_columns(matrix, [*keys, *art.feature_columns])
    scored = _with_probability(model.transform(art.scaler.transform(aligned, fill_mean=True)))
    out = scored.select(*keys, "predicted_delay", F.col("probability_1").alias("probability"))
    return M.label_predictions(out).drop("probability")


def results_table(metrics: DataFrame) -> DataFrame:
    """Model comparison: one row per model, rounded to 4 places."""
    cols = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    return metrics.select("model", *[F.round(c, 4).alias(c) for c in cols])
