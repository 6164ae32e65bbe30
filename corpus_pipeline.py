"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. Rows are known by a number that is unique and
the same at every read (file and place for Parquet input, so no text is copied), and
a stage decides on each row by that number: ids may repeat or be null, every row
is judged by its own text. A stage stores only the numbers of the rows that go; what its
operator stored besides is deleted before the stage returns. The texts are then read once, without those rows:
by a broadcast of the numbers if they are measured to be few, else by a join.

Of rows with linked texts the one with the smallest id stays (null ids last, then by
number). Mixing draws by id; rows with a null id draw by their text. Null, empty and very long texts are judged
whole by each operator's rules; an empty table goes through all stages; extra columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulstat.llm import mixing, sharding
from haulstat.llm.common import broadcast_small, free_name, numbered, scratch, shared_path, ship, stored
from haulstat.llm.decontamination import decontamination
from haulstat.llm.ngram_join import ngram_join
from haulstat.llm.quality_rules import quality_rules

#: Row numbers up to which they are broadcast (8 bytes each).
BROADCAST_ROWS = 2_000_000


def _without(docs: DataFrame, gone: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of ``docs`` but for those whose numbers ``gone`` returns, given the numbered rows and the number's name."""
    spark, row = docs.sparkSession, free_name(docs, "__row")
    rows = numbered(docs, row)
    path = shared_path(spark, "pipeline-gone")
    with scratch(spark):
        gone(rows, row).select(F.col(row).alias("__gone")).distinct().write.parquet(path)
    out = broadcast_small(spark.read.schema("__gone long").parquet(path), BROADCAST_ROWS)
    return rows.join(out, rows[row] == out["__gone"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return _without(docs, lambda rows, row: quality_rules(rows, id_col=row).where(~F.col("kept"))
                    .select(F.col("doc_id").alias(row)))


def join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    ship(spark)

    def gone(rows: DataFrame, row: str) -> DataFrame:
        groups = ngram_join(rows, id_col=row).select(F.col("doc_id").alias(row), "component_id")
        order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
        ids = rows.select(row, "doc_id")
        ranked = stored(groups.join(ids, row).select(row, "component_id", order.alias("order")), "pipeline-groups")
        stay = ranked.groupBy("component_id").agg(F.min("order")[row].alias("__stay"))
        return ranked.join(stay, F.col(row) == F.col("__stay"), "left_anti")

    return _without(docs, gone)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents linked with a test item go."""
    ship(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, lambda rows, row: decontamination(rows, items, id_col=row).select(F.col("doc_id").alias(row)))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents with the target shares."""
    draw = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text/"), F.md5(F.coalesce("text", F.lit("")))))
    return _without(docs, lambda rows, row: mixing.mixing(rows, id_col=row, draw=draw).where(~F.col("sampled"))
                    .select(F.col("doc_id").alias(row)))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard."""
    return sharding.sharding(docs).select("doc_id", "n_bytes", "depth", "shard")


STAGES = [("quality_rules", quality_stage), ("ngram_join", join_stage), ("decontamination", decontamination_stage),
          ("mixing", mixing_stage), ("sharding", sharding_stage)]

#: Distances of hashed histograms and alignments of words are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read again."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
