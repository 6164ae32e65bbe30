"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulstat.session import ensure_checkpoint_dir

#: Remainder of crc32(doc_id as text) mod FOLDS that is held out of every fit.
FOLDS, HELD_OUT = 3, 1


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors (once per context), as ``--py-files`` would."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parents[2]
    if not root.is_dir() or any(str(f).endswith("haulstat-package.zip") for f in sc._python_includes):
        return
    archive = Path(tempfile.mkdtemp(prefix="haulstat-")) / "haulstat-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((root / "haulstat").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCOPES: list[list[str]] = []


def _files(spark: SparkSession, path: str):
    """The path and its file system, as the driver's Hadoop client knows them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate data under the shared checkpoint directory; gone when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/haulstat-llm/{name}-{uuid.uuid4().hex}"
    p, fs = _files(spark, path)
    fs.deleteOnExit(p)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that ``shared_path`` names inside are deleted at the end: for steps whose result is written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            p, fs = _files(spark, path)
            fs.delete(p, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def _scans_parquet(df: DataFrame) -> bool:
    """Whether ``df`` is a table of Parquet files as read, so that a row has a file and a place in it."""
    try:
        plan = df._jdf.queryExecution().analyzed()
        return plan.getClass().getSimpleName() == "LogicalRelation" and "_metadata" not in df.columns and bool(
            df.select("_metadata.file_path", "_metadata.row_index"))
    except Exception:  # noqa: BLE001  not a file scan, or a session without access to its plans
        return False


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` plus ``name``, a long that is unique per row and the same whenever the row is read.

    Rows of Parquet files are numbered by a hash of the file's path (as many bits as tell all files apart)
    and the row's place in it, without a copy; anything else is stored once with a number.
    """
    if _scans_parquet(df):
        path, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        files = stored(df.select(path.alias("f"), at.alias("i")).groupBy("f").agg(F.max("i").alias("i")), "files")
        n, most = files.agg(F.count(F.lit(1)), F.max("i")).first()
        for bits in range(2 * n.bit_length(), min(2 * n.bit_length() + 12, 62 - int(most or 0).bit_length())):
            hashed = F.pmod(F.xxhash64("f"), F.lit(1 << bits))
            if files.select(hashed).distinct().count() == n:
                place = F.pmod(F.xxhash64(path), F.lit(1 << bits)) * (1 << (62 - bits)) + at
                return df.select("*", place.alias(name))
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so later steps do not recompute it."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def words(text: Column) -> Column:
    """Words of a text: runs of anything but space and the controls 0x09 to 0x0D (null text: none)."""
    spaced = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def broadcast_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has been measured to hold at most ``max_rows`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
