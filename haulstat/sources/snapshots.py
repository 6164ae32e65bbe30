"""Tables written once to the cluster's shared folder and read by everything that needs them.

``stored`` keeps one DataFrame's rows: later steps read files (their size is
known to the optimizer, a lost executor re-reads them) in place of running its plan again. ``snapshot``
does so once per key in a session, a key being the input files and the parameters
that the rows follow from. All folders lie under ``spark.checkpoint.dir``; they are deleted when the
driver's JVM ends, or by ``drop_snapshots``.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from haulstat.session import ensure_checkpoint_dir

_KEPT: dict[tuple[str, str], str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder still to be written, under the shared one."""
    path = f"{ensure_checkpoint_dir(spark)}/haulstat/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_files(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, list]:
    """Per input its files with length and time of change, as the driver's Hadoop client lists them."""
    out = {}
    for name, path in sorted(paths.items()):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.listStatus(p) if fs.exists(p) else []
        out[name] = sorted([f.getPath().toString(), f.getLen(), f.getModificationTime()] for f in found)
    return out


def kept_folder(spark: SparkSession, name: str, paths: Mapping[str, str], parameters: object,
                write: Callable[[str], None]) -> str:
    """A folder that ``write(path)`` filled, at the first call with these input files and parameters in this application."""
    key = hashlib.sha256(json.dumps([name, input_files(spark, paths), parameters], default=str).encode()).hexdigest()
    kept = (spark.sparkContext.applicationId, key)
    if kept not in _KEPT:
        path = new_folder(spark, name)
        write(path)
        _KEPT[kept] = path
    return _KEPT[kept]


def snapshot(spark: SparkSession, name: str, paths: Mapping[str, str], parameters: object,
             build: Callable[[], DataFrame]) -> DataFrame:
    """The rows of ``build()``, written once per input files and parameters."""
    return spark.read.parquet(kept_folder(spark, name, paths, parameters, lambda path: build().write.parquet(path)))


def drop_snapshots(spark: SparkSession) -> int:
    """Deletes the snapshots of this application; the number of folders."""
    mine = [k for k in _KEPT if k[0] == spark.sparkContext.applicationId]
    for k in mine:
        p = spark._jvm.org.apache.hadoop.fs.Path(_KEPT.pop(k))
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(mine)
