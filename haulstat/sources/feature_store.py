"""Versioned feature tables on plain Parquet: committed batches, a bucketed snapshot, newest row per key on read.

Layout of a table ``{root}/{name}/v{version}``:

* ``data/{unique}``: the files of one batch or snapshot, written by Spark under a name of its own;
* ``_commits/{number}.json``: one manifest per commit. It names the data, the rows
  written, keys, event time and schema. A batch is part of the table when its manifest is there.

A manifest is put in place only if its number is still free, so two writers that
finish together get consecutive numbers and neither batch is lost; the loser of a number tries the next one. Data
without a manifest (a failed write) is never read. Row counts and null keys are observed
while the batch is written, without a scan of their own; null primary keys are refused before the commit.

Reading resolves each key to its row from the highest batch. ``compact`` writes
that state as a snapshot bucketed and sorted by the key; from then on only
later batches are shuffled: their newest rows replace the snapshot's by an anti-join that
reads the snapshot bucket by bucket, and earlier history is not read at all.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COL = "batch_id"


def latest_per_key(df: DataFrame, keys: Sequence[str], batch_col: str = BATCH_COL,
                   event_time: str | None = None) -> DataFrame:
    """For each key, the row of its highest batch.

    Rows of one key within a batch are ordered by event time, then by all
    other columns: the greatest wins, whatever the order of the files.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    first = [batch_col, *([event_time] if event_time else [])]
    order = F.struct(*[F.col(c) for c in first], *[F.col(c) for c in others if c not in first])
    agg = df.groupBy(*keys).agg(F.max_by(row, order).alias("__row"))
    return agg.select(*keys, *[F.col("__row").getField(c).alias(c) for c in others])


@dataclass
class FeatureGroup:
    root: str
    name: str
    version: int
    primary_key: list[str]
    event_time: str | None = None

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name}/v{self.version}"

    def _hadoop_fs(self, spark: SparkSession):
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(conf), p, jvm

    def _put_if_absent(self, spark: SparkSession, name: str, text: str) -> bool:
        """Whether this call made ``_commits/{name}``; its content is whole as soon as it is there."""
        fs, _, jvm = self._hadoop_fs(spark)
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits/{name}")
        fs.mkdirs(target.getParent())
        if fs.getUri().getScheme() == "file":  # a shared mount: linking is atomic there, Hadoop's create is not
            final = target.toUri().getPath()
            own = f"{final}.{uuid.uuid4().hex}.tmp"
            with open(own, "w", encoding="utf-8") as f:
                f.write(text)
            try:
                os.link(own, final)
            except FileExistsError:
                return False
            finally:
                os.remove(own)
            return True
        try:
            out = fs.create(target, False)
        except Exception:  # noqa: BLE001  taken, or a real failure
            if fs.exists(target):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def commits(self, spark: SparkSession) -> list[dict]:
        """The manifests in order; one that is not whole yet is not part of the table."""
        fs, _, jvm = self._hadoop_fs(spark)
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits")
        if not fs.exists(folder):
            return []
        names = sorted(n for n in (st.getPath().getName() for st in fs.listStatus(folder)) if n.endswith(".json"))
        out = []
        for n in names:  # one small file per commit
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits/{n}"))
            try:
                text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                out.append(json.loads(text))
            except json.JSONDecodeError:
                continue
        return out

    def _commit(self, spark: SparkSession, entry: dict) -> int:
        taken = self.commits(spark)
        number = taken[-1]["number"] + 1 if taken else 0
        while not self._put_if_absent(spark, f"{number:012d}.json", json.dumps(entry | {"number": number})):
            number += 1
        return number

    def _checked(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        missing = [k for k in self.primary_key if k not in df.columns]
        if missing:
            raise KeyError(f"primary key columns missing: {missing}")
        nameless = F.lit(False)
        for k in self.primary_key:
            nameless = nameless | F.col(k).isNull()
        seen = Observation()
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(nameless).alias("null_keys")), seen

    def _entry(self, df: DataFrame, data: str, rows: int, kind: str, **more) -> dict:
        return {"kind": kind, "data": data, "rows": rows, "primary_key": self.primary_key, "event_time": self.event_time,
                "schema": json.loads(df.schema.json())} | more

    def insert(self, df: DataFrame) -> int:
        """Append ``df`` as a batch; returns its batch id (the commit's number)."""
        data = f"data/{uuid.uuid4().hex}"
        checked, seen = self._checked(df)
        checked.write.parquet(f"{self.path}/{data}")
        found = seen.get
        if found["null_keys"]:
            raise ValueError(f"{found['null_keys']} rows without a primary key {self.primary_key}; nothing was added")
        return self._commit(df.sparkSession, self._entry(df, data, found["rows"], "batch"))

    def _rows_of(self, spark: SparkSession, entry: dict) -> DataFrame:
        rows = spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(f"{self.path}/{entry['data']}")
        return rows.withColumn(BATCH_COL, F.lit(entry["number"]))

    def _together(self, spark: SparkSession, entries: Sequence[dict]) -> DataFrame:
        parts = [self._rows_of(spark, e) for e in entries]
        if not parts:
            raise ValueError(f"{self.name} version {self.version} holds no batch yet")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def read_all(self, spark: SparkSession) -> DataFrame:
        """Every row of every batch with its ``batch_id``."""
        return self._together(spark, [e for e in self.commits(spark) if e["kind"] == "batch"])

    def read(self, spark: SparkSession, with_batch: bool = False, snapshot: int | None = None) -> DataFrame:
        """Newest row per primary key (with the batch it came from, if asked), from the last snapshot or the one named."""
        entries = self.commits(spark)
        base = next((e for e in reversed(entries) if e["kind"] == "snapshot" and snapshot in (None, e["number"])), None)
        later = [e for e in entries if e["kind"] == "batch" and (base is None or e["number"] > base["upto"])]
        if base is None:
            out = latest_per_key(self._together(spark, later), self.primary_key, event_time=self.event_time)
        else:
            out = self._bucketed(spark, base)
            if later:
                new = latest_per_key(self._together(spark, later), self.primary_key, event_time=self.event_time)
                out = out.join(new.select(*self.primary_key), self.primary_key, "left_anti").unionByName(
                    new, allowMissingColumns=True)
        return out if with_batch else out.drop(BATCH_COL)

    def read_from(self, spark: SparkSession, snapshot: int) -> DataFrame:
        """Newest row per primary key from the snapshot of that commit and the batches after it."""
        return self.read(spark, snapshot=snapshot)

    def _bucketed(self, spark: SparkSession, entry: dict) -> DataFrame:
        """A snapshot as the catalog knows it: bucketed by the key, so a join on the key does not shuffle it."""
        name = f"snapshot_{entry['data'].rsplit('/', 1)[1]}"
        if not spark.catalog.tableExists(name):
            kind = T.StructType.fromJson(entry["schema"]).toDDL()
            keys = ", ".join(f"`{k}`" for k in self.primary_key)
            spark.sql(f"CREATE TABLE {name} ({kind}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                      f"INTO {entry['buckets']} BUCKETS LOCATION '{self.path}/{entry['data']}'")
        return spark.table(name)

    def compact(self, spark: SparkSession, buckets: int | None = None) -> int:
        """Writes the newest row per key as a bucketed snapshot; returns its commit's number."""
        entries = [e for e in self.commits(spark) if e["kind"] == "batch"]
        now = self.read(spark, with_batch=True)
        data, n = f"data/{uuid.uuid4().hex}", buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        checked, seen = self._checked(now)
        name = f"snapshot_{data.rsplit('/', 1)[1]}"
        (checked.repartition(n, *self.primary_key).write.bucketBy(n, *self.primary_key).sortBy(*self.primary_key)
         .option("path", f"{self.path}/{data}").format("parquet").saveAsTable(name))
        return self._commit(spark, self._entry(now, data, seen.get["rows"], "snapshot", buckets=n, upto=entries[-1]["number"]))


def get_or_create(root: str, name: str, version: int, primary_key: Sequence[str],
                  event_time: str | None = None) -> FeatureGroup:
    return FeatureGroup(root, name, version, list(primary_key), event_time)


def round_trip_counts(group: FeatureGroup, df: DataFrame) -> tuple[int, int]:
    """Insert ``df`` and read the group back: (rows written, as observed by the write, and rows read)."""
    number = group.insert(df)
    written = next(e["rows"] for e in group.commits(df.sparkSession) if e["number"] == number)
    return written, group.read(df.sparkSession).count()


def default_root(spark: SparkSession) -> str:
    """Shared storage for feature tables: ``haulstat.featureStore.root``, else beside the checkpoints."""
    root = spark.conf.get("haulstat.featureStore.root", None)
    if root:
        return root
    ck = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not ck:
        raise ValueError("set haulstat.featureStore.root (or spark.checkpoint.dir) to shared storage")
    return os.path.join(ck, "feature_store")
