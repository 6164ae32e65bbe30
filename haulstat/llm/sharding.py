"""Sharding by extendible hashing: a directory of hash prefixes in which only oversized buckets split.

A row's hash is 60 bits of the MD5 of its id. The directory starts as one
bucket; a bucket whose rows hold more than ``limit`` bytes splits on the next
hash bit, others stay. A bucket is thus the shortest prefix that fits.

The directory is found on sums, not on rows: rows are reduced once to (hash,
bytes); each round takes the oversized prefixes ``STEP`` bits deeper, with one
aggregate for all levels in between. Rounds follow the depth of the deepest bucket, and
only rows of oversized prefixes take part in the next. Nothing is collected;
the directory is a DataFrame that rows join by (depth, prefix).

Rows that all 60 bits cannot tell apart (repeated ids) and that together
exceed the limit are cut into parts: rows above half the limit alone, others by
their running sum in steps of half the limit, so each part fits unless a
single row does not. A row larger than the limit is a shard of its own.

``write`` puts every row, with all its columns, into its shard's file and the directory beside them. Rows
find their bucket in the directory as they are read (by the bits that all buckets share, then by
the bucket's own), so their texts are shuffled once, to their shard.

Null text: 0 bytes. Null id: the hash of the empty string. Very long texts: counted whole; one above the limit is
a shard alone. Ties: rows of one hash share a bucket until it must be cut into parts. Empty table: no
rows, an empty directory. Repeated rows are all assigned. Extra columns are ignored by ``sharding`` and kept by ``write``,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulstat.llm.common import broadcast_small, free_name, numbered, stored

BITS, STEP = 60, 6
SHARD_BYTES = 1 << 20
WRITE_BYTES = 256 << 20  # bytes of text of a written shard
DIRECTORY_ROWS = 2_000_000  # buckets up to which the directory is broadcast (about 20 bytes each)
PART_ROWS = 100_000  # rows of one undividable bucket that are cut together


def hash_bits(id_: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def prefix(h: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def directory(sizes: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Buckets (depth, prefix, bytes) that fit, and the prefixes of ``BITS`` bits that do not."""
    depth = 0
    frontier = None  # prefixes of ``depth`` bits that hold too much; None: the root, not yet looked at
    root = sizes.agg(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"), F.sum("n_bytes").alias("bytes"))
    leaves = stored(root.where(F.col("bytes") <= limit), "shard-root")
    if sizes.isEmpty() or not leaves.isEmpty():
        return leaves, sizes.sparkSession.createDataFrame([], "prefix long")
    while depth < BITS:
        rows = sizes if frontier is None else sizes.join(
            frontier.withColumnRenamed("prefix", "__p"), prefix(F.col("h"), depth) == F.col("__p"), "left_semi")
        deep = depth + STEP
        bins = rows.groupBy(prefix(F.col("h"), deep).alias("b")).agg(F.sum("n_bytes").alias("bytes"))
        level = bins.withColumn("depth", F.explode(F.sequence(F.lit(depth + 1), F.lit(deep))))
        totals = stored(level.groupBy("depth", F.call_function("shiftright", "b", F.lit(deep) - F.col("depth")).alias("prefix"))
                        .agg(F.sum("bytes").alias("bytes")), "shard-levels")
        fits = totals.where(F.col("bytes") <= limit)
        above = fits.select((F.col("depth") + 1).alias("__d"), F.col("prefix").alias("__p"))
        leaves = leaves.unionByName(fits.join(
            above, (F.col("depth") == F.col("__d")) & (F.call_function("shiftright", "prefix", F.lit(1)) == F.col("__p")),
            "left_anti"))
        frontier = totals.where((F.col("depth") == deep) & (F.col("bytes") > limit)).select("prefix")
        depth = deep
        if frontier.isEmpty():
            break
    return stored(leaves, "shard-directory"), frontier


def assign(sizes: DataFrame, leaves: DataFrame, full: DataFrame, limit: int) -> DataFrame:
    """``sizes`` (with h and n_bytes) plus depth, prefix and part."""
    depths = sorted(r["depth"] for r in leaves.select("depth").distinct().collect())  # at most BITS + 1 numbers
    at = sizes.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths]).cast("array<int>")))
    at = at.withColumn("prefix", prefix(F.col("h"), F.col("depth")))
    placed = at.join(leaves.select("depth", "prefix"), ["depth", "prefix"]).withColumn("part", F.lit(0).cast("long"))
    cols = [*sizes.columns, "depth", "prefix", "part"]
    return placed.select(cols).unionByName(parts(sizes, full, limit).select(cols))


def parts(sizes: DataFrame, full: DataFrame, limit: int) -> DataFrame:
    """The rows of the prefixes of ``BITS`` bits that hold too much, cut into parts."""
    rest = (sizes.withColumn("prefix", F.col("h")).join(full, "prefix", "left_semi")
            .withColumn("depth", F.lit(BITS)).withColumn("__row", F.monotonically_increasing_id()))
    count = rest.groupBy("prefix").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("__n"))
    rest = rest.join(count, "prefix").withColumn("__salt", F.pmod(F.xxhash64("__row"), F.col("__n")))
    alone = F.col("n_bytes") * 2 > limit
    w = Window.partitionBy("prefix", "__salt", alone).orderBy("__row")
    step = F.when(alone, F.row_number().over(w) - 1).otherwise(
        F.floor((F.sum("n_bytes").over(w) - F.col("n_bytes")) * 2 / limit))
    rest = rest.withColumn("part", ((step * F.col("__n") + F.col("__salt")) * 2 + alone.cast("int")).cast("long"))
    return rest


def sharding(df: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, n_bytes, depth (hash bits used), prefix, part and the shard's name."""
    sizes = stored(df.select(F.col(id_col).alias("doc_id"), hash_bits(F.col(id_col)).alias("h"),
                             F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")), "shard-sizes")
    leaves, full = directory(sizes, limit)
    return assign(sizes, leaves, full, limit).select(
        "doc_id", "n_bytes", F.col("depth").cast("int").alias("depth"), "prefix", "part",
        shard_name("h", "depth", "part").alias("shard"))


def shard_name(h: str, depth: str, part: str) -> Column:
    """The hash bits that the bucket uses, a point, the part."""
    bits = F.when(F.col(depth) == 0, "").otherwise(F.expr(f"substring(lpad(bin(`{h}`), {BITS}, '0'), 1, `{depth}`)"))
    return F.concat(bits, F.lit("."), F.col(part).cast("string"))


def folder_name(h: str, depth: str, part: str) -> Column:
    """A shard's name with a letter before it, so that a reader of folders takes it for text."""
    return F.concat(F.lit("b"), shard_name(h, depth, part))


def write(df: DataFrame, path: str, limit: int = WRITE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``path``/data, one file per shard in the folder shard=name, and ``path``/directory.

    The directory holds per shard its name, depth, prefix, part, n_rows and n_bytes. An input column called
    ``shard`` is kept; the folders' column then has an underscore before its name.
    """
    row, h, depth, part, shard = (free_name(df, n) for n in ("__row", "__h", "__depth", "__part", "shard"))
    rows = numbered(df, row)
    sizes = stored(rows.select(F.col(row).alias("row"), hash_bits(F.col(id_col)).alias("h"),
                               F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")), "shard-sizes")
    leaves, full = directory(sizes, limit)
    assigned = assign(sizes, leaves, full, limit).withColumn("shard", folder_name("h", "depth", "part"))
    (assigned.groupBy("shard", F.col("depth").cast("int").alias("depth"), "prefix", "part")
     .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_bytes").alias("n_bytes")).write.parquet(f"{path}/directory"))

    shared = leaves.agg(F.min("depth")).first()[0] or 0  # bits that all buckets use
    own = F.lit(BITS) - F.col("__d")
    buckets = broadcast_small(leaves.select(
        F.col("depth").alias("__d"), F.col("prefix").alias("__p"),
        F.call_function("shiftright", "prefix", F.col("depth") - F.lit(shared)).alias("__c")), DIRECTORY_ROWS)
    at = rows.withColumn(h, hash_bits(F.col(id_col)))
    found = at.join(buckets, (prefix(F.col(h), shared) == F.col("__c")) & (F.call_function("shiftright", h, own) == F.col("__p")))
    found = found.withColumns({depth: F.col("__d"), part: F.lit(0).cast("long")})
    cut = parts(sizes, full, limit).select(F.col("row").alias("__r"), F.col("part").alias("__n"))
    rest = at.join(cut, F.col(row) == F.col("__r")).withColumns({depth: F.lit(BITS), part: F.col("__n")})
    kept = [F.col(f"`{c}`") for c in df.columns]
    both = [x.withColumn(shard, folder_name(h, depth, part)).select(*kept, shard) for x in (found, rest)]
    both[0].unionByName(both[1]).repartition(shard).write.partitionBy(shard).parquet(f"{path}/data")


def read(spark: SparkSession, path: str, shard: str | None = None) -> DataFrame:
    """The rows of a written store, or of one shard, whose folder alone is then read."""
    rows = spark.read.parquet(f"{path}/data")
    return rows if shard is None else rows.where(F.col(rows.columns[-1]) == shard)


def oracle(limit: int = SHARD_BYTES, documents: str = "documents") -> str:
    """DuckDB SQL for ``sharding`` where no two rows share all hash bits; depths to 40."""
    return f"""
WITH sizes AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {BITS // 4}) AS BIGINT) AS h
  FROM {documents}),
levels AS (
  SELECT d, h >> ({BITS} - d) AS p, sum(n_bytes) AS bytes
  FROM sizes, (SELECT CAST(range AS INTEGER) AS d FROM range(0, 41)) GROUP BY ALL),
placed AS (
  SELECT doc_id, n_bytes, h, min(d) AS depth
  FROM sizes JOIN levels ON p = h >> ({BITS} - d) WHERE bytes <= {limit} GROUP BY ALL)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth, CAST(h >> ({BITS} - depth) AS BIGINT) AS prefix,
       CAST(0 AS BIGINT) AS part,
       substr(right(CAST(CAST(h AS BIT) AS VARCHAR), {BITS}), 1, CAST(depth AS INTEGER)) || '.0' AS shard
FROM placed"""
