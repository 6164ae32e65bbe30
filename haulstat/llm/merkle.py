"""Merkle manifest of a dataset: rank digits are grouped away inside bounded blocks, child structs nested in their parent.

A row's leaf is the SHA-256 of its fields. Inside a group the leaves ascend by
id; runs of 8 consecutive nodes are hashed together, level by level, until one
is left, the group's subroot. Subroots, in the order of their group, go on alike to one root.

How: leaves (a few hashes a row, never texts) are stored with a row number, and
ranked inside their group by counts per bucket of the order, so no task
holds a group. A rank's octal digits are columns. Its last three are grouped away
one after another inside a block (512 ranks), all by one exchange on the block:
each level collects its child structs and adds its own hash, so a block's row
nests its whole subtree. The blocks' hashes are the leaves of the next tier, 512 times
smaller, until one block is left; then the subroots are nodes of a last tree of the same form.

Proofs come back down: a tier's nested rows are exploded digit by digit, where
each struct sees its siblings beside it, so no level joins anything. Only the path above a block is
joined to the block's row, once a tier. A proof is, for each level, the hashes left and right of the path.

Null fields hash as ``-``. The null group comes first; groups then go by their UTF-8 bytes. Null ids come first in
their group; equal ids go by their leaf (rows equal in all fields are interchangeable). Empty and very long
texts are fields like others. Every row has one result row. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulstat.llm.common import stored
from haulstat.operators.order import bucket_of, buckets_for, cut_points, ordered_rank

FAN, DIGITS = 8, 3
BLOCK = FAN ** DIGITS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A path: per level the concatenated hashes left and right of it, from below to above.
PATH = "array<struct<l:string,r:string>>"


def node_hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as hashed: its UTF-8 length, a colon and the value; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``g`` not null, ``id``, ``leaf``, ``row`` unique) plus ``rank`` from 0 and ``n`` rows in their group."""
    order = ["g", "id", "leaf", "row"]
    placed = leaves.withColumn("b", bucket_of(order, cut_points(leaves, order, buckets_for(leaves, None))))
    inside = Window.partitionBy("g")
    before = inside.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    counts = (placed.groupBy("g", "b").agg(F.count(F.lit(1)).alias("c"))  # a row for each bucket that a group reaches into
              .select("g", "b", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("off"), F.sum("c").over(inside).alias("n")))
    at = F.row_number().over(Window.partitionBy("g", "b").orderBy("id", "leaf", "row"))
    return placed.withColumn("at", at).join(counts, ["g", "b"]).select(
        *leaves.columns, (F.col("off") + F.col("at") - 1).cast("long").alias("rank"), "n")


def _alone(level: int) -> Column:
    """Whether one node is left at ``level`` (0: the tier's own nodes), so nothing is hashed above it."""
    return F.col("n") <= FAN ** level


def rollup(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """One tier: nodes (``g``, ``rank``, ``n``, ``digest``, payload) to block rows (``g``, ``rank``, ``n``, ``digest``, ``kids``).

    ``kids`` nests the block's subtree: structs of ``digest`` and ``kids`` down to those of ``digest`` and the payload.
    """
    digits = [F.call_function("shiftright", "rank", F.lit(3 * i)).alias(f"p{i}") for i in range(DIGITS + 1)]
    level = nodes.select("g", "n", *digits, F.struct(F.col("rank").alias("at"), "digest", *payload).alias("node"))
    level = level.repartition("g", f"p{DIGITS}")
    for i in range(1, DIGITS + 1):
        keys = ["g", "n", *[f"p{j}" for j in range(DIGITS, i - 1, -1)]]
        level = level.groupBy(*keys).agg(F.sort_array(F.collect_list("node")).alias("kids"))
        digest = F.when(_alone(i - 1), F.col("kids")[0]["digest"]).otherwise(
            node_hash(F.concat_ws("", F.col("kids.digest"))))
        level = level.select(*keys, F.struct(F.col(f"p{i}").alias("at"), digest.alias("digest"), "kids").alias("node"))
    return level.select("g", F.col(f"p{DIGITS}").alias("rank"),
                        F.call_function("shiftright", F.col("n") + (BLOCK - 1), F.lit(3 * DIGITS)).alias("n"), F.col("n").alias("below"),
                        F.col("node.digest").alias("digest"), F.col("node.kids").alias("kids"))


def unroll(blocks: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The nodes of a tier's block rows with their whole path: the nested structs exploded digit by digit.

    ``blocks`` also have ``path`` (above the block). Result: ``g``, carried columns, ``node``, ``path``.
    """
    out = blocks.withColumn("n", F.col("below"))
    levels = []
    for i in range(DIGITS, 0, -1):
        out = out.withColumn("all", F.col("kids.digest"))
        out = out.select("*", F.posexplode("kids").alias("pos", "node"))
        sides = F.struct(F.array_join(F.slice("all", F.lit(1), F.col("pos")), "").alias("l"),
                         F.array_join(F.slice("all", F.col("pos") + 2, F.lit(FAN)), "").alias("r"))
        levels.insert(0, f"s{i}")
        keep = ["g", "n", "path", *carried, *levels[1:]]
        rest = [F.col("node.kids").alias("kids")] if i > 1 else [F.col("node")]
        out = out.select(*keep, F.when(~_alone(i - 1), sides).alias(f"s{i}"), *rest)
    own = F.filter(F.array(*levels), lambda s: s.isNotNull())
    return out.select("g", *carried, "node", F.concat(own, F.col("path")).alias("path"))


def _tiers(nodes: DataFrame, payload: Sequence[str], name: str) -> list[DataFrame]:
    """The stored block rows of all tiers, the lowest first; each group is one block in the last."""
    out = [stored(rollup(nodes, payload), name)]
    while not out[-1].where(F.col("n") > 1).isEmpty():
        out.append(stored(rollup(out[-1].select("g", "rank", "n", "digest")), name))
    return out


def _paths(tiers: list[DataFrame], top: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Nodes of the lowest tier with their paths; ``top``: ``g``, ``path`` and carried columns of every group."""
    above = top.withColumn("rank", F.lit(0).cast("long"))
    for t in reversed(tiers):
        nodes = unroll(t.join(above, ["g", "rank"]), carried)
        above = nodes.select("g", *carried, "path", F.col("node.at").alias("rank"))
    return nodes


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: node_hash(s["l"], acc, s["r"]))


def proof_hash(path: Column) -> Column:
    """One hash over a path's siblings, from below to above, left to right."""
    return F.sha2(F.aggregate(path, F.lit(""), lambda acc, s: F.concat(acc, s["l"], s["r"])), 256)


def proofs(leaves: DataFrame) -> DataFrame:
    """Per row of ``leaves`` (``id``, ``g`` string or null, ``leaf``, ``shown``): its path to the root and the hashes on it.

    ``shown`` is the leaf that is to be verified. Result: id, leaf, subroot, root, ``path``, proof_sha256,
    folded_root (from ``shown`` and the path) and verified.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col("g")), F.lit(""))  # never null, in the order of the groups
    rows = stored(leaves.select(group.alias("g"), "id", "leaf", "shown", F.monotonically_increasing_id().alias("row")), "leaves")
    nodes = ranked_leaves(rows).select("g", "id", "rank", "n", F.col("leaf").alias("digest"), "shown")
    low = _tiers(nodes, ["shown", "id"], "merkle")
    tops = low[-1].select("g", "digest")
    high = ordered_rank(tops, ["g"]).select(F.lit("").alias("g"), (F.col("rank") - 1).alias("rank"),
                                            F.lit(tops.count()).cast("long").alias("n"), "digest", F.col("g").alias("group"))
    high = _tiers(high, ["group"], "merkle-groups")
    root = high[-1].select("digest").first()
    root = F.lit(root["digest"] if root else None).cast("string")
    empty = high[-1].select("g", F.array().cast(PATH).alias("path"))
    groups = _paths(high, empty, []).select(F.col("node.group").alias("g"), F.col("node.digest").alias("subroot"), "path")
    found = _paths(low, groups, ["subroot"]).select(
        F.col("node.id").alias("id"), F.col("node.digest").alias("leaf"), "subroot", root.alias("root"), "path",
        F.col("node.shown").alias("shown"))
    return (found.withColumns({"proof_sha256": proof_hash(F.col("path")), "folded_root": fold(F.col("shown"), F.col("path"))})
            .withColumn("verified", F.col("folded_root") == F.col("root")).drop("shown"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             shown: dict[str, Column] | None = None) -> DataFrame:
    """Proofs of every row of ``df``. ``shown``: columns as someone shows them for verification, by default as they are."""
    changed = {c: (shown or {}).get(c) for c in fields}
    leaf = node_hash(*[field(F.col(c)) for c in fields])
    now = leaf if not shown else node_hash(*[field(F.col(c) if v is None else v) for c, v in changed.items()])
    differs = F.lit(False)
    for c, v in changed.items():
        differs = differs if v is None else differs | ~v.eqNullSafe(F.col(c))
    leaves = df.select(F.col(group_col).cast("string").alias("g"), F.col(id_col).alias("id"), leaf.alias("leaf"),
                       (F.when(differs, now) if shown else F.lit(None).cast("string")).alias("now"))
    leaves = leaves.select("g", "id", "leaf", F.coalesce("now", "leaf").alias("shown"))
    return proofs(leaves).withColumnRenamed("id", id_col)


def tampered_manifest(df: DataFrame) -> DataFrame:
    """The manifest of ``documents``, verified against texts that are lower-cased where 3 divides the id's crc32."""
    third = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    shown = {"text": F.when(third, lower_ascii(F.col("text"))).otherwise(F.col("text"))}
    return manifest(df, shown=shown).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
