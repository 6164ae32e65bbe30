"""N-gram Jaccard join: documents whose sets of five-word shingles overlap by 0.75 or more, exactly.

Words are runs of anything but white space, A-Z lower-cased; a shingle is known
by a 64-bit hash. The join narrows down in exact steps and ends in tries:

1. One pass over the texts: each document's shingles are dealt by hash to
   groups, as packed arrays; a group counts its shingles and tells each document how many of
   its own are in other documents too. A document with fewer than 75 % such
   shingles is linked with nothing. Documents with equal sets form one class,
   the smallest id stands for it.
2. Over the sets of the remaining class representatives, shingles are ordered
   by frequency, rarest first (ties by hash). Linked sets share a shingle among
   their first ``n - ceil(0.75 n) + 1`` (prefix filter). Documents that share
   one belong to one cluster (components of the shared prefix shingles).
3. Each cluster's sets go into prefix trees: shingles ordered by their frequency in the
   tree's unit, the common ones first, a node being a run of them; sets that begin alike share
   its path, whose overlap with a probing set is computed once; a subtree is left as soon as the overlap so far plus the
   shingles that remain on either side cannot reach the threshold, or its sizes cannot fit.

Large clusters: first all sets are compared with one pivot, the set whose
shingles are most common in the cluster. Sets linked with it are one component;
pairs within a component need no further look. Each other set then probes
tries of at most ``BLOCK`` sets, one task for a block of probes and a block of
tries, until all pairs of different components are decided. No pair of a cluster
is skipped and none is written out unless it joins two components of its task.

A unit of large clusters is a task's group of its own, at most 2 x ``BLOCK`` sets;
small clusters share groups of about ``BLOCK`` sets.

Links end in ``components``; the result is one row per row. Repeated ids: every
row is compared by a number of its own, and links of any of an id's rows are links of
the id. Null id: a row of nulls. Null or empty text: empty set, component is the
document itself. Very long texts: whole, a set is one row. Empty table: no rows.
Ids are integers. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulstat.llm.common import numbered, stored
from haulstat.llm.components import components

WIDTH = 5
PERCENT = 75
GROUP_BYTES = 4 << 20  # text whose shingles make one counting group, on average
FLUSH = 1_000_000  # shingles packed at a time
BLOCK = 512  # sets in a trie
CACHE_WORDS = 300_000
SLICE = 128

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _C[1]
        x = (x ^ (x >> np.uint64(27))) * _C[2]
        return x ^ (x >> np.uint64(31))


class Shingler:
    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        words = [t.lower().split() if t else [] for t in texts]
        flat = [w for ws in words for w in ws]
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in flat:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, flat), dtype=np.uint64, count=len(flat))
        with np.errstate(over="ignore"):
            rolled = np.zeros(max(len(h) - WIDTH + 1, 0), dtype=np.uint64)
            for k in range(WIDTH):
                rolled = rolled * _C[0] + h[k:k + len(rolled)]
            rolled = mix(rolled)
            out, at = [], 0
            for ws in words:
                n = len(ws)
                if n >= WIDTH:
                    out.append(np.unique(rolled[at:at + n - WIDTH + 1]))
                elif n:
                    x = np.uint64(n)
                    for v in h[at:at + n]:
                        x = x * _C[3] + v
                    out.append(mix(np.array([x])))
                else:
                    out.append(np.zeros(0, dtype=np.uint64))
                at += n
        return out


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        return (int(mix(s ^ _C[3]).sum(dtype=np.uint64).astype(np.int64)),
                int(mix(s + _C[0]).sum(dtype=np.uint64).astype(np.int64)))


def required(n: np.ndarray | int, m: np.ndarray | int):
    """Smallest overlap of two linked sets of n and m shingles."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


# --- step 1: documents that may be linked -------------------------------------------------------

PACKED = "dest int, docs binary, sizes binary, data binary"
PROFILE = "doc_id long, n_shared long, n long, h1 long, h2 long"


def deal(groups: int):
    """Rows of (group, documents, sizes, shingles) for the groups, and of signatures for groups below 0."""
    def run(batches):
        shingler, ids, sets, held = Shingler(), [], [], 0
        for b in batches:
            raw = b.column(1).cast(pa.binary())
            for at in range(0, b.num_rows, SLICE):
                new = shingler.sets(raw.slice(at, SLICE).to_pylist())
                ids.append(b.column(0).slice(at, SLICE).to_numpy())
                sets += new
                held += sum(map(len, new))
                if held >= FLUSH:
                    yield pack(np.concatenate(ids), sets, groups)
                    ids, sets, held = [], [], 0
        if ids:
            yield pack(np.concatenate(ids), sets, groups)

    return run


def pack(ids: np.ndarray, sets: list[np.ndarray], groups: int) -> pa.RecordBatch:
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    dest = ((flat >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(dest, kind="stable")
    dest, doc, flat = dest[order], np.repeat(np.arange(len(sets)), size)[order], flat[order].astype(np.uint32)
    cuts = np.flatnonzero(np.diff(dest)) + 1
    rows = []
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dest)]):
        if hi > lo:
            at = np.concatenate([[0], np.flatnonzero(np.diff(doc[lo:hi])) + 1])
            count = np.diff(np.append(at, hi - lo))
            rows.append((int(dest[lo]), ids[doc[lo:hi][at]].tobytes(), count.astype(np.uint32).tobytes(),
                         flat[lo:hi].tobytes()))
    signed = np.array([signature(s) for s in sets], dtype=np.int64).reshape(-1, 2)
    rows.append((-1 - int(ids[0] % groups), ids.tobytes(), size.astype(np.uint32).tobytes(), signed.tobytes()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
        (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["dest", "docs", "sizes", "data"])


def count_shared(group: pa.Table) -> pa.Table:
    """Per document of the group: how many of its shingles here are in another row as well; or its signature."""
    part = [np.concatenate([np.frombuffer(x, dtype=t) for x in group.column(c).to_pylist()])
            for c, t in (("docs", np.int64), ("sizes", np.uint32))]
    ids, size = part[0], part[1].astype(np.int64)
    data = b"".join(group.column("data").to_pylist())
    if group.column("dest")[0].as_py() < 0:
        signed = np.frombuffer(data, dtype=np.int64).reshape(-1, 2)
        cols = [ids, np.zeros(len(ids), dtype=np.int64), size, signed[:, 0], signed[:, 1]]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "n_shared", "n", "h1", "h2"])
    tokens = np.frombuffer(data, dtype=np.uint32)
    _, where, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = np.add.reduceat((count[where] > 1).astype(np.int64), np.concatenate([[0], np.cumsum(size)[:-1]]))
    some = shared > 0
    empty = pa.nulls(int(some.sum()), pa.int64())
    return pa.table([pa.array(ids[some]), pa.array(shared[some], pa.int64()), empty, empty, empty],
                    names=["doc_id", "n_shared", "n", "h1", "h2"])


def profiles(rows: DataFrame) -> DataFrame:
    """Per document id: set size, signature, and how many shingles other documents have too (at least)."""
    size = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    packed = rows.mapInArrow(deal(64 + int(size // GROUP_BYTES)), PACKED)
    counted = packed.groupBy("dest").applyInArrow(count_shared, PROFILE)
    own = F.max(F.struct("n", "h1", "h2"))
    return (counted.groupBy("doc_id").agg(F.sum("n_shared").alias("n_shared"), own.alias("s"))
            .select("doc_id", "n_shared", "s.n", "s.h1", "s.h2"))


# --- step 2: clusters of documents that may be linked with each other ---------------------------------

def sets_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of ``wanted`` documents (doc_id, n, h1, h2): doc_id, n, tokens (sorted 64-bit numbers)."""
    def run(batches):
        shingler = Shingler()
        for b in batches:
            raw = b.column(1).cast(pa.binary())
            for at in range(0, b.num_rows, SLICE):
                ids, n, h1, h2 = (b.column(i).slice(at, SLICE).to_pylist() for i in (0, 2, 3, 4))
                sets = shingler.sets(raw.slice(at, SLICE).to_pylist())
                keep = [i for i, s in enumerate(sets) if (len(s), *signature(s)) == (n[i], h1[i], h2[i])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in keep], pa.int64()), pa.array([n[i] for i in keep], pa.int64()),
                     pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["doc_id", "n", "tokens"])

    joined = rows.join(wanted, "doc_id").select("doc_id", "__text", "n", "h1", "h2")
    return joined.mapInArrow(run, "doc_id long, n long, tokens binary")


def prefixes(sets: DataFrame) -> DataFrame:
    """Per document: its prefix's shingles that others have (``prefix``), and its shingles' mean frequency."""
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 64):
                ids, n, tokens = (b.column(c).slice(i, 64).to_pylist() for c in range(3))
                each = [np.frombuffer(t, dtype=np.int64) for t in tokens]
                size = [len(x) for x in each]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, size), pa.int64()), pa.array(np.repeat(n, size), pa.int64()),
                     pa.array(np.concatenate(each))], ["doc_id", "n", "token"])

    tokens = sets.mapInArrow(run, "doc_id long, n long, token long")
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    per_doc = (tokens.join(often, "token").groupBy("doc_id", "n")
               .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("l")))
    alone = F.col("n") - F.size("l")  # shingles of this document only: first in the order
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    total = F.aggregate("l", F.lit(0).cast("long"), lambda a, x: a + x["df"])
    return per_doc.select("doc_id", F.transform(F.slice("l", F.lit(1), F.greatest(length - alone, F.lit(0)).cast("int")),
                                                lambda x: x["token"]).alias("prefix"),
                          ((total + alone) / F.col("n")).alias("mean_df"))


def clusters(prefix: DataFrame) -> DataFrame:
    """doc_id, cluster of every document that shares a prefix shingle."""
    tokens = prefix.select("doc_id", F.explode("prefix").alias("token"))
    first = stored(tokens.groupBy("token").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("c"))
                   .where("c > 1").select("token", "first"), "first")
    edges = tokens.join(first, "token").where(F.col("doc_id") != F.col("first")).select("doc_id", "first")
    return components(edges, "doc_id", "first").select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))


# --- step 3: prefix trees ------------------------------------------------------------------------

class Trie:
    """Sets as paths; level k of a path is the set's ranks in [cuts[k - 1], cuts[k]), equal ways share a node."""

    def __init__(self, ranks: list[np.ndarray], sizes: np.ndarray, top: int) -> None:
        self.sizes, self.cuts = sizes, []
        step, at = 16, 16
        while at < top:
            self.cuts.append(at)
            step *= 2
            at += step
        self.cuts.append(max(top, 1))
        node = np.zeros(len(ranks), dtype=np.int64)  # of each set, at the level above
        lower = np.zeros(len(ranks), dtype=np.int64)
        self.levels = []
        for cut in self.cuts:
            upper = np.array([np.searchsorted(r, cut) for r in ranks], dtype=np.int64)
            ways: dict[tuple[int, bytes], int] = {}
            new = np.array([ways.setdefault((p, r[lo:hi].tobytes()), len(ways)) for p, r, lo, hi in zip(
                node.tolist(), ranks, lower.tolist(), upper.tolist())], dtype=np.int64)
            parts = [np.frombuffer(w, dtype=np.int32) for _, w in ways]
            rest = np.array([len(r) for r in ranks], dtype=np.int64) - upper
            most, least, largest = (np.full(len(ways), v) for v in (0, 1 << 62, 0))
            np.maximum.at(most, new, rest)
            np.minimum.at(least, new, sizes)
            np.maximum.at(largest, new, sizes)
            self.levels.append((np.array([p for p, _ in ways], dtype=np.int64), np.concatenate(parts),
                                np.cumsum([0, *map(len, parts)]), most, least, largest))
            node, lower = new, upper
        self.leaf = node

    def probe(self, ranks: np.ndarray, size: int, flag: np.ndarray) -> np.ndarray:
        """Sets linked with the probing set; ``flag`` is a scratch array over all ranks."""
        flag[ranks] = 1
        overlap = np.zeros(1, dtype=np.int64)
        alive = np.ones(1, dtype=bool)
        for cut, (parent, flat, start, most, least, largest) in zip(self.cuts, self.levels):
            here = alive[parent] & (largest * 100 >= PERCENT * size) & (least * PERCENT <= 100 * size)
            at = np.flatnonzero(here)
            length = start[at + 1] - start[at]
            ends = np.cumsum(length)
            pick = np.arange(ends[-1] if len(at) else 0) + np.repeat(start[at] - (ends - length), length)
            hits = np.concatenate([[0], np.cumsum(flag[flat[pick]])])
            now = np.zeros(len(parent), dtype=np.int64)
            now[at] = overlap[parent[at]] + hits[ends] - hits[ends - length]
            rest = len(ranks) - np.searchsorted(ranks, cut)
            here[at] = now[at] + np.minimum(rest, most[at]) >= required(size, least[at])
            overlap, alive = now, here
            if not here.any():
                break
        flag[ranks] = 0
        if not alive.any():
            return np.zeros(0, dtype=np.int64)
        got = np.flatnonzero(alive[self.leaf]) if len(alive) else np.zeros(0, dtype=np.int64)
        o = overlap[self.leaf[got]]
        return got[100 * o >= PERCENT * (size + self.sizes[got] - o)]


def join_unit(ids: np.ndarray, tokens: list[np.ndarray], component: np.ndarray, probing: np.ndarray,
              stored_: np.ndarray) -> list[tuple[int, int]]:
    """Links between probing and stored sets that join two components."""
    every = np.concatenate(tokens)
    names, where, count = np.unique(every, return_inverse=True, return_counts=True)
    order = np.lexsort((names, -count))
    top = int((count > 1).sum())  # shingles of one set only match nothing
    rank = np.empty(len(names), dtype=np.int32)
    rank[order] = np.arange(len(names), dtype=np.int32)
    ranks, at = [], 0
    for t in tokens:
        r = np.sort(rank[where[at:at + len(t)]])
        ranks.append(r[:np.searchsorted(r, top)])
        at += len(t)
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    trie = Trie([ranks[i] for i in stored_], sizes[stored_], top)
    flag = np.zeros(max(top, 1), dtype=np.int64)
    root = {int(c): int(c) for c in component}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links = []
    for i in probing:
        for j in stored_[trie.probe(ranks[i], int(sizes[i]), flag)]:
            a, b = find(int(component[i])), find(int(component[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(ids[i]), int(ids[j])))
    return links


def join_pack(group: pa.Table) -> pa.Table:
    """All units of a group of units."""
    group = group.sort_by([("unit", "ascending"), ("doc_id", "ascending")])
    unit = np.array(group.column("unit").to_pylist(), dtype=np.int64)
    ids, component = (group.column(c).to_numpy() for c in ("doc_id", "component"))
    role = group.column("role").to_numpy()  # 1 probing, 2 stored, 3 both
    links: list[tuple[int, int]] = []
    cuts = np.flatnonzero(np.diff(unit)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(unit)]):
        some = np.arange(lo, hi)
        probing, kept = np.flatnonzero(role[some] & 1), np.flatnonzero(role[some] & 2)
        if len(probing) and len(kept):
            tokens = [np.frombuffer(t, dtype=np.uint64) for t in group.column("tokens").slice(lo, hi - lo).to_pylist()]
            links += join_unit(ids[lo:hi], tokens, component[lo:hi], probing, kept)
    return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])


def with_pivots(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Links (a, b) of large clusters' sets with their pivot."""
    def run(batches):
        for b in batches:
            out = []
            for i, n, t, j, m, p in zip(*(b.column(k).to_pylist() for k in range(6))):
                x, y = np.frombuffer(t, dtype=np.uint64), np.frombuffer(p, dtype=np.uint64)
                o = len(np.intersect1d(x, y, assume_unique=True))
                if i != j and 100 * o >= PERCENT * (n + m - o):
                    out.append((i, j))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    each = pivots.select("cluster", F.col("doc_id").alias("p_id"), F.col("n").alias("p_n"), F.col("tokens").alias("p_tokens"),
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    return (members.join(each, ["cluster", "block"]).select("doc_id", "n", "tokens", "p_id", "p_n", "p_tokens")
            .mapInArrow(run, "a long, b long"))


def links(sets: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly the sets connected by a Jaccard similarity of PERCENT or more."""
    prefix = stored(prefixes(sets), "prefixes")
    member = stored(clusters(prefix).join(prefix.select("doc_id", "mean_df"), "doc_id"), "clusters")
    size = member.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.max(F.struct("mean_df", (-F.col("doc_id")).alias("d"))).alias("p"))
    size = stored(size.select("cluster", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
                              (-F.col("p.d")).alias("pivot")), "cluster-sizes")
    docs = stored(member.select("doc_id", "cluster").join(size, "cluster").join(sets, "doc_id")
                  .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")), "members")
    large = docs.where("blocks > 1")
    pivot = stored(with_pivots(large, large.where(F.col("doc_id") == F.col("pivot"))).distinct(), "pivot-links")
    linked = pivot.select(F.col("a").alias("doc_id"), F.col("b").alias("component"))
    large = large.join(linked, "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    left = F.col("component") != F.col("pivot")  # the pivot's own component probes nothing
    waiting = stored(large.where(left).groupBy("cluster").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("probes")), "waiting")
    large = large.join(waiting, "cluster")
    trie_rows = large.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("probes") - 1))).select(
        F.array("cluster", F.col("i").cast("long"), F.col("block").cast("long")).alias("unit"),
        F.lit(2).alias("role"), "doc_id", "component", "tokens")
    probe_rows = (large.where(left).withColumn("i", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("probes")))
                  .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .select(F.array("cluster", F.col("i").cast("long"), F.col("j").cast("long")).alias("unit"),
                          F.lit(1).alias("role"), "doc_id", "component", "tokens"))
    small_rows = docs.where("blocks = 1").select(
        F.array("cluster", F.lit(-1).cast("long"), F.lit(-1).cast("long")).alias("unit"),
        F.lit(3).alias("role"), "doc_id", F.col("doc_id").alias("component"), "tokens")
    units = small_rows.unionByName(trie_rows).unionByName(probe_rows)
    packs = 32 + docs.where("blocks = 1").count() // BLOCK
    units = units.withColumn("small", F.col("role") == 3).withColumn("unit", F.xxhash64("unit"))
    units = units.withColumn("pack", F.when(F.col("small"), F.pmod(F.xxhash64("unit"), F.lit(packs))).otherwise(F.col("unit")))
    found = units.groupBy("small", "pack").applyInArrow(join_pack, "a long, b long")
    return found.unionByName(pivot)


def _join(named: DataFrame) -> DataFrame:
    """Per row of ``named`` (doc_id unique and not null, ``__text``): doc_id, n_shingles, component_id."""
    profile = stored(profiles(named), "profiles")
    key = ["n", "h1", "h2"]
    same = stored(profile.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"),
                                                           F.max("n_shared").alias("n_shared")), "classes")
    wanted = same.where(100 * F.col("n_shared") >= PERCENT * F.col("n")).select(F.col("rep").alias("doc_id"), *key)
    sets = stored(sets_of(named, wanted), "sets")
    label = stored(components(links(sets), "a", "b"), "components").withColumnRenamed("node", "rep")
    return (profile.join(same.select(*key, "rep"), key, "left").join(label, "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "rep", "doc_id").alias("component_id")))


def ngram_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, n_shingles, component_id."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))
    named = rows.where(F.col("doc_id").isNotNull())
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        out = _join(named)
    else:
        whole = numbered(df, "__number").select(
            F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"), "__number")
        whole = whole.where(F.col("__id").isNotNull())
        by_row = _join(whole.select(F.col("__number").alias("doc_id"), "__text"))
        told = stored(by_row.join(whole.select("__id", "__number"), F.col("doc_id") == F.col("__number"))
                      .select("__id", "n_shingles", F.col("component_id").alias("group")), "by-row")
        least = told.groupBy("group").agg(F.min("__id").alias("least"))
        joined = stored(components(told.join(least, "group").select("__id", "least").distinct(), "__id", "least"), "by-id")
        out = told.join(joined, told["__id"] == joined["node"], "left").select(
            F.col("__id").alias("doc_id"), "n_shingles", F.coalesce("component", "__id").alias("component_id"))
    nameless = rows.where(F.col("doc_id").isNull()).select(
        "doc_id", F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless)
