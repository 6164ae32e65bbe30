"""Merkle manifest against a plain tree over all rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from haulstat.llm import merkle
from tests.llm.helpers import clashing, docs, odd

SF01 = "/root/testdata/sf0.01"
LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                       for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def tree(nodes):
    """Root and each node's (left, right) siblings, from below to above."""
    paths, owns, now = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
    while len(now) > 1:
        above, below = [], []
        for i in range(0, len(now), 8):
            run = now[i:i + 8]
            for k in range(len(run)):
                for o in owns[i + k]:
                    paths[o].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(sha("".join(run)))
            below.append([o for part in owns[i:i + 8] for o in part])
        now, owns = above, below
    return now[0], paths


def plain(rows):
    groups, done, out = {}, [], []
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    for lang in sorted(groups, key=lambda v: (v is not None, (v or "").encode())):
        of = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        leaves = [leaf(r, r["text"]) for r in of]
        done.append((of, leaves, *tree(leaves)))
    root, ups = tree([s for _, _, s, _ in done])
    for (of, leaves, sub, paths), up in zip(done, ups):
        for r, mine, path in zip(of, leaves, paths):
            text, now = r["text"], None
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = text.translate(LOWER)
            now = leaf(r, text)
            for left, right in path + up:
                now = sha(left + now + right)
            out.append((r["doc_id"], mine, sub, root, sha("".join(a + b for a, b in path + up)), now, now == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def result(df):
    out = merkle.tampered_manifest(df)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=repr)


def test_table_equals_plain_tree(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    got = result(df)
    assert got == sorted(plain(df.collect()), key=repr)
    assert 0.5 < sum(r[-1] for r in got) / len(got) < 1


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 512, 513, 520, 4097])
def test_sizes_of_a_group(spark, n):
    """Group sizes about the powers of 8: one and two tiers, lone last nodes."""
    df = docs(spark, [(i, f"Text {i}", "en", "a") for i in range(n)] + [(n + 1, "Seul", "fr", "b")]).repartition(3)
    assert result(df) == sorted(plain(df.collect()), key=repr)


def test_many_groups(spark):
    """More groups than a block holds, with names that order by bytes only."""
    df = docs(spark, [(i, f"T{i}", None if i % 700 == 0 else ("é" if i % 2 else "z") + str(i % 700), "a") for i in range(1500)]
              + [(-1, "Empty name", "", None)])
    assert result(df) == sorted(plain(df.collect()), key=repr)


def test_odd_rows(spark):
    df = odd(spark)
    want = sorted(plain(df.collect()), key=repr)
    assert result(df) == want and result(clashing(df).withColumns({c: F.lit("?") for c in ("g", "row", "rank", "leaf", "path")})) == want
    assert result(df.limit(0)) == []


def test_plan_has_no_join_inside_a_block(spark):
    rows = docs(spark, [(i, f"Text {i}", "en", "a") for i in range(100)])
    nodes = rows.select(F.col("lang").alias("g"), F.col("doc_id").alias("rank"), F.lit(100).cast("long").alias("n"),
                        F.md5("text").alias("digest"))
    blocks = merkle.rollup(nodes)
    out = merkle.unroll(blocks.withColumn("path", F.array().cast(merkle.PATH)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join " not in plan and plan.count("Exchange ") == 1
    assert out.count() == 100
