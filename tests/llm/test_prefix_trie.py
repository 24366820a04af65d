"""The trie against a plain walk, and subtree sums on deep, wide and random trees."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pistespark.llm import prefix_trie as op


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [v[2:] for v in sorted(each)] for c, each in own.items()}
    full = {c: own.get(c - c % 100, [])[: zlib.crc32(str(c).encode()) % 6] + each[zlib.crc32(str(c).encode()) % 6 :] for c, each in own.items()}
    members = {(): sorted(full)}
    for c in sorted(full):
        for d in range(1, len(full[c]) + 1):
            members.setdefault(tuple(full[c][:d]), []).append(c)
    kids, leaves, saved = ({s: 0 for s in members} for _ in range(3))
    for s in members:
        if s:
            kids[s[:-1]] += 1
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1]) if s else 0
    sha = lambda s: hashlib.sha256(",".join(str(c) for c in members[s] if len(full[c]) == len(s)).encode()).hexdigest()
    first = lambda s: members[s][0] if members[s] else None
    return sorted((first(s), len(s), first(s[:-1]) if s else None, len(members[s]), kids[s], leaves[s], saved[s], sha(s)) for s in members)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_trie(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 12)
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", None, "bot"]), rng.choice(["", "a", "é馬", None, "bb"])) for c in [*range(0, 60), 250, 305, 306] for t in range(rng.randrange(1, 8))]
    rows += [(40, None, "x", "first"), (40, None, "x", "first"), (41, 2, None, None), (None, 1, "user", "lost")]
    rows += [(500 + i, 0, "user", "same") for i in range(40)] + [(700, t, "u", f"turn {t}") for t in range(60)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, node int").repartition(6)
    assert got(op.trie(df)) == brute(rows)


def test_one_long_conversation_over_many_partitions(spark):
    rows = [(3, t, "u", f"turn {t % 5}") for t in range(90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(9)
    assert got(op.trie(df)) == brute(rows)


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in op.trie(df).collect()] == [(None, 0, None, 0, 0, 1, 0, hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("shape", ["comb", "random"])
def test_subtree_sums(spark, shape):
    rng = random.Random(shape)
    n = 120
    parent = {i: {"chain": i - 1, "comb": i - 1 - (i % 2 == 0), "random": rng.randrange(max(0, i - 9), i) if i else -1}[shape] for i in range(1, n)}
    depth, sums = {0: 0}, {i: [rng.randrange(9), rng.randrange(99)] for i in range(n)}
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    own = {i: list(v) for i, v in sums.items()}
    for i in range(n - 1, 0, -1):
        for k in (0, 1):
            sums[parent[i]][k] += sums[i][k]
    rows = [(depth[i], i, depth[parent[i]] if i else None, parent.get(i), *own[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "d int, a long, pd int, pa long, leaves long, saved long")
    zero = F.lit(0).cast("long").alias("b")
    tree = df.select(F.struct("d", "a", zero).alias("node"), F.when(F.col("pa").isNotNull(), F.struct(F.col("pd").alias("d"), F.col("pa").alias("a"), zero)).alias("parent"), "leaves", "saved")
    assert sorted((r["a"], r["leaves"], r["saved"]) for r in op.totals(tree).select("node.a", "leaves", "saved").collect()) == sorted((i, *sums[i]) for i in range(n))
