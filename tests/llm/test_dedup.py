"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pistespark.llm import exact_dedup, simhash, suffix_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]")


def key(row):
    return tuple((x is None, str(x)) for x in row)


def exact(pairs):
    groups = defaultdict(list)
    for n, (i, t) in enumerate(pairs):
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i or 0, n))
    out = []
    for n, (i, t) in enumerate(pairs):
        g = groups[SPACE.sub("", t or "")]
        best = min(g)[3]
        out.append((i, pairs[best][0], len(g), n == best, hashlib.sha256(SPACE.sub("", t or "").encode()).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("bits", [64, 6])
def test_exact_groups(spark, edge, empty, pairs, bits):
    """With a hash of 6 bits nearly all chunks collide, and the identifiers must still tell them apart."""
    got = [tuple(r)[:5] for r in exact_dedup.exact_groups(edge, bits).collect()]
    assert sorted(got, key=key) == exact(pairs)
    assert exact_dedup.exact_groups(empty, bits).count() == 0


def test_exact_keepers(edge, empty, pairs):
    kept = exact_dedup.keepers(edge)
    texts = [SPACE.sub("", r["text"] or "") for r in kept.collect()]
    assert sorted(texts) == sorted({SPACE.sub("", t or "") for _, t in pairs})
    assert kept.columns == edge.columns and exact_dedup.keepers(empty).count() == 0


def test_exact_keepers_odd_rows(spark):
    """A row that shares id and length with another text's winner goes; repeated rows leave one; the columns' names may clash."""
    rows = [(1, "a b c", 5, {"k": "v"}), (1, "abc", 3, None), (1, "xyz", 3, None), (1, "xyz", 4, None), (None, "x yz", 3, None), (None, "abcde", 3, None), (None, "edcba", 4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _sha long, id map<string,string>").withColumn("points", F.lit(1)).withColumn("key", F.lit(2)).withColumn("_row", F.lit(3))
    kept = exact_dedup.keepers(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "abcde"), (0, "edcba"), (0, "x yz"), (1, "a b c")]
    copies = spark.createDataFrame([(5, "same text")] * 9, "doc_id long, text string")
    assert exact_dedup.keepers(copies).count() == 1 and exact_dedup.exact_groups(copies).filter("kept").count() == 1


def test_exact_sql_agrees_on_odd_rows(spark, edge, pairs):
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", pairs)
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = c.execute(f"SELECT {', '.join(cols)} FROM ({exact_dedup.SQL})").fetchall()
    assert sorted((tuple(r[k] for k in cols) for r in exact_dedup.exact_groups(edge).collect()), key=key) == sorted(want, key=key)


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, codes, near):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if near(codes[i], codes[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = defaultdict(list)
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)].append(d)
    return [min(low[find(i)], default=None) for i in range(len(ids))]


@pytest.mark.parametrize("most", [4096, 3])
def test_near_groups(spark, empty, pairs, most):
    """With groups of at most 3 rows, the search goes through all levels of the split."""
    rows = [*pairs, (8, (pairs[8][1] or "").upper()), *[(1000 + i, " ".join(["same line"] * 40 + [f"end{i}"])) for i in range(30)]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    codes = [fingerprint(t) for _, t in rows]
    want = sorted(((i, f"{c:016x}", m) for (i, _), c, m in zip(rows, codes, components([r[0] for r in rows], codes, lambda a, b: (a ^ b).bit_count() <= 3), strict=True)), key=key)
    got = sorted((tuple(r)[:3] for r in simhash.near_groups(df, most=most).collect()), key=key)
    assert got == want
    assert simhash.near_groups(empty).count() == 0


def test_linked_equals_all_pairs():
    rng = np.random.default_rng(1)
    for room in (64, 1 << 20):
        for _ in range(15):
            n = int(rng.integers(2, 300))
            base = rng.integers(0, 2**63, size=max(1, n // int(rng.integers(1, 40))), dtype=np.uint64)
            f = base[rng.integers(0, len(base), n)]
            for _ in range(int(rng.integers(0, 4))):
                f = f ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
            a, b, _ = simhash.linked(np.zeros(n, int), f, 3, room=room)
            d = np.bitwise_count(f[:, None] ^ f[None])
            assert (simhash.forest(n, a, b) == simhash.forest(n, *np.nonzero(d <= 3))).all()
            sketch = np.frombuffer(b"".join(simhash.codes(f"{x % 7} b c d e f g h {x % 3}", {})[2] for x in f.tolist()), np.uint64).reshape(n, -1)
            i, j = np.nonzero(d <= 6)
            alike = simhash.similarity(sketch[i], sketch[j])
            a, b, s = simhash.linked(np.zeros(n, int), f, 6, room=room, sketch=sketch)
            for least in (simhash.SURE, simhash.MAYBE):
                assert (simhash.forest(n, a[s >= least], b[s >= least]) == simhash.forest(n, i[alike >= least], j[alike >= least])).all()


def test_spanning_takes_the_greatest():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n, m = int(rng.integers(1, 40)), int(rng.integers(0, 150))
        a, b, s = rng.integers(0, n, m), rng.integers(0, n, m), rng.integers(0, 20, m) / 20
        kept = simhash.spanning(n, a, b, s)
        for least in np.unique(s):  # connects all that edges of any weight or more connect, without a ring
            assert (simhash.forest(n, a[kept][s[kept] >= least], b[kept][s[kept] >= least]) == simhash.forest(n, a[s >= least], b[s >= least])).all()
        assert len(kept) == n - len(np.unique(simhash.forest(n, a, b)))


def edited(rnd):
    """Documents of 60 to 400 words in groups of copies with more and more words changed, and the exact similarity of all pairs."""
    texts = []
    for _ in range(60):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(60, 400))]
        texts.append(base)
        for _ in range(6):
            share = rnd.choice([0.002, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05])
            texts.append([f"x{rnd.randrange(5000)}" if rnd.random() < share else w for w in base])
    sets = [{" ".join(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    pairs = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(sets)) for j in range(i) if sets[i] & sets[j]}
    return [" ".join(t) for t in texts], pairs


def test_near_recall(spark):
    """Against brute force over all pairs: at least 90 % of the links of each band from 0.8 on join, and no pair below."""
    texts, pairs = edited(random.Random(12))
    made = [simhash.codes(t, {}) for t in texts]
    sketch = np.frombuffer(b"".join(m[2] for m in made), np.uint64).reshape(len(made), -1)
    ij = np.array(list(pairs))
    true, est = np.array(list(pairs.values())), simhash.similarity(sketch[ij[:, 0]], sketch[ij[:, 1]])
    assert np.abs(est - true).max() < 0.1 and np.sqrt(((est - true) ** 2).mean()) < 0.025
    one, two = (np.array([m[c] for m in made], np.uint64) for c in (0, 1))
    near = (np.bitwise_count(one[ij[:, 0]] ^ one[ij[:, 1]]) <= simhash.WIDE_K) | (np.bitwise_count(two[ij[:, 0]] ^ two[ij[:, 1]]) <= simhash.WIDE_K)
    link = near & (true >= simhash.SIMILAR) & (est >= simhash.MAYBE)
    for low, high, least in ((0.8, 0.85, 0.9), (0.85, 0.9, 0.95), (0.9, 0.95, 0.98), (0.95, 1.01, 0.99)):
        band = (true >= low) & (true < high)
        assert band.sum() > 20 and link[band].mean() >= least
    assert (true[est >= simhash.SURE] >= simhash.SIMILAR).all()  # what is taken as sure is
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    root = simhash.forest(len(texts), ij[link, 0], ij[link, 1])
    for most in (4096, 40):
        assert sorted(r["doc_id"] for r in simhash.keepers(df, most=most).collect()) == sorted(set(root.tolist()))


def test_dense_groups_in_windows(spark):
    """A cluster far larger than ``most`` is searched in windows and still ends up as one."""
    rnd = random.Random(2)
    base = [f"w{rnd.randrange(900)}" for _ in range(200)]
    texts = []
    for i in range(900):
        t = list(base)
        t[rnd.randrange(200)] = f"y{i}"
        texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert simhash.keepers(df, most=50).count() <= 3


def test_near_keepers(spark, edge, empty):
    rnd = random.Random(5)
    text = [f"word{rnd.randrange(10**6)}" for _ in range(400)]
    copies = [" ".join([*text[:k], "changed", *text[k + 1 :]]) for k in range(0, 400, 40)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([" ".join(text), *copies, "quite another text"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert sorted(r["doc_id"] for r in simhash.keepers(df).collect()) == [0, len(rows) - 1]
    kept = simhash.keepers(edge)
    assert kept.columns == edge.columns and 25 <= kept.count() < edge.count()
    assert simhash.keepers(empty).count() == 0


def repeats(rows, n=100):
    first, out = {}, [None] * len(rows)
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0)):
        b = (rows[i][1] or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first.setdefault(b[p : p + n], (rows[i][0], p)) != (rows[i][0], p):
                cover[p : p + n] = b"\1" * n
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out[i] = (rows[i][0], len(b), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest())
    return sorted(out, key=key)


@pytest.mark.parametrize(("hot", "part"), [(50_000, 1 << 24), (50_000, 2000), (3, 2000), (0, 3000)])
def test_suffix_dedup(spark, hot, part):
    """In one part and in many, and with few, some and all anchors dealt the way of very frequent ones."""
    rnd = random.Random(4)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    rows = []
    for i in range(60):
        x = ""
        for _ in range(rnd.randint(0, 6)):
            k, a = rnd.random(), rnd.randint(0, 2700)
            x += base[a : a + rnd.randint(60, 300)] if k < 0.4 else rnd.choice(["ab", "a", "abc", "xxxxxxxy"]) * rnd.randint(10, 150) if k < 0.6 else "é☃" * rnd.randint(1, 80) if k < 0.7 else "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(1, 250)))
        rows.append((i, x))
    rows += [(60, None), (61, ""), (62, base), (63, base), (64, "q" * 99), (65, "q" * 100), (66, "q" * 101), (None, base[:500])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted((tuple(r) for r in suffix_dedup.deduplicated(df, hot, part).collect()), key=key) == repeats(rows)


@pytest.mark.parametrize("hot", [50_000, 0])
def test_suffix_dedup_repeated_ids(spark, hot):
    """Null ids come last; texts of one id go by a hash; fully repeated rows stand at one place, each with the same result."""
    rnd = random.Random(3)
    a, b, c = ("".join(rnd.choice("abcdefgh ") for _ in range(400)) for _ in range(3))
    rows = [(5, a), (5, a), (5, a), (None, a[50:300]), (None, None), (None, b), (9, b[:200] + c), (2, c[100:]), (5, c + a[:150])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tie = {t: h for t, h in df.select("text", F.xxhash64("text")).collect()}
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, tie[r[1]]))
    place = {r: n for n, r in enumerate(order)}
    want = {r[0]: r for r in repeats([(n, t) for n, (_, t) in enumerate(order)])}
    got = suffix_dedup.deduplicated(df, hot).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(((r[0], *want[place[r]][1:]) for r in rows), key=key)


def test_suffix_dedup_odd_rows(edge, empty, pairs):
    got = {r["doc_id"]: r for r in suffix_dedup.deduplicated(edge, part=1 << 16).collect() if r["doc_id"] not in (None, 7)}
    plain = [p for p in pairs if p[0] not in (None, 7)]
    want = {r[0]: r for r in repeats([*plain, (7, pairs[7][1])])}
    for i in (300, 301, 302, 304, 401, 403):
        assert tuple(got[i]) == want[i]
    assert suffix_dedup.deduplicated(empty).count() == 0


def test_merging_never_leaves_the_order():
    rnd = random.Random(9)
    for _ in range(30):
        runs = [sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 12))).encode() for _ in range(rnd.randint(0, 20))}) for _ in range(rnd.randint(1, 9))]
        shared = [[0, *(next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(r, r[1:], strict=False))][: len(r)] for r in runs]
        out = list(suffix_dedup.merged(list(zip(runs, shared, strict=True))))
        assert [k for k, *_ in out] == sorted(x for r in runs for x in r)
        last = b""
        for k, s, _, _ in out:
            assert s == next((i for i, (x, y) in enumerate(zip(last, k, strict=False)) if x != y), min(len(last), len(k)))
            last = k
