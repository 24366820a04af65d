"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints: for each text the XXH64 of its word shingles votes on 64 bits. Two fingerprints link if they
differ in at most ``K`` bits. The search is exact.

*Dealing out.* The 64 bits are cut into K + 1 blocks; two linked fingerprints agree on one block at least.
Distinct fingerprints (copies are one) are dealt by (mask, masked bits), once per block. A group of more than
``MOST`` is dealt again by the K + 1 blocks of its remaining bits, where the same argument holds, so no group
grows with the corpus: each level fixes a quarter of the bits that are left.

*In a group*, fingerprints are sorted by Gray rank, so neighbours share many bits. Runs of ``FAN`` form a
node that holds the bits all its members share (a mask and a pattern); runs of nodes form the next level.
The index is joined with itself from the top: the differences on the shared bits of two nodes add up on the
way down, and once above K the pair of nodes goes with everything below it. Where the bits that are not
shared are K at most, all below is linked at once. Only a spanning forest of a group's links leaves the task.

Defined results: null text is the empty text; empty texts have fingerprint zero and link like any other;
a null doc_id keeps its row and never is a component's id unless nothing else is there; repeated rows get
a row each; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.llm.common import fresh, one_each, written
from pistespark.operators.components import connected_components
from pistespark.shared import spread_join

K, WORDS, SEED, FAN, MOST, BLOCK = 3, 3, 42, 8, 4096, 1 << 16
#: For copies by similarity: least similarity, words of a shingle, bins of the sketch, bits of the codes, levels of the split.
SIMILAR, WORDS2, BINS, WIDE_K, LEVELS = 0.8, 5, 1024, 6, 3
#: Estimates at which the shingle sets themselves are compared, and from which on a link is sure: over three standard errors about SIMILAR.
MAYBE, SURE = 0.74, 0.87
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority of the shingles' hashes, bit by bit, as an unsigned integer."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    n = len(parts) - words + 1
    if not parts:
        return 0
    whole = b" ".join(parts)
    hashed = xxhash.xxh64_intdigest
    if n <= 1:
        return hashed(whole, SEED)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[:n].tolist(), end[words - 1 :].tolist()
    votes = np.zeros((8, 8), np.int64)
    for at in range(0, n, BLOCK):
        h = np.array([hashed(whole[a:b], SEED) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK], strict=True)], "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.stack([np.bincount(h[:, i], minlength=256) for i in range(8)]) @ _BITS
    return int(np.packbits((votes * 2 > n).reshape(64), bitorder="little").view("<u8")[0])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _majority(h: np.ndarray) -> int:
    each = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    votes = np.stack([np.bincount(each[:, i], minlength=256) for i in range(8)]) @ _BITS
    return int(np.packbits((votes * 2 > len(h)).reshape(64), bitorder="little").view("<u8")[0])


def shingles(text: str | None, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, in order, and of the set of five-word shingles, ascending. known: hashes of words met before."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(known) > 500_000:
        known.clear()
    of = np.fromiter((known[w] if w in known else known.setdefault(w, xxhash.xxh64_intdigest(w, SEED)) for w in parts), np.uint64, len(parts))
    n = max(1, len(of) - WORDS2 + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(WORDS2, len(of))):
        h = h * _STEP + of[i : i + n]
    return of, np.unique(_mixed(h))


def codes(text: str | None, known: dict[bytes, int]) -> tuple[int, int, bytes]:
    """Two SimHash codes of the set of words, and a sketch of the set of five-word shingles. known: hashes of words met before.

    The sketch has two bits for each of BINS equal ranges of hash values: whether a shingle falls there, and one
    bit of the least that does. How often two sketches agree estimates the sets' similarity (see ``similarity``)."""
    of, h = shingles(text, known)
    if not len(of):
        return 0, 0, bytes(BINS // 4)
    bins = (h >> np.uint64(54)).astype(np.int64)
    first = np.concatenate([[True], bins[1:] != bins[:-1]])
    bits = np.zeros((2, BINS), bool)
    bits[0, bins[first]] = True
    bits[1, bins[first]] = h[first] & np.uint64(1)
    kinds = np.unique(of)
    return _majority(_mixed(kinds + np.uint64(1))), _majority(_mixed(kinds + _STEP)), np.packbits(bits).tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of shingle sets, by rows of two arrays of sketches (uint64).

    Of the bins that both fill, those with different least shingles agree by chance half of the time, so twice the
    agreeing ones less all of them is the number of equal ones. The standard error is 0.02 at most."""
    half = a.shape[1] // 2
    count = lambda x: np.bitwise_count(x).sum(1, dtype=np.int64)
    both = a[:, :half] & b[:, :half]
    agree, all_, some = count(both & ~(a[:, half:] ^ b[:, half:])), count(both), count(a[:, :half] | b[:, :half])
    return np.where(some > 0, (2 * agree - all_) / np.maximum(some, 1), 1.0)


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp (the unsigned fingerprint's bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.fromiter((fingerprint(x.as_py(), words) for x in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each item's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def spanning(n: int, a: np.ndarray, b: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The edges, by place, of a spanning forest of the greatest weights: each round every tree takes its best edge."""
    tree, live, kept = np.arange(n), np.lexsort((b, a, -s)), [np.zeros(0, np.int64)]
    while True:
        x, y = tree[a[live]], tree[b[live]]
        out = x != y
        live, x, y = live[out], x[out], y[out]
        if not len(live):
            return np.concatenate(kept)
        best = np.full(n, len(live))
        np.minimum.at(best, x, np.arange(len(live)))
        np.minimum.at(best, y, np.arange(len(live)))
        pick = np.unique(best[best < len(live)])
        kept.append(live[pick])
        tree = forest(n, x[pick], y[pick])[tree]


Links = tuple[np.ndarray, np.ndarray, np.ndarray]


def linked(group: np.ndarray, fp: np.ndarray, k: int = K, fan: int = FAN, room: int = 1 << 20, sketch: np.ndarray | None = None, known: np.ndarray | None = None) -> Links:
    """A spanning forest of the links inside each group, as pairs of places in ``fp`` (uint64), with a similarity.

    With sketches, a link also needs an estimate of SURE (the similarity given is 1 then). Pairs with one from MAYBE to SURE
    come along as they are, where they would join what sure links do not: a spanning forest of the greatest estimates.

    known: what each item is known to be joined to. Then all pairs from MAYBE to SURE between different ones, and nothing else."""
    a, b, s = (np.concatenate(x) for x in zip(*linked_pieces(group, fp, k, fan, room, sketch, known), strict=True))
    return a, b, s


def linked_pieces(group: np.ndarray, fp: np.ndarray, k: int, fan: int, room: int, sketch: np.ndarray | None, known: np.ndarray | None) -> Iterator[Links]:
    """What ``linked`` gives, in pieces: with ``known`` of some ``room`` pairs each, however many there are, else in one."""
    order = np.lexsort((gray_rank(fp), group))
    group, fp = group[order], fp[order]
    sketch = None if sketch is None else sketch[order]
    known = None if known is None else known[order]
    # levels from the leaves up: bits that all members have, bits that any has, first leaf, leaves, first child, children
    one = np.ones(len(fp), np.int64)
    levels = [(fp, fp, np.arange(len(fp)), one, np.arange(len(fp)), one)]
    kind = group
    while True:
        every, some, leaf, leaves, _, _ = levels[-1]
        new = np.concatenate([[True], kind[1:] != kind[:-1]])
        start = np.flatnonzero(new)
        if len(start) == len(kind):
            break
        place = np.arange(len(kind)) - np.repeat(start, np.diff(np.append(start, len(kind))))
        at = np.flatnonzero(place % fan == 0)
        levels.append((np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at), leaf[at], np.add.reduceat(leaves, at), at, np.diff(np.append(at, len(kind)))))
        kind = kind[at]
    found: list[np.ndarray] = []
    count, root = 0, np.arange(len(fp))
    maybe = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    pairs = [*maybe]

    def add(a: np.ndarray, b: np.ndarray, s: np.ndarray | None = None) -> None:
        nonlocal count
        if len(a) and s is None:
            found.append(np.stack([a, b]))
        elif len(a):
            maybe.append((a, b, s))
        count += len(a)
        if count > 4 * room:
            merge()

    def merge() -> None:
        nonlocal found, count, root, maybe
        ids = np.arange(len(fp))
        e = np.concatenate([*found, np.stack([ids, root])], axis=1)
        root, found, count = forest(len(fp), e[0], e[1]), [], 0
        x, y, s = (np.concatenate(c) for c in zip(*maybe, strict=True))
        best = spanning(len(fp), root[x], root[y], s)
        maybe = [(x[best], y[best], s[best])]

    def given() -> Links:
        nonlocal count
        x, y, s = (np.concatenate(c) for c in zip(*pairs, strict=True))
        pairs[1:], count = [], 0
        return order[x], order[y], s

    top = np.arange(len(kind))
    work = [(len(levels) - 1, top, top)]
    while work:
        level, a, b = work.pop()
        every, some, leaf, leaves, child, children = levels[level]
        shared = ~(every[a] ^ some[a]) & ~(every[b] ^ some[b])
        near = np.bitwise_count((every[a] ^ every[b]) & shared) <= k
        a, b = a[near], b[near]
        if level == 0:
            use = a != b
            if known is not None:
                use &= known[a] != known[b]
            a, b = a[use], b[use]
            if sketch is None:
                add(a, b)
                continue
            for at in range(0, len(a), 1 << 14):
                x, y = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
                s = similarity(sketch[x], sketch[y])
                some = (s >= MAYBE) & (s < SURE)
                if known is None:
                    add(x[s >= SURE], y[s >= SURE])
                    add(x[some], y[some], s[some])
                    continue
                pairs.append((x[some], y[some], s[some]))
                count += int(some.sum())
                if count > room:
                    yield given()
            continue
        close = np.bitwise_count((every[a] & every[b]) ^ (some[a] | some[b])) <= (k if sketch is None else -1)
        # all below is linked: members of one node to its first leaf, two nodes by their first leaves
        same = close & (a == b)
        if same.any():
            x = a[same]
            first = np.repeat(leaf[x], leaves[x])
            add(first, first + np.arange(len(first)) - np.repeat(np.cumsum(leaves[x]) - leaves[x], leaves[x]))
        two = close & (a != b)
        add(leaf[a[two]], leaf[b[two]])
        a, b = a[~close], b[~close]
        met = children[a] * children[b]
        for cut in np.split(np.arange(len(a)), np.flatnonzero(np.diff(np.cumsum(met) // room)) + 1):
            p, q, m = a[cut], b[cut], met[cut]
            if not len(cut):
                continue
            inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            wide = np.repeat(children[q], m)
            x, y = np.repeat(child[p], m) + inner // wide, np.repeat(child[q], m) + inner % wide
            once = (x <= y) | np.repeat(p != q, m)
            work.append((level - 1, x[once], y[once]))
    if known is not None:
        yield given()
        return
    merge()
    tied = np.flatnonzero(root != np.arange(len(fp)))
    a, b, s = maybe[0]
    yield order[np.append(tied, a)], order[np.append(root[tied], b)], np.append(np.ones(len(tied)), s)


def cut(mask: int, parts: int = K + 1) -> list[int]:
    """The masks that fix one more of ``parts`` blocks of the bits that ``mask`` leaves free."""
    free = [i for i in range(64) if not mask >> i & 1]
    edges = [round(len(free) * i / parts) for i in range(parts + 1)]
    return [mask | sum(1 << i for i in free[x:y]) for x, y in zip(edges, edges[1:], strict=False) if y > x]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _dealt(rows: DataFrame, masks: list[int], k: int) -> DataFrame:
    """Rows (mask, node, fp, ...) dealt by the finer masks of their mask, with the bits that the mask leaves."""
    finer = None
    for m in masks:
        some = F.array(*[F.lit(_signed(x)).cast("long") for x in cut(m, k + 1)])
        finer = F.when(F.col("mask") == _signed(m), some) if finer is None else finer.when(F.col("mask") == _signed(m), some)
    rest = [c for c in rows.columns if c != "mask"]
    return rows.select(*rest, F.explode(finer).alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), *rest)


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows (mask, bits, node, ...) of groups of any size as groups of some 2 * ``most``, in which every pair of a group meets.

    A group is cut into blocks of some ``most`` rows by a hash of the node, and each two blocks are a group, whose key is in
    ``bits``. No task holds more than two blocks; a row is repeated as often as its group has blocks."""
    sizes = written(rows.groupBy("mask", "bits").agg(F.ceil(F.count("*") / most).alias("_n")).filter("_n > 2"), "sizes")
    met = spread_join(rows, sizes, ["mask", "bits"], "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    met = met.withColumn("_own", F.pmod(F.xxhash64("node"), "_n")).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    key = F.when(F.col("_n") == 1, F.col("bits")).otherwise(F.xxhash64("mask", "bits", F.least("_own", "_other"), F.greatest("_own", "_other")))
    return met.select("mask", key.alias("bits"), *[c for c in rows.columns if c not in ("mask", "bits")])


def _searched(rows: DataFrame, k: int, most: int, whole: bool) -> DataFrame:
    """Edges (a, b, similarity), as ``linked`` gives them, of the groups of 2 to ``most`` rows; larger ones are left to the next level.

    whole: there is none, and groups of any size are searched. Without sketches few bits are left then, so there are few
    fingerprints; with sketches ``_blocks`` has dealt large groups to small ones."""
    wide, known = "sketch" in rows.columns, "root" in rows.columns

    def linked_rows(part: list[np.ndarray], group: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a, b, s in linked_pieces(group, part[3].view(np.uint64), k, FAN, 1 << 20, part[4] if wide else None, part[5] if known else None):
            yield pa.RecordBatch.from_arrays([pa.array(part[2][a]), pa.array(part[2][b]), pa.array(s)], names=["a", "b", "similarity"])

    def out(part: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.concatenate([[True], (part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1])]))
        size = np.diff(np.append(start, len(part[0])))
        limit = most if not whole else len(part[0])
        use = np.repeat((size > 1) & (size <= limit), size)
        if use.any():
            yield from linked_rows([x[use] for x in part], np.repeat(np.arange(len(start)), size)[use])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if wide:
                part.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint64).reshape(batch.num_rows, -1))
            if known:
                part.append(batch.column(5).to_numpy(zero_copy_only=False))
            part = [np.concatenate(x) for x in zip(held, part, strict=True)] if held else part
            last = int(np.flatnonzero((part[0] != part[0][-1]) | (part[1] != part[1][-1])).max(initial=-1)) + 1
            if last:
                yield from out([x[:last] for x in part])
            held = [x[last:] for x in part]
            if not whole:  # of an open group that is too large already, most + 1 rows are enough to know it by
                held = [x[: most + 1] for x in held]
        if held:
            yield from out(held)

    dealt = rows.repartition("mask", "bits").sortWithinPartitions("mask", "bits")
    return dealt.mapInArrow(run, "a long, b long, similarity double")


def links(nodes: DataFrame, k: int = K, most: int = MOST, levels: int = 64) -> DataFrame:
    """Edges (a, b, similarity) between nodes that connect what chains of links connect. nodes: (node, fp), a row per node, and sketch, if links need it.
    With a column root, too, all candidates between nodes of different roots instead, some of them several times.

    That is exact. With sketches, edges below SURE are candidates yet (see ``linked``), and a group that is still larger than ``most`` after ``levels`` levels
    (a dense cluster of copies) is searched block by block (``_blocks``), all pairs of it."""
    masks, edges, level = [0], None, 0
    rows = nodes.select(F.lit(0).cast("long").alias("mask"), *[c for c in ("node", "fp", "sketch", "root") if c in nodes.columns])
    while True:
        dealt, level = _dealt(rows, masks, k), level + 1
        masks = sorted({x for m in masks for x in cut(m, k + 1)})
        hot = written(dealt.groupBy("mask", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > most).drop("n"), "hot")
        # where few bits are left, a group has few fingerprints whatever the corpus
        if hot.isEmpty() or level == levels or (1 << 64 - min(m.bit_count() for m in masks)) <= 8 * most:
            found = _searched(_blocks(dealt, most) if "sketch" in dealt.columns else dealt, k, most, True)
            return found if edges is None else edges.unionByName(found)
        found = _searched(dealt.join(hot, ["mask", "bits"], "left_anti"), k, most, False)
        edges = found if edges is None else edges.unionByName(found)
        rows = written(dealt.join(hot, ["mask", "bits"], "left_semi").drop("bits"), "split")


def near_groups(docs: DataFrame, words: int = WORDS, k: int = K, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, fp."""
    fps = written(fingerprints(docs, words), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    nodes = distinct.select(F.col("fp").alias("node"), "fp")
    member = connected_components(links(nodes, k, most)).withColumnRenamed("node", "fp")
    member = written(distinct.join(member, "fp"), "member")
    lowest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    member = spread_join(member.select("fp", "root"), lowest, ["root"]).select("fp", "component_id")
    label = distinct.join(member, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return spread_join(fps, label, ["fp"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp")


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets of five-word shingles have a similarity of SIMILAR or more, by the sets themselves.

    Only texts that are in a pair are taken apart; nodes stand for the document in ``first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            held: list[np.ndarray] = []
            for i, text in enumerate(batch.column(1)):
                held.append(shingles(text.as_py(), known)[1].view(np.int64))
                if len(held) == 64 or i == batch.num_rows - 1 or sum(map(len, held)) > 1 << 20:
                    end = np.cumsum([0, *map(len, held)]).astype(np.int32)
                    sets = pa.ListArray.from_arrays(pa.array(end), pa.array(np.concatenate(held)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i + 1 - len(held), len(held)), sets], names=["node", "set"])
                    held = []

    used = nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    used = used.select("node", F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    here = (texts["id"].eqNullSafe(used["id"])) & (texts["text_hash"] == used["text_hash"])
    sets = texts.join(used, here).select("node", "text").mapInArrow(run, "node long, set array<long>")
    sets = written(sets.groupBy("node").agg(F.any_value("set").alias("set")), "sets")  # repeated rows have one set
    for c in ("a", "b"):
        pairs = spread_join(pairs, sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")), [c])
    both = F.size(F.array_intersect("set_a", "set_b"))
    return written(pairs.filter(both / (F.size("set_a") + F.size("set_b") - both) >= SIMILAR).select("a", "b"), "same")


def _rest(nodes: DataFrame, joined: DataFrame, member: DataFrame, failed: DataFrame, k: int, most: int) -> DataFrame | None:
    """The candidates (a, b) that the forest left out and that may still join something; none: None.

    A candidate that is not in its group's forest has its ends joined by sure links and pairs of the forest. So, if links do
    not join them (``joined``, whose components ``member`` has), a pair that is no link (``failed``) stands between, and all is in one component
    of both kinds together. Only nodes of such components are searched again."""
    root = {c: member.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")}
    for c in ("a", "b"):
        failed = spread_join(failed, root[c], [c], "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    failed = written(failed.filter("root_a <> root_b").select("a", "b"), "failed")
    if failed.isEmpty():
        return None
    near = connected_components(joined.unionByName(failed)).withColumnRenamed("root", "area")
    hit = near.join(failed.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select("area").distinct()
    left = near.join(hit, "area", "left_semi").select("node").join(member, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    left = written(nodes.join(left, "node"), "left")
    found = [links(left.select("node", F.col(c).alias("fp"), "sketch", "root"), k, most, LEVELS) for c in ("one", "two")]
    found = found[0].unionByName(found[1]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return written(found.join(failed, ["a", "b"], "left_anti"), "rest")


def keepers(docs: DataFrame, k: int = WIDE_K, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: the smallest doc_id of each group of near copies.

    Copies are texts whose sets of five-word shingles have a similarity of SIMILAR or more, and what chains of such
    links connect. The Gray-order index finds candidates: one of two codes of the words' set within ``k`` bits, which
    scattered edits at that similarity change by some 4 bits of 64; it compares the sketches where a pair comes that
    far. Where their estimate is too near to SIMILAR to decide and no sure link joins the two, the shingle sets
    themselves do (``confirmed``): first for a spanning forest of such pairs, then for every other pair between what the pairs
    of the forest that are no links would have joined (``_rest``). Texts without words are copies of each other; a null doc_id comes after all others; of rows that repeat id
    and text one stays; the columns' names may be any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            made = [codes(x.as_py(), known) for x in batch.column(2)]
            pair = [pa.array(np.fromiter((m[i] for m in made), np.uint64, len(made)).view(np.int64)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *pair, pa.array([m[2] for m in made], pa.binary())], names=["id", "text_hash", "one", "two", "sketch"])

    keys = [F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash")]
    rows = written(docs.select(*keys, "text").mapInArrow(run, "id long, text_hash long, one long, two long, sketch binary"), "codes")
    # nulls last; a row per triple of codes is enough, and it stands for the first of its documents
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash"))
    nodes = written(rows.groupBy("one", "two", "sketch").agg(first.alias("first")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = [links(nodes.select("node", F.col(c).alias("fp"), "sketch"), k, most, LEVELS) for c in ("one", "two")]
    found = written(found[0].unionByName(found[1]), "found")
    sure = connected_components(found.filter(F.col("similarity") >= SURE))
    open_ = found.filter(F.col("similarity") < SURE).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for c in ("a", "b"):
        root = sure.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
        open_ = spread_join(open_, root, [c], "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
    open_ = written(open_.filter("root_a <> root_b").select("a", "b"), "open")
    same = confirmed(docs, nodes, open_)
    joined = written(sure.toDF("a", "b").unionByName(same), "joined")
    member = connected_components(joined)
    rest = _rest(nodes, joined, member, open_.join(same, ["a", "b"], "left_anti"), k, most)
    more = None if rest is None else confirmed(docs, nodes, rest)
    if more is not None and not more.isEmpty():
        member = connected_components(joined.unionByName(more))
    stay = nodes.select("node", "first").join(member, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    id_, hash_ = fresh(docs.columns, "id", "hash")
    stay = written(stay.select(F.col("first.id").alias(id_), F.col("first.text_hash").alias(hash_)), "stay")
    kept = docs.join(stay, docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(hash_)), "left_semi")
    if rows.groupBy("id", "text_hash").count().filter("count > 1").isEmpty():
        return kept
    key = fresh(docs.columns, "key")[0]
    return one_each(kept.withColumn(key, F.xxhash64(docs["text"])), ["doc_id", key]).select(*[F.col(f"`{c}`") for c in docs.columns])
