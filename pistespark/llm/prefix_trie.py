"""The trie of conversation beginnings, with subtree totals by parallel tree contraction.

A node of depth d is a distinct sequence of d turns that some conversation begins with. What a shared cache of beginnings
would save is a sum over each node's subtree, and so is the number of its childless nodes.

1. *Places.* All turns are sorted in one range-partitioned sort, and a turn's place in its conversation is its place in its
   partition plus what earlier partitions hold: one conversation may fill many partitions.
2. *Nodes.* A turn's mark is a 128-bit hash of its place, role and text; a beginning's key is its length and the exclusive or of its
   turns' marks, which is again a running value over partitions. A node checks that all its members agree in their last turn
   and in their beginning before it, which by induction proves that equal keys are equal sequences.
3. *Contraction.* Rake: childless nodes leave and add what they have to their parents. Compress: of nodes with one child those
   leave whose depth is divisible by a lower power of two than that of their neighbours in the chain (ties by a hash), so
   about half of a chain goes at once; the child is tied to the node above, which takes over what the removed one had. The two
   alternate until the root is alone, after about as many rounds as the logarithm of the trie's size.
4. *Expansion.* A raked node's total is known when it leaves. A compressed one's is its own plus that of the child that it
   had, and the child left later: the compressed sets are gone through backwards.
5. *Ends.* The ids of the conversations that end at a node are sorted and hashed as a stream; nodes that end many are cut into
   pieces of text before they meet, and only pieces are read in a row.

Every step is a join or a grouped sum with map-side combine; rounds end in a table. No group is ever collected: a third of
all conversations may share a turn or end at one node.

Defined results: rows without a conv_id belong to no conversation; turns go by turn (null first), then role, then text, and
repeated rows are turns of their own; a null role or text is empty; a conversation counts as existing if it has any row; the
root is there also for an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pistespark.shared import dropped, settled, spread_join

SHARED, HEADS = 100, 6
#: Bytes of joined ids in a piece.
PIECE = 1 << 20


def _root() -> Column:
    return F.struct(F.lit(0).alias("d"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def _placed(df: DataFrame, by: list[Column]) -> DataFrame:
    """df in order: ``pid`` and ``at`` number the rows, by partition and within it. A table, so that the numbers stay."""
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = settled(rows.withColumn("_at", F.monotonically_increasing_id()), "placed")
    return rows.withColumns({"pid": F.shiftright("_at", 33).cast("int"), "at": F.col("_at").bitwiseAND((1 << 33) - 1)}).drop("_at")


def _before(rows: DataFrame, value: str, how: str) -> DataFrame:
    """(conv, pid, base): what the partitions before ``pid`` hold of a conversation."""
    total = {"n": F.count("*"), "a": F.bit_xor("a"), "b": F.bit_xor("b")}
    parts = rows.groupBy("conv", "pid").agg(*[total[c].alias(c) for c in value])
    before = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    over = (lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))) if how == "sum" else (lambda c: F.coalesce(F.bit_xor(c).over(before), F.lit(0).cast("long")))
    return parts.select("conv", "pid", *[over(c).alias(f"base_{c}") for c in value])


def _own(conversations: DataFrame) -> DataFrame:
    """conv, place (from 0), pid, role, text."""
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _placed(rows, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")])
    first = rows.groupBy("conv", "pid").agg(F.min("at").alias("first"))
    rows = spread_join(spread_join(rows, first, ["conv", "pid"]), _before(rows, "n", "sum"), ["conv", "pid"])
    return rows.select("conv", "pid", "role", "text", (F.col("base_n") + F.col("at") - F.col("first")).alias("place"))


def rebuilt(conversations: DataFrame, shared: int = SHARED, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(turns: conv, pid, place, role, text; lengths: conv, n) of all conversations, each beginning with the first turns of another:
    ``crc32(conv) % heads`` turns of the conversation whose id is the next lower multiple of ``shared``."""
    own = settled(_own(conversations), "own")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("long")
    sizes = own.groupBy("conv").agg(F.count("*").alias("own"))
    head = own.filter(F.col("place") < heads).groupBy("conv").agg(F.count("*").alias("have")).withColumnRenamed("conv", "base")
    convs = sizes.withColumns({"base": F.col("conv") - F.col("conv") % shared, "h": h}).join(head, "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("have", F.lit(0)))).drop("have")
    convs = settled(convs.withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "convs")
    # a base's turns are at most ``heads``, and at most ``shared`` conversations take them
    lent = own.filter(F.col("place") < heads).select(F.col("conv").alias("base"), "place", "role", "text").join(convs.select("conv", "base", "taken"), "base").filter("place < taken")
    rest = spread_join(own, convs.select("conv", "h", "taken"), ["conv"]).filter("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("taken"))
    turns = rest.select("conv", "pid", "place", "role", "text").unionByName(lent.select("conv", F.lit(-1).alias("pid"), "place", "role", "text"))
    return turns, convs.select("conv", "n")


def _members(turns: DataFrame) -> DataFrame:
    """conv, node, parent, chars, mark: one row for each conversation and beginning of one turn or more."""
    mark = lambda k: F.xxhash64(F.lit(k), "place", "role", "text")
    rows = settled(turns.select("conv", "pid", "place", F.char_length("text").cast("long").alias("chars"), mark(1).alias("a"), mark(2).alias("b"), F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("turn")), "marks")
    up_to = Window.partitionBy("conv", "pid").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"up_a": F.bit_xor("a").over(up_to), "up_b": F.bit_xor("b").over(up_to)})
    rows = spread_join(rows, _before(rows, "ab", "xor"), ["conv", "pid"])
    a, b = (F.col(f"up_{c}").bitwiseXOR(F.col(f"base_{c}")) for c in "ab")
    node = F.struct((F.col("place") + 1).cast("int").alias("d"), a.alias("a"), b.alias("b"))
    parent = F.struct(F.col("place").cast("int").alias("d"), a.bitwiseXOR(F.col("a")).alias("a"), b.bitwiseXOR(F.col("b")).alias("b"))
    return rows.select("conv", node.alias("node"), parent.alias("parent"), "chars", "turn")


def _nodes(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """node, parent (null for the root), conv_id, n_convs, own: what sharing the node's last turn saves."""
    last = F.struct("parent", "turn")
    made = members.groupBy("node").agg(F.min("parent").alias("parent"), F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), (F.min(last) == F.max(last)).alias("same"))
    made = made.withColumn("own", F.when(F.col("same"), (F.col("n_convs") - 1) * F.col("chars")).otherwise(F.raise_error(F.lit("two sequences share a key"))))
    root = lengths.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).select(_root().alias("node"), F.lit(None).cast("struct<d:int,a:bigint,b:bigint>").alias("parent"), "conv_id", "n_convs", F.lit(0).cast("long").alias("own"))
    return made.select("node", "parent", "conv_id", "n_convs", "own").unionByName(root)


def _rank(node: Column) -> Column:
    """In a chain the lower leave first: by the power of two that divides the depth, so that half of a chain goes at once."""
    return F.struct(F.bit_count(node["d"].bitwiseXOR(node["d"] - 1)).alias("power"), F.xxhash64(node).alias("hash"))


def _rake(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes without a child, the others with what these had)."""
    kids = live.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"))
    each = settled(live.join(kids, "node", "left"), "raked")
    bare = each.filter("kids IS NULL AND parent IS NOT NULL").drop("kids")
    given = bare.groupBy(F.col("parent").alias("node")).agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    rest = each.filter("kids IS NOT NULL OR parent IS NULL").drop("kids").join(given, "node", "left")
    plus = lambda c: F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))
    return bare, rest.select("node", "parent", plus("leaves").alias("leaves"), plus("saved").alias("saved"))


def _compress(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes of chains that leave, with their one child; the others, tied together anew)."""
    kids = live.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"), F.min("node").alias("kid")).filter("kids = 1").drop("kids")
    chain = settled(live.filter("parent IS NOT NULL").join(kids, "node"), "chain")
    among = chain.select(F.col("node").alias("other"))
    own = _rank(F.col("node"))
    lower = lambda side: F.col(f"{side}_in").isNull() | (own < _rank(F.col(side)))
    asked = chain.join(among.select(F.col("other").alias("parent"), F.lit(True).alias("parent_in")), "parent", "left").join(among.select(F.col("other").alias("kid"), F.lit(True).alias("kid_in")), "kid", "left")
    gone = settled(asked.filter(lower("parent") & lower("kid")).select("node", "parent", "kid", "leaves", "saved"), "gone")
    given = gone.groupBy(F.col("parent").alias("node")).agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    above = gone.select(F.col("kid").alias("node"), F.col("parent").alias("_parent"))
    rest = live.join(gone.select("node"), "node", "left_anti").join(given, "node", "left").join(above, "node", "left")
    plus = lambda c: F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))
    return gone, rest.select("node", F.coalesce("_parent", "parent").alias("parent"), plus("leaves").alias("leaves"), plus("saved").alias("saved"))


def totals(tree: DataFrame) -> DataFrame:
    """Subtree sums of ``leaves`` and ``saved`` over a tree of (node, parent, leaves, saved), whose root has no parent. node is a
    struct whose field ``d`` grows from parent to child."""
    live = settled(tree.select("node", "parent", "leaves", "saved"), "live")
    done, passed = [], []
    while not live.filter("parent IS NOT NULL").isEmpty():
        bare, rest = _rake(live)
        done.append(bare)
        after = settled(rest, "live")
        dropped(live)
        gone, rest = _compress(after)
        if gone.isEmpty():
            live = after
            continue
        live = settled(rest, "live")
        passed.append(gone)
        dropped(after)
    known = live.select("node", "leaves", "saved")
    for d in done:
        known = known.unionByName(d.select("node", "leaves", "saved"))
    if not passed:
        return known
    # backwards: only totals that some compressed node asks for are kept at hand
    asked = passed[0].select("kid")
    for p in passed[1:]:
        asked = asked.unionByName(p.select("kid"))
    at_hand = settled(known.join(asked.select(F.col("kid").alias("node")), "node", "left_semi"), "hand")
    for p in reversed(passed):
        kid = at_hand.select(F.col("node").alias("kid"), F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved"))
        found = settled(p.join(kid, "kid").select("node", (F.col("leaves") + F.col("_leaves")).alias("leaves"), (F.col("saved") + F.col("_saved")).alias("saved")), "expanded")
        known, at_hand = known.unionByName(found), at_hand.unionByName(found)
    return known


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv) to (node, first conv, ids joined by commas), a row for each PIECE bytes of a node at most."""
    node, first, held, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int32()), pa.array([node[1]], pa.int64()), pa.array([node[2]], pa.int64()), pa.array([first], pa.int64()), pa.array([",".join(held)])], names=["d", "a", "b", "first", "ids"])

    for batch in batches:
        for d, a, b, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (d, a, b) != node or size >= PIECE:
                if held:
                    yield piece()
                node, first, held, size = (d, a, b), conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one row (node, ends_sha256) for each node, read as a stream."""
    node, digest, out = None, None, []
    kinds = {"d": pa.int32(), "a": pa.int64(), "b": pa.int64(), "ends_sha256": pa.string()}

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds.values(), strict=True)], names=list(kinds))

    for batch in batches:
        for d, a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (d, a, b) == node:
                digest.update(b"," + ids.encode())
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (d, a, b), hashlib.sha256(ids.encode())
            if len(out) >= 1 << 14:
                yield flushed()
                out = []
    if node:
        out.append((*node, digest.hexdigest()))
        yield flushed()


def _ends(members: DataFrame, lengths: DataFrame) -> DataFrame:
    """node, ends_sha256 of nodes at which conversations end."""
    last = spread_join(members.select("conv", "node"), lengths, ["conv"]).filter("node.d = n").select("node.*", "conv")
    last = last.unionByName(lengths.filter("n = 0").select(_root().alias("node"), "conv").select("node.*", "conv"))
    order = ["d", "a", "b", "conv"]
    rows = last.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = settled(rows.mapInArrow(_pieces, "d int, a long, b long, first long, ids string"), "pieces")
    by = ["d", "a", "b", "first"]
    made = pieces.repartition("d", "a", "b").sortWithinPartitions(*by).mapInArrow(_digests, "d int, a long, b long, ends_sha256 string")
    return made.select(F.struct("d", "a", "b").alias("node"), "ends_sha256")


def trie(conversations: DataFrame, shared: int = SHARED, heads: int = HEADS) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, lengths = rebuilt(conversations, shared, heads)
    members = settled(_members(turns), "members")
    nodes = settled(_nodes(members, lengths), "nodes")
    kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = settled(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    sums = totals(nodes.select("node", "parent", leaf.alias("leaves"), F.col("own").alias("saved")))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = spread_join(nodes, above, ["parent"], "left").join(sums, "node").join(_ends(members, lengths), "node", "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", F.col("node.d").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


_CRC = "list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(c AS VARCHAR), '')]), lambda s, x: {eight})"
_STEP = "xor({0} >> 1, 3988292384 * ({0} & 1))"


def _crc() -> str:
    """CRC-32 of the digits of c: eight steps for each byte, one fold for each step."""
    steps = "list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda t, z: " + _STEP.format("t") + ")"
    return "xor(" + _CRC.replace("{eight}", steps) + ", 4294967295)"


SQL = f"""
WITH o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list(t ORDER BY i) AS t FROM o GROUP BY c),
h AS (SELECT c, t, {_crc()} % {HEADS} AS h FROM l),
r AS (SELECT h.c, list_concat(coalesce(b.t, [])[1:h], h.t[h + 1:]) AS t FROM h LEFT JOIN l b ON b.c = h.c - h.c % {SHARED}),
m AS (SELECT c, t[1:d] AS s, d, d = len(t) AS ends FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM r)),
n AS (SELECT s, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * length(coalesce(any_value(s[d]).text, '')) AS own, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY s, d),
k AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.s[1:n.d] = n.s) AS n_children FROM n),
u AS (SELECT s, d, own, n_children, unnest(range(0, d + 1)) AS up FROM k),
v AS (SELECT s[1:up] AS s, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(own) AS saved_tokens FROM u GROUP BY ALL)
SELECT k.conv_id, CAST(k.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN v USING (s) LEFT JOIN n p ON k.d > 0 AND p.d = k.d - 1 AND p.s = k.s[1:k.d - 1]
"""
