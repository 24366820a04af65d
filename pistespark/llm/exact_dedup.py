"""Exact deduplication by content-defined chunk recipes.

A text, without its ASCII white space, is cut where its own content says so (after a sentence mark, within
length limits), so equal stretches give equal chunks wherever they stand. Three steps:

1. *Recipe*: each document becomes the ordered list of its chunks' 64-bit hashes. The text stays where it is.
2. *Verified identifiers*: all distinct (hash, chunk) pairs are brought together, each task sending a chunk
   once however often it holds it. A hash that stands for one chunk is an identifier proven by comparing
   bytes; where chunks collide, the hash is told apart by the chunk's rank among those that share it.
3. Documents whose ordered identifier lists are equal are equal texts. Only lists move, some 8 bytes for
   each 300 characters, and a group's winner is found with map-side aggregation.

The largest group may hold a third of all rows: its rows meet only in the join that hands out the winner,
where the other side is one row and both sides have their own exchange, so AQE splits it.

Defined results: null text is the empty text (all of these are one group); a null doc_id sorts after all
others; one row of each group is kept: the longest, then the smallest doc_id, and of rows that agree in both
the one whose text has the least hash, and one of those that repeat doc_id and text. Texts without any mark are
cut at certain letters, then at MOST characters. Columns other than doc_id and text are ignored (``keepers``
returns them, whatever their names). An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pistespark.llm.common import SPACE, fresh, one_each, written

#: Chunks end after one of these marks, once they have LEAST characters; failing that after one of these letters,
#: which are rare in their scripts; MOST without either end them too.
LEAST, MOST = 256, 2048
CHUNK = rf"(?s).{{{LEAST},{MOST}}}?[.!?;|。！？]|.{{{LEAST},{MOST}}}?[zjqxкщфのはが的0-9]|.{{1,{MOST}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def chunks(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, id_bits: int = 64) -> DataFrame:
    """row (a number), doc_id, n_points and text_hash (of the text as given), text_sha256, recipe (hashes in order), ranks (empty but for collisions).

    ``id_bits`` below 64 weakens the chunk hash, so that tests can make chunks collide.
    """
    hashed = (lambda c: F.xxhash64(c)) if id_bits == 64 else (lambda c: F.pmod(F.xxhash64(c), F.lit(1 << id_bits)))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    made = rows.select("row", "doc_id", F.length("text").cast("long").alias("n_points"), F.xxhash64("text").alias("text_hash"), normalised(F.col("text")).alias("norm"))
    made = made.select("row", "doc_id", "n_points", "text_hash", F.sha2("norm", 256).alias("text_sha256"), chunks(F.col("norm")).alias("chunks"))
    # one pass over the texts; later steps read the columns that they need. The row's number is fixed by the table
    made = written(made.withColumn("recipe", F.transform("chunks", hashed)), "recipes")
    # distinct chunks by hash: every chunk's bytes are compared with those of the same hash
    known = made.select(F.explode("chunks").alias("chunk")).select(hashed(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = written(known.groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1").select("h"), "collisions")
    out = made.select("row", "doc_id", "n_points", "text_hash", "text_sha256", "recipe", F.array().cast("array<int>").alias("ranks"))
    if shared.isEmpty():
        return out
    ranks = known.join(shared, "h", "left_semi").withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("chunk")))
    each = made.select("row", F.posexplode_outer("chunks").alias("pos", "chunk")).withColumn("h", hashed(F.col("chunk")))
    each = each.join(ranks.select("h", "chunk", "rank"), ["h", "chunk"], "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
    lists = each.groupBy("row").agg(F.array_sort(F.collect_list(F.when(F.col("h").isNotNull(), F.struct("pos", "rank")))).alias("l"))
    return out.drop("ranks").join(lists, "row").withColumn("ranks", F.col("l.rank")).drop("l")


def exact_groups(docs: DataFrame, id_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (also n_chunks, n_points, text_hash)."""
    rows = recipes(docs, id_bits)
    order = F.struct("n_points", F.bitwise_not("doc_id").alias("turned"), F.bitwise_not("text_hash").alias("hash"), "row")
    best = rows.groupBy("recipe", "ranks").agg(F.count("*").alias("group_size"), F.max(order).alias("best"))
    best = best.select("recipe", "ranks", "group_size", F.bitwise_not("best.turned").alias("keep_id"), F.col("best.row").alias("keep_row"))
    # the extra key is made after the aggregation, so this side gets an exchange of its own and AQE can split the other
    best = best.withColumn("k", F.xxhash64("recipe", "ranks"))
    out = rows.withColumn("k", F.xxhash64("recipe", "ranks")).join(best, ["k", "recipe", "ranks"])
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", F.size("recipe").alias("n_chunks"), "n_points", "text_hash")


def keepers(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: one of each group of equal texts."""
    groups = written(exact_groups(docs), "groups")
    id_, points, hash_ = fresh(docs.columns, "id", "points", "hash")
    won = groups.filter("kept").select(F.col("doc_id").alias(id_), F.col("n_points").alias(points), F.col("text_hash").alias(hash_))
    text = F.coalesce(docs["text"], F.lit(""))
    # the row's id, and the length and hash of its text; the group says that rows which agree in all three are copies
    kept = docs.join(won, docs["doc_id"].eqNullSafe(F.col(id_)) & (F.length(text) == F.col(points)) & (F.xxhash64(text) == F.col(hash_)), "left_semi")
    if groups.groupBy("doc_id", "n_points", "text_hash").count().filter("count > 1").isEmpty():
        return kept
    key = fresh(docs.columns, "key")[0]
    return one_each(kept.withColumn(key, F.xxhash64(text)), ["doc_id", key]).select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS pts, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), h AS (SELECT doc_id, pts, sha256(norm) AS sha FROM n),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place, count(*) OVER (PARTITION BY sha) AS group_size FROM h
      WINDOW w AS (PARTITION BY sha ORDER BY pts DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, sha AS text_sha256 FROM g
"""
