"""Mixing sources to target weights, in blocks, with DataFrame functions only.

1. Words of each source, in a fixed order of its documents, form a stream that is packed into blocks of
   ``block`` words; a document covers a range of blocks. Offsets are running sums over salted parts, so a
   source with a third of all rows is never in one task.
2. Targets: weights 5, 2, 1 repeating over the sources by code point share all words; no target passes
   ``most`` times its source's size, and what is above is shared again by weight.
3. Output slots form shards of ``shard_slots``. Every slot of a shard draws a source with the share that the source
   has of all slots, so a shard's source counts are a multinomial draw. A correction makes the totals exact: of a
   source that was drawn too often, the last draws (by shard) go to those that were drawn too seldom, in the order
   of shards; that is about the square root of a source's slots. The counts per shard are a table.
4. The n-th slot of a source, counted over the shards, is in epoch n / blocks, and a pseudorandom permutation of the
   source's block indices, another one for each epoch, gives its block. Slots and documents meet by joining on
   (source, block index). Each epoch uses a block once, so no word is taken more than ``most`` times. A source
   has as many slots as its target needs, also where its short last block is among them, and its last slot is
   cut, so that its words are its target, rounded.

The permutations are swap-or-not networks keyed by ``seed`` over any domain size, so a rerun agrees.

Defined results: null text has size 0; a null source is a source, after all others; rows of size 0 take 0; a text
of any length is a range of blocks; a source of one block takes from it in every epoch; rows of one source are in
the order of salted hashes of id and text, and repeated rows stand next to each other and count each; ``taken``
ignores extra columns and ``mixed`` returns them, whatever their names; an empty table gives none. One row per
source is collected to the driver, to share out the targets; more than ``SOURCES`` raise an error.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.llm.common import WORD, fresh, n_words, one_each, ranked, salts, written

WEIGHTS = (5, 2, 1)
BLOCK, SHARD_SLOTS, MOST, SEED, ROUNDS, SOURCES = 64, 1024, 3, 17, 14, 100_000


def targets(sizes: list[tuple[str | None, int]], weights: tuple = WEIGHTS, most: int = MOST) -> list[tuple[str | None, int, float]]:
    """(source, size, target) by code point, null last; see the module's text."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, got, free = dict(order), {}, [s for s, _ in order]
    rest = float(sum(size.values()))
    while free:
        share = rest / sum(weight[s] for s in free)
        above = [s for s in free if share * weight[s] > most * size[s]]
        if not above:
            return [(s, n, got.get(s, share * weight[s])) for s, n in order]
        for s in above:
            got[s] = float(most * size[s])
            rest -= got[s]
        free = [s for s in free if s not in got]
    return [(s, n, got[s]) for s, n in order]


def permuted(x: Column, n: Column, *key: Column, rounds: int = ROUNDS, back: bool = False) -> Column:
    """The image of x in a pseudorandom permutation of 0 .. n-1: in each round, x and its mirror K - x swap or not, both alike.

    back: what x is the image of. Each round undoes itself, so that is the rounds in turn from the last."""

    def step(y: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), n) - y, n)
        swap = F.xxhash64(F.greatest(y, mirror), *key, r).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(y)

    turns = F.sequence(F.lit(rounds), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(rounds))
    return F.aggregate(turns, x, step)


def sized(docs: DataFrame) -> DataFrame:
    """One row per document, with its size and the salted order that its source is packed in."""
    rows = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")), "sizes")
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(SEED)), F.lit(salts(rows.count()))).cast("int"))


def planned(docs: DataFrame, sizes: list[tuple[str | None, int]], block: int, seed: int) -> list[dict]:
    """Per source, in order: name, src, size, target, blocks, epochs that are whole, rest (words of the last one),
    short (words of its last block), turn (the short block's place in the last epoch), n (slots)."""
    made = []
    for i, (name, size, target) in enumerate(targets(sizes)):
        words = min(int(target + 0.5), MOST * size)
        epochs, rest = divmod(words, size) if size else (0, 0)
        blocks = -(-size // block)
        made.append({"name": name, "src": i, "size": size, "target": target, "blocks": blocks, "epochs": epochs, "rest": rest, "short": size - (blocks - 1) * block})
    if not made:
        return made
    long = docs.sparkSession.createDataFrame([(x["src"], max(1, x["blocks"]), x["epochs"]) for x in made], "src long, blocks long, epochs long")
    turn = permuted(F.col("blocks") - 1, F.col("blocks"), F.lit(seed), F.col("src"), F.col("epochs"), back=True)
    turns = {r["src"]: r["turn"] for r in long.select("src", turn.alias("turn")).collect()}
    for x in made:
        x["turn"] = turns[x["src"]]
        last = -(-x["rest"] // block)
        if last > x["turn"]:  # the short block is among them, and what it lacks is made up
            last = -(-(x["rest"] + block - x["short"]) // block)
        x["n"] = x["epochs"] * x["blocks"] + last
    return made


def stretched(table: DataFrame, first: str, end: str, width: int) -> DataFrame:
    """A row for each stretch of ``width`` numbers that [first, end) meets, as ``at``. Rows without numbers meet none."""
    return table.filter(f"{end} > {first}").withColumn("at", F.explode(F.expr(f"sequence({first} div {width}, ({end} - 1) div {width})")))


def shards(docs: DataFrame, plan: list[dict], shard_slots: int, seed: int) -> DataFrame:
    """shard, src, first, n: the shard has n slots of the source, from its first-th on. Multinomial draws with corrected totals.

    What is broadcast has two rows a source at most. Stretches are as many as sources, so a ticket, which may be any
    number, is compared with two sources on average, however uneven they are."""
    spark = docs.sparkSession
    total = sum(x["n"] for x in plan)
    held, at = [], 0
    for x in plan:
        held.append((x["src"], x["n"], at, at + x["n"]))
        at += x["n"]
    sources = spark.createDataFrame(held, "src int, n long, from long, to long")
    # a ticket per slot: the source that holds it
    width = max(1, total // max(1, len(plan)))
    ticket = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(total, 1)))
    drawn = spark.range(0, total, 1, max(spark.sparkContext.defaultParallelism, total // 2_000_000)).select(F.expr(f"id div {shard_slots}").alias("shard"), ticket.alias("t"))
    drawn = drawn.withColumn("at", F.expr(f"t div {width}")).join(F.broadcast(stretched(sources, "from", "to", width)), "at").filter("t >= from AND t < to")
    counts = written(drawn.groupBy("shard", "src").agg(F.count("*").alias("drawn")), "shards")
    got = {r["src"]: r["n"] for r in counts.groupBy("src").agg(F.sum("drawn").alias("n")).collect()}
    near = max(1, isqrt(total // shard_slots))
    counts = counts.withColumn("salt", F.expr(f"shard div {near}"))
    rows = ranked(counts, ["src"], ["shard"], "salt", F.col("drawn"), "before").drop("_row")
    rows = rows.join(F.broadcast(sources.select("src", "n")), "src").withColumn("kept", F.greatest(F.lit(0).cast("long"), F.least(F.col("drawn"), F.col("n") - F.col("before")))).drop("n")
    rows = written(rows.withColumn("over", F.col("drawn") - F.col("kept")), "counted")
    kept = rows.filter("kept > 0").select("shard", "src", F.col("before").alias("first"), F.col("kept").alias("n"))
    gaps, at = [], 0
    for x in plan:
        lack = x["n"] - got.get(x["src"], 0)
        if lack > 0:
            gaps.append((x["src"], at, at + lack, got.get(x["src"], 0)))
            at += lack
    if not gaps:
        return kept
    width = max(1, at // len(gaps))
    over = ranked(rows.filter("over > 0").select("shard", "src", "salt", "over", F.lit(0).alias("all")), ["all"], ["shard", "src"], "salt", F.col("over"), "off")
    over = stretched(over.select("shard", "off", (F.col("off") + F.col("over")).alias("end")), "off", "end", width)
    lacks = stretched(spark.createDataFrame(gaps, "src int, from long, to long, had long"), "from", "to", width)
    # the two meet in every stretch that they share; the first one counts
    given = over.join(F.broadcast(lacks), "at").filter(f"from < end AND to > off AND at = greatest(from div {width}, off div {width})")
    low, high = F.greatest("off", "from"), F.least("end", "to")
    given = given.select("shard", "src", (F.col("had") + low - F.col("from")).alias("first"), (high - low).alias("n"))
    return kept.unionByName(given)


def mix(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(placed, slots). placed: a row per document: doc_id, source, text_hash, src, size, source_size, target, offset, salt, _row.
    slots: shard, src, nth, epoch, block, take (words of that block, from its start)."""
    rows = sized(docs)
    spark = docs.sparkSession
    sizes = rows.groupBy("source").agg(F.sum("size").alias("n"))
    if sizes.count() > SOURCES:
        raise ValueError(f"over {SOURCES} sources")
    plan = planned(docs, [(r["source"], r["n"]) for r in sizes.collect()], block, seed)
    sources = spark.createDataFrame([(x["name"], x["src"], x["size"], x["target"]) for x in plan], "_s string, src int, source_size long, target double")
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    placed = ranked(rows, ["src"], ["doc_id", "text_hash", "size"], "salt", F.col("size"), "offset")

    names = ["blocks", "epochs", "rest", "short", "turn"]
    known = spark.createDataFrame([(x["src"], *(x[k] for k in names)) for x in plan], "src int, " + ", ".join(f"{k} long" for k in names))
    # a row holds at most a shard's slots; there are few rows, but many slots to be made of them: dealt by how many those are
    dealt = max(spark.sparkContext.defaultParallelism, sum(x["n"] for x in plan) // 2_000_000)
    slots = shards(docs, plan, shard_slots, seed).repartition(dealt, "shard", "src").select("shard", "src", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("nth"))
    slots = slots.join(F.broadcast(known), "src")  # a row per source, at most SOURCES
    slots = slots.withColumn("epoch", F.expr("nth div blocks")).withColumn("place", F.col("nth") % F.col("blocks"))
    so_far = F.col("place") * block - F.when(F.col("turn") < F.col("place"), block - F.col("short")).otherwise(0)
    whole = F.lit(block).cast("long")
    take = F.when(F.col("epoch") == F.col("epochs"), F.least(F.col("rest") - so_far, whole)).otherwise(whole)
    drawn = permuted(F.col("place"), F.col("blocks"), F.lit(seed), F.col("src").cast("long"), F.col("epoch"))
    # a table: else the join's null filters pull the permutations, written out many times over, below it
    return placed, written(slots.select("shard", "src", "nth", "epoch", drawn.alias("block"), take.alias("take")), "slots")


def pieces(placed: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """Documents joined with the slots that draw their blocks: per piece its document, epoch, first word and number of words."""
    at, end = F.expr(f"offset div {block}"), F.expr(f"(offset + size - 1) div {block}")
    parts = placed.filter("size > 0").select("src", "salt", "_row", "doc_id", "source", "text_hash", "offset", "size", F.explode(F.sequence(at, end)).alias("block"))
    parts = parts.withColumn("from", F.greatest(F.col("offset") - F.col("block") * block, F.lit(0))).withColumn("to", F.least(F.col("offset") + F.col("size") - F.col("block") * block, F.lit(block)))
    cut = parts.join(slots, ["src", "block"]).withColumn("words", F.least("to", "take") - F.col("from")).filter("words > 0")
    return cut.withColumn("first", F.col("block") * block + F.col("from") - F.col("offset"))


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words of each document that the mix takes, repeats counted."""
    placed, slots = mix(docs, block)
    placed = written(placed, "placed")
    got = pieces(placed, slots, block).groupBy("src", "salt", "_row").agg(F.sum("words").alias("taken"))
    out = placed.join(got, ["src", "salt", "_row"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row per document and epoch that takes some of it.

    A text that is taken whole stays as it is; of others the taken stretches follow each other, words parted by
    blanks. n_chars, where there is one, is that of the new text. Texts without words are not in the mix."""
    placed, slots = mix(docs, block)
    placed = written(placed, "placed")
    id_, hash_, source, parts = fresh(docs.columns, "id", "hash", "from", "parts")
    stretch = F.struct("first", "words")
    got = pieces(placed, slots, block).groupBy("src", "salt", "_row", "epoch", "doc_id", "source", "text_hash", "size")
    got = got.agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list(stretch)).alias("parts"))
    # no parts: the whole text
    got = got.select(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("text_hash").alias(hash_), F.when(F.col("taken") < F.col("size"), F.col("parts")).alias(parts))
    rows, names = docs, docs.columns
    if not placed.groupBy("doc_id", "source", "text_hash").count().filter("count > 1").isEmpty():
        key = fresh(names, "key")[0]
        rows = one_each(docs.withColumn(key, F.xxhash64("text")), ["doc_id", "source", key])
    same = rows["doc_id"].eqNullSafe(F.col(id_)) & rows["source"].eqNullSafe(F.col(source)) & (F.xxhash64(rows["text"]) == F.col(hash_))
    out = rows.join(got, same)
    # the words are one element of an array, so that they are split once and not for each stretch
    words = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    stretches = lambda w: F.array_join(F.transform(parts, lambda p: F.array_join(F.slice(w, p["first"].cast("int") + 1, p["words"].cast("int")), " ")), " ")
    cut = F.get(F.transform(words, stretches), F.lit(0))
    out = out.withColumn("text", F.when(F.col(parts).isNull(), F.col("text")).otherwise(cut))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(parts).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in names])
