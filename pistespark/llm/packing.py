"""Packing sequences into length buckets with least padding, and token-budget batches inside each bucket.

A document's tokens are its words; one longer than ``max_len`` is cut into sequences of ``max_len`` and a rest,
so nothing is dropped. The histogram of sequence lengths covers the whole corpus and has at most ``max_len``
rows, whatever the corpus: that is what the driver gets. Dynamic programming over it finds the ``buckets``
upper bounds that minimise the total padding (exactly: no other choice of as many bounds pads less).
In a bucket of bound b a batch holds ``budget // b`` sequences (one at least). A sequence's place in its bucket
is a running sum over salted parts, so a bucket with most of the rows is spread over many tasks; the salt is a hash
of id, text and piece, so rows that share an id are spread, too. text_hash tells the rows of one doc_id apart.

Defined results: null and empty texts give one row with n_tokens 0 and null bucket, batch and slot; sequences of
equal length are in the order of a hash of id, text and piece; repeated rows are packed each, next to each other;
extra columns are ignored; an empty table gives none. Reruns agree.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pistespark.llm.common import n_words, ranked, salts, written

MAX_LEN, BUCKETS, BUDGET, SEED = 2048, 8, 16_384, 23


def bounds(counts: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets over a histogram {length: count} that minimise the padding.

    best[k][j]: least number of padded tokens for the first j lengths in k buckets. Padding is the padded
    tokens less the tokens themselves, which no choice changes.
    """
    lengths = np.array(sorted(n for n in counts if n > 0), np.int64)
    if not len(lengths):
        return []
    total = np.concatenate([[0], np.cumsum([counts[int(n)] for n in lengths])]).astype(np.float64)
    m = len(lengths)
    best = np.full(m + 1, np.inf)
    best[0] = 0
    back: list[np.ndarray] = []
    for _ in range(min(buckets, m)):
        now, last = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        now[0] = 0
        for j in range(1, m + 1):
            cost = best[:j] + lengths[j - 1] * (total[j] - total[:j])
            i = int(np.argmin(cost))
            now[j], last[j] = cost[i], i
        best = now
        back.append(last)
    out, j = [], m
    for last in reversed(back):
        if j:
            out.append(int(lengths[j - 1]))
            j = int(last[j])
    return out[::-1]


def sequences(docs: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """doc_id, text_hash, piece, first_token, n_tokens: one row per sequence, and one of 0 tokens for a text without words."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).alias("size"))
    last = F.expr(f"greatest(0, (size - 1) div {max_len})")
    rows = rows.select("doc_id", "text_hash", "size", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    first = F.col("piece") * max_len
    return rows.select("doc_id", "text_hash", "piece", first.alias("first_token"), F.least(F.col("size") - first, F.lit(max_len)).cast("long").alias("n_tokens"))


def packed(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, text_hash, piece, first_token, n_tokens, bucket, bound, padding, batch (numbered over all buckets), slot."""
    rows = written(sequences(docs, max_len), "sequences")
    counts = {r["n_tokens"]: r["n"] for r in rows.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    tops = bounds(counts, buckets)
    starts, batches = [], 0
    for low, top in zip([0, *tops], tops, strict=False):
        starts.append(batches)
        batches += -(-sum(c for n, c in counts.items() if low < n <= top) // max(1, budget // top))
    inside = F.array(*[F.lit(x).cast("long") for x in tops]) if tops else F.array().cast("array<bigint>")
    at = F.size(F.filter(inside, lambda b: b < F.col("n_tokens")))
    rows = rows.withColumn("bucket", F.when(F.col("n_tokens") > 0, at)).withColumn("bound", F.when(F.col("n_tokens") > 0, F.get(inside, at)))
    full = rows.filter("n_tokens > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash", "piece", F.lit(SEED)), F.lit(salts(sum(counts.values())))).cast("int"))
    full = full.withColumn("o", F.xxhash64("piece", "doc_id", "text_hash", F.lit(SEED)))
    full = ranked(full, ["bucket"], ["o", "doc_id", "text_hash", "piece", "n_tokens"], "salt", F.lit(1).cast("long"), "place")
    full = full.withColumn("room", F.when(F.col("bound") <= budget, F.expr(f"{budget}L div bound")).otherwise(F.lit(1).cast("long")))
    firsts = F.array(*[F.lit(x).cast("long") for x in starts]) if tops else F.array().cast("array<bigint>")
    full = full.withColumn("batch", F.get(firsts, F.col("bucket")) + F.expr("place div room")).withColumn("slot", F.col("place") % F.col("room"))
    cols = ["doc_id", "text_hash", "piece", "first_token", "n_tokens", "bucket", "bound", (F.col("bound") - F.col("n_tokens")).alias("padding"), "batch", "slot"]
    none = rows.filter("n_tokens = 0").withColumn("batch", F.lit(None).cast("long")).withColumn("slot", F.lit(None).cast("long"))
    return full.select(*cols).unionByName(none.select(*cols))
