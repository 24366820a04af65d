"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i + sum over pairs <v_i, v_j>) over the hashed terms that a text holds: its words
without punctuation, and the first four and five bytes of longer words, so that unseen forms of a stem count.
The pair term learns what two terms mean together, such as an insult with a group's name, at linear cost.

Learning: of the labelled rows whose crc32 is not held out, a sample of at most ``SAMPLE`` (least hash of id and
text; the bound is a parameter) joins its texts; tasks turn these to term ids; Spark counts each term's rows and
positive rows and keeps the ``TERMS`` with the largest likelihood ratio, above ``LEAST_GAIN`` (what chance gives
one term in some 100,000). The driver gets those counts and the sample's kept terms, both bounded, and fits the
machine by Adam, in the order of the hashes, so the layout of the files makes no difference. Scoring reads every
whole text once, in slices that cut no word, with no shuffle; the model that goes along has
TERMS * (FACTORS + 1) numbers.

Defined results: null is the empty text, scored by w0 alone; labels with null toxic are not used, and an id
labelled twice is toxic if one label says so; without usable labels every score is the prior 0; a null doc_id
is never held out; repeated rows are scored each and learned once; rows that share a labelled id share its label;
extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pistespark.llm.common import held_out, row_hash, slices, thinned, written
from pistespark.shared import settled

SAMPLE, TERMS, FACTORS, HASH_BITS, THRESHOLD, FOLD = 20_000, 4096, 8, 20, 0.3, 4
STEPS, BATCH, RATE, DECAY, LEAST_ROWS, LEAST_GAIN = 2500, 256, 0.02, 2e-3, 3, 20.0
#: ASCII other than letters and digits parts words; bytes of other characters stay.
_CLEAN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def term_ids(word: bytes) -> tuple[int, ...]:
    mask = (1 << HASH_BITS) - 1
    return tuple(zlib.crc32(t) & mask for t in (word, b"^4" + word[:4] if len(word) > 4 else b"", b"^5" + word[:5] if len(word) > 5 else b"") if t)


def words_of(text: str | None) -> Iterator[set[bytes]]:
    for part in slices((text or "").encode("utf-8", "replace")):
        yield set(part.lower().translate(_CLEAN).split())


@dataclass
class Machine:
    """A fitted model: term id -> row, w0, w (rows), v (rows x factors)."""

    place: dict[int, int]
    w0: float
    w: np.ndarray
    v: np.ndarray
    cache: dict[bytes, tuple[int, ...]] | None = None

    def rows(self, text: str | None) -> list[int]:
        known = self.cache if self.cache is not None else {}
        if len(known) > 300_000:
            known.clear()
        self.cache = known
        found: set[int] = set()
        for words in words_of(text):
            for word in words:
                got = known.get(word)
                if got is None:
                    got = known[word] = tuple(self.place[t] for t in term_ids(word) if t in self.place)
                if got:
                    found.update(got)
        return sorted(found)

    def score(self, text: str | None) -> float:
        if not self.place and self.w0 == -np.inf:
            return 0.0
        at = self.rows(text)
        v = self.v[at]
        z = self.w0 + self.w[at].sum() + 0.5 * (v.sum(0) ** 2 - (v**2).sum(0)).sum()
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(x: np.ndarray, y: np.ndarray, factors: int = FACTORS, steps: int = STEPS, seed: int = 5) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss over rows of 0/1 terms (n x terms, uint8) by Adam. Fixed seed and order: reruns agree."""
    rng = np.random.default_rng(seed)
    n, m = x.shape
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    p = np.concatenate([[np.log(base / (1 - base))], np.zeros(m), rng.normal(0, 0.02, m * factors)]).astype(np.float64)
    first, second, step, at, order = np.zeros_like(p), np.zeros_like(p), 0, n, np.arange(n)
    while step < steps:
        if at >= n:
            at, order = 0, rng.permutation(n)
        b, at = order[at : at + BATCH], at + BATCH
        xb = x[b].astype(np.float64)
        w, v = p[1 : m + 1], p[m + 1 :].reshape(m, factors)
        s = xb @ v
        z = p[0] + xb @ w + 0.5 * ((s**2).sum(1) - xb @ (v**2).sum(1))
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[b]) / len(b)
        gw = xb.T @ d
        g = np.concatenate([[d.sum()], gw + DECAY * w / m**0.5, (xb.T @ (d[:, None] * s) - v * gw[:, None] + DECAY * v).ravel()])
        step += 1
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        p -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return float(p[0]), p[1 : m + 1].copy(), p[m + 1 :].reshape(m, factors).copy()


def _terms(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sorted({t for words in words_of(x.as_py()) for w in words for t in term_ids(w)}) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int32()))], names=["at", "toxic", "terms"])

    return rows.select("at", "toxic", "text").mapInArrow(run, "at long, toxic int, terms array<int>")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS, factors: int = FACTORS) -> Machine:
    """Fit on at most ``sample`` labelled rows that are not held out."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id"), FOLD))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = written(known, "known")
    # thinned first, so that taking the first ``sample`` is a small task whatever the number of labels
    known = thinned(known, F.lit(min(1.0, (1.5 * sample + 50) / max(1, known.count()))), F.xxhash64("doc_id"))
    known = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labelled")  # at most ``sample`` rows of 12 bytes
    # an id may come in many rows, equal ones being one: their hashes are chosen before any text is read for its terms
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(row_hash().alias("at"), "toxic", "text")
    each = settled(found.select("at").distinct(), "hashes")
    picked = thinned(each, F.lit(min(1.0, (1.5 * sample + 50) / max(1, each.count()))), F.col("at")).orderBy("at").limit(sample)
    picked = settled(picked, "picked")  # at most ``sample`` hashes
    rows = found.join(F.broadcast(picked), "at", "left_semi").dropDuplicates(["at"])
    rows = _terms(rows)
    rows = written(rows.repartition(16), "terms")
    n, pos = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not n:
        return Machine({}, -np.inf, np.zeros(0), np.zeros((0, factors)))
    counts = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("rows"), F.sum("toxic").alias("bad"))
    share = min(max(pos / n, 1e-6), 1 - 1e-6)
    part = lambda k, q: F.when(k > 0, k * F.log(k / (F.col("rows") * q))).otherwise(0.0)
    gain = 2 * (part(F.col("bad"), share) + part(F.col("rows") - F.col("bad"), 1 - share))
    best = counts.filter((F.col("rows") >= LEAST_ROWS) & (gain >= LEAST_GAIN)).orderBy(gain.desc(), "term").limit(terms).select("term")
    place = {r["term"]: i for i, r in enumerate(best.collect())}
    chosen = docs.sparkSession.createDataFrame(list(place.items()), "term int, place int")
    used = rows.select("at", "toxic", F.explode_outer("terms").alias("term")).join(F.broadcast(chosen), "term", "left")
    used = used.groupBy("at", "toxic").agg(F.collect_list("place").alias("p")).collect()  # at most ``sample`` rows of kept terms
    used.sort(key=lambda r: r["at"])
    x = np.zeros((len(used), len(place)), np.uint8)
    for i, r in enumerate(used):
        x[i, r["p"]] = 1
    return Machine(place, *fit(x, np.array([r["toxic"] for r in used], float), factors))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))  # TERMS * (FACTORS + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        for batch in batches:
            made = np.array([machine.score(x.as_py()) for x in batch.column(1)], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], names=["doc_id", "score"])

    out = docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLD).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all columns, whose text scores below the threshold. No shuffle: each row is scored where it is."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([machine.score(x.as_py()) < threshold for x in text], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
