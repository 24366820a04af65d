"""Language identification with bit-sliced Bloom filters of n-grams.

Each language has a Bloom filter of its usual character n-grams. The filters have one size and one set of hash
functions and are stored bit-sliced: the table's cell i holds bit i of all filters side by side, one bit per
language. So one lookup, the AND of the cells at an n-gram's hash places, returns the bitmask of all languages
that have the n-gram. A text's n-grams give a popcount per language; a filter answers yes by chance at a rate
known from its fill, and (hits - n * rate) / (1 - rate) corrects for that. The largest corrected count decides,
and its share of all languages' counts is the score.

Learning: a sample of at most ``SAMPLE`` rows per language (least hash of id and text; a repeated row is one) of
those not held out; tasks count n-grams; an n-gram belongs to each language where it is at least ``SHARE`` as
frequent as where it is most frequent, which keeps foreign passages in the sample from filling a filter; the
``NGRAMS`` commonest per language go in. The model is one byte table per eight languages, of which there may be
``LANGUAGES`` (more raise an error: such a column holds something else). Prediction reads every whole text once,
in slices that carry open n-grams over, with no shuffle, from the text alone.

Defined results: null text, and text without a letter, is ``und`` with score 0; ties go to the first language
in code point order; letters that no filter knows give the first learned language with score 1 / languages;
with nothing to learn from, all is ``und``; a null doc_id is never held out; repeated rows are judged each, and
rows that share an id are each as likely to be learned from; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pistespark.llm.common import held_out, row_hash, thinned, written
from pistespark.shared import settled

SAMPLE, NGRAMS, SIZES, SHARE, CELLS, PROBES, FOLD, SLICE, LANGUAGES = 1500, 30_000, (2, 3, 4), 0.25, 1 << 19, 3, 4, 1 << 18, 512
UND = "und"
_P, _M = np.uint64(0x100000001B3), np.uint64(0xFF51AFD7ED558CCD)
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str, sizes: tuple[int, ...] = SIZES, size: int = SLICE) -> Iterator[np.ndarray]:
    """64-bit hashes of a text's n-grams of letters, runs of anything else counting as one blank; it begins and ends with a blank.

    They come slice by slice; what an n-gram needs of the slice before is carried over, so where cuts are makes no difference."""
    letters, text = _letters(), text.lower()
    tail, inside = np.array([32], np.uint64), False  # the last points, and whether the last of all was a letter
    for at in range(0, len(text), size):
        points = np.frombuffer(text[at : at + size].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = letters[np.minimum(points, 0x10FFFF)]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= inside
        inside = bool(letter[-1])
        new = np.where(letter, points, 32)[keep].astype(np.uint64)
        if at + size >= len(text) and inside:
            new = np.append(new, np.uint64(32))
        if not len(new):
            continue
        roll = points = np.concatenate([tail, new])
        out = []
        for n in range(2, max(sizes) + 1):
            roll = roll[:-1] * _P + points[n - 1 :]
            if n in sizes:
                h = (roll[max(0, len(tail) - n + 1) :] ^ np.uint64(n)) * _M
                out.append(h ^ (h >> np.uint64(32)))
        tail = points[-(max(sizes) - 1) :]
        yield np.concatenate(out)


def ngrams(text: str, sizes: tuple[int, ...] = SIZES) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *grams(text, sizes)])


@dataclass
class Filters:
    languages: list[str]
    table: np.ndarray  # one row of CELLS bytes per eight languages
    rates: np.ndarray  # chance of a wrong yes per language

    @staticmethod
    def places(h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h >> np.uint64(40)) | np.uint64(1)
        for i in range(PROBES):
            yield ((h + np.uint64(i) * step) & np.uint64(CELLS - 1)).astype(np.int64)

    @classmethod
    def built(cls, grams: dict[str, np.ndarray]) -> Filters:
        names = sorted(grams)
        table = np.zeros((-(-len(names) // 8), CELLS), np.uint8)
        rates = np.zeros(len(names))
        for i, name in enumerate(names):
            for at in cls.places(grams[name]):
                table[i // 8, at] |= np.uint8(1 << i % 8)
            rates[i] = float((table[i // 8] >> (i % 8) & 1).mean()) ** PROBES
        return cls(names, table, rates)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages:
            return UND, 0.0
        n, hits = 0, np.zeros(8 * len(self.table), np.int64)
        for h in grams(text):
            n += len(h)
            if len(h):
                at = list(self.places(h))
                for i, row in enumerate(self.table):
                    masks = row[at[0]]
                    for x in at[1:]:
                        masks = masks & row[x]
                    hits[8 * i : 8 * i + 8] += np.bincount(masks, minlength=256) @ _BITS
        if not n:
            return UND, 0.0
        right = np.maximum(0.0, (hits[: len(self.languages)] - n * self.rates) / (1 - self.rates))
        if right.sum() <= 0:
            return self.languages[0], 1.0 / len(self.languages)
        best = int(np.argmax(right))
        return self.languages[best], float(right[best] / right.sum())


def learn(docs: DataFrame, sample: int = SAMPLE, top: int = NGRAMS) -> Filters:
    rows = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), FOLD))
    # repeated rows are one before anything is counted or chosen: only their hashes move
    rows = rows.withColumn("h", row_hash())
    each = settled(rows.select("lang", "h").distinct(), "hashes")
    # thinned to about 1.5 times the sample per language, so that ranking it is a small task whatever the corpus
    sizes = each.groupBy("lang").agg(F.least(F.lit(1.0), (1.5 * sample + 50) / F.count("*")).alias("share"))
    if sizes.count() > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} languages to learn")
    some = thinned(each.join(F.broadcast(sizes), "lang"), F.col("share"), F.col("h")).select("lang", "h")
    picked = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= sample).select("lang", "h")
    picked = written(picked, "sample")  # at most ``sample`` hashes per language
    chosen = rows.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))  # repeated rows once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                by.setdefault(name, []).extend(grams(text.as_py()))
            for name, some in by.items():
                h, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *some]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(n)], names=["lang", "h", "n"])

    counts = written(chosen.select("lang", "text"), "texts").mapInArrow(run, "lang string, h long, n long").groupBy("lang", "h").agg(F.sum("n").alias("n"))
    counts = written(counts, "ngrams")
    total = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    rated = counts.join(total, "lang").withColumn("rate", F.col("n") / F.col("all"))
    rated = rated.withColumn("most", F.max("rate").over(Window.partitionBy("h"))).filter(F.col("rate") >= SHARE * F.col("most"))
    best = rated.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "h"))).filter(F.col("r") <= top)
    kept: dict[str, list[int]] = {r["lang"]: [] for r in total.select("lang").collect()}
    for r in best.groupBy("lang").agg(F.collect_list("h").alias("h")).collect():  # at most ``top`` per language
        kept[r["lang"]] = r["h"]
    return Filters.built({k: np.array(v, np.int64).view(np.uint64) for k, v in kept.items()})


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    filters = docs.sparkSession.sparkContext.broadcast(learn(docs))  # CELLS bytes per eight languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = filters.value
        for batch in batches:
            made = [known.predict(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.float64())], names=["doc_id", "lang_pred", "score"])

    out = docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLD).alias("held_out"), "lang_pred", "score")
