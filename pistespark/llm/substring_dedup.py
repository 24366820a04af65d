"""Removing repeated passages of words by difference-cover anchors.

A passage repeats if LENGTH words in a row also stand in a document with a smaller doc_id.

1. *Anchors.* COVER is a difference cover modulo PERIOD: for any two places there is a shift below PERIOD that takes both
   to places whose remainders are in COVER. So two equal windows of LENGTH words have, at one and the same shift, an
   aligned stretch of GRAM = LENGTH - PERIOD + 1 words, and only these stretches are hashed: three of seven places.
2. *Which anchors count.* Hashes meet by ranges; those that come in one document only are dropped, which is most of
   them. A task sends a hash once for each part of the documents that has it, and once in all to the hash's range, so a
   passage that a third of the documents share costs a row per task there.
3. *Extension.* A part gets its documents and the anchors in them that count. Each window around such an anchor is a
   candidate; it goes out with two hashes of all its words (128 bits), for the part's smallest document that has it;
   what repeats inside the part is known at once. Candidates meet by ranges of the first hash, where the smallest
   document of each window is found and all others' are repeats.
4. Repeats, as runs of windows, go back to their documents, which are cut.

Nothing is compared in pairs, so a group of equal passages costs its own number of rows. Documents are dealt by a hash
of their id into parts of about ``part`` bytes, and hashes into ranges of about a million rows: both are groups, not
partitions, so a task holds one of them at a time and the number of partitions is Spark's affair.

Defined results: null text is the empty text; texts under LENGTH words lose nothing; a word is one however long it is;
a null doc_id comes after all others, and rows that share a doc_id (null too) never repeat each other, as neither has the
smaller one; each row is returned, fully repeated rows too; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.llm import words
from pistespark.llm.common import WORD
from pistespark.shared import settled

LENGTH, PERIOD, COVER = 13, 7, (0, 1, 3)
GRAM = LENGTH - PERIOD + 1
PART, RANGE, RANGES = 8 << 20, 1 << 20, 128
#: Words in all at which a task folds what it holds and sends it.
FLUSH = 1 << 22
LAST = (1 << 63) - 1  # stands for a null id
_U = np.uint64


def _aligned(n: int) -> np.ndarray:
    """Places of a text of n words at which an anchor starts."""
    place = np.arange(max(n - GRAM + 1, 0))
    return place[np.isin(place % PERIOD, COVER)]


def _words(text: bytes, n_hashes: int) -> list[np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    return words.hashed(data, words.SPACES[data], n_hashes)[2]


_ANCHOR = "bucket long, h long, part int"
#: part of an anchor row: the part that holds the hash in one document; SEVERAL: several documents of the task hold it; -2 - part: such a part.
SEVERAL = -1


def _batches(columns: dict[str, np.ndarray], kinds: dict[str, pa.DataType], size: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for at in range(0, n, size):
        yield pa.RecordBatch.from_arrays([pa.array(columns[c][at : at + size], k) for c, k in kinds.items()], names=list(kinds))


def _range(h: np.ndarray, ranges: int) -> np.ndarray:
    """Of ``ranges`` equal ranges of all hashes, the one that each lies in."""
    return ((h >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)


def _anchors(docs: DataFrame, ranges: int) -> DataFrame:
    """Per task and anchor: one row if one document has it, else one for all and one for each part that has it."""
    kinds = {"bucket": pa.int64(), "h": pa.int64(), "part": pa.int32()}

    def folded(found: list[np.ndarray], where: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, part = np.concatenate(found), np.concatenate(where)
        order = np.lexsort((part, h))
        h, part = h[order], part[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        count = np.diff(np.append(np.flatnonzero(new), len(h)))
        many = np.repeat(count > 1, count)
        pair = many & (new | np.concatenate([[True], part[1:] != part[:-1]]))
        one, all_ = h[~many], h[new & many]
        spread = words.mixed(h[pair] + part[pair].astype(np.uint64) * _U(words.BASES[1]))  # these need not meet
        for x, at, p in ((one, one, part[~many]), (all_, all_, np.full(len(all_), SEVERAL)), (h[pair], spread, -2 - part[pair])):
            yield from _batches({"bucket": _range(at, ranges), "h": x.view(np.int64), "part": p.astype(np.int32)}, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, where, held = [], [], 0
        for batch in batches:
            for part, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                (h,) = _words(words.raw(text), 1)
                if len(h) < LENGTH:
                    continue
                found.append(np.unique(words.of_runs(h, _aligned(len(h)), GRAM)))
                where.append(np.full(len(found[-1]), part, np.int32))
                held += len(h)
                if held >= FLUSH:
                    yield from folded(found, where)
                    found, where, held = [], [], 0
        if found:
            yield from folded(found, where)

    return docs.select("part", "text").mapInArrow(run, _ANCHOR)


def _counting(rows: pa.Table) -> pa.Table:
    """The step at a range of hashes: (h, part) of those that several documents have."""
    h, part = rows.column("h").to_numpy(), rows.column("part").to_numpy()
    direct = part <= -2
    a, p = h[~direct], part[~direct]
    order = np.argsort(a, kind="stable")
    a, p = a[order], p[order]
    new = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.zeros(0, bool)
    size = np.diff(np.append(np.flatnonzero(new), len(a)))
    use = np.repeat(size > 1, size) & (p >= 0)
    return pa.table({"h": pa.array(np.concatenate([a[use], h[direct]]), pa.int64()), "part": pa.array(np.concatenate([p[use], -2 - part[direct]]), pa.int32())})


_KINDS = {"bucket": pa.int64(), "w": pa.int64(), "v": pa.int64(), "doc": pa.int64(), "tie": pa.int64(), "start": pa.int64(), "n": pa.int64()}
_SCHEMA = "bucket long, w long, v long, doc long, tie long, start long, n long"
_SPANS = {"doc": pa.int64(), "tie": pa.int64(), "start": pa.int64(), "n": pa.int64()}


def _runs(doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> dict[str, np.ndarray]:
    """Windows as runs: n of them from ``start`` on."""
    order = np.lexsort((start, tie, doc))
    doc, tie, start = doc[order], tie[order], start[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] != start[:-1] + 1)]) if len(doc) else np.zeros(0, bool)
    return {"doc": doc[new], "tie": tie[new], "start": start[new], "n": np.diff(np.append(np.flatnonzero(new), len(doc)))}


def _later(w: np.ndarray, v: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, repeats): by (w, v), then document; repeats have a smaller document before them."""
    order = np.lexsort((doc, v, w))
    w, v, doc = w[order], v[order], doc[order]
    new = np.concatenate([[True], (w[1:] != w[:-1]) | (v[1:] != v[:-1])]) if len(w) else np.zeros(0, bool)
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(w) else np.zeros(0, np.int64)
    return order, doc > doc[first]


def _extended(ranges: int):
    """The step at a part: candidate windows in the part's smallest document that has them, and repeats within the part (n > 0)."""

    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        known = np.unique(wanted.column("h").to_numpy()).view(np.uint64)
        known.sort()
        made = []
        for doc, tie, text in zip(docs.column("doc").to_pylist(), docs.column("tie").to_pylist(), docs.column("text"), strict=True) if len(known) else ():
            a, b = _words(words.raw(text), 2)
            n = len(a)
            if n < LENGTH:
                continue
            place = _aligned(n)
            h = words.of_runs(a, place, GRAM)
            hit = place[known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h]
            # the windows that hold an anchor whole start up to PERIOD - 1 words before it
            near = np.zeros(n + 1, np.int32)
            np.add.at(near, np.maximum(hit - PERIOD + 1, 0), 1)
            np.add.at(near, hit + 1, -1)
            at = np.flatnonzero(np.cumsum(near)[: n - LENGTH + 1] > 0)
            if len(at):
                made.append((words.of_runs(a, at, LENGTH), words.of_runs(b, at, LENGTH, words.BASES[1]), np.full(len(at), doc), np.full(len(at), tie), at))
        if not made:
            return pa.schema(list(_KINDS.items())).empty_table()
        columns = [list(x) for x in zip(*made, strict=True)]
        made.clear()
        w, v, doc, tie, start = (np.concatenate(columns.pop(0)) for _ in range(5))
        order, later = _later(w, v, doc)
        first, gone = order[~later], order[later]
        out = {"bucket": _range(w[first], ranges), "w": w[first].view(np.int64), "v": v[first].view(np.int64), "doc": doc[first], "tie": tie[first], "start": start[first], "n": np.zeros(len(first), np.int64)}
        spans = _runs(doc[gone], tie[gone], start[gone])
        none = np.zeros(len(spans["doc"]), np.int64)
        spans |= {"bucket": _range(words.mixed(spans["doc"].astype(np.uint64) + spans["start"].astype(np.uint64)), ranges), "w": none, "v": none}
        return pa.Table.from_batches([*_batches(out, _KINDS), *_batches(spans, _KINDS)], schema=pa.schema(list(_KINDS.items())))

    return run


def _met(rows: pa.Table) -> pa.Table:
    """The step at a range of windows: repeats between parts; those within a part pass through."""
    cols = {c: rows.column(c).to_numpy() for c in ("w", "v", *_SPANS)}
    ready = cols["n"] > 0
    w, v, doc, tie, start = (cols[c][~ready] for c in ("w", "v", "doc", "tie", "start"))
    order, later = _later(w, v, doc)
    gone = order[later]
    out = _runs(doc[gone], tie[gone], start[gone])
    return pa.Table.from_batches([*_batches(out, _SPANS), *_batches({c: cols[c][ready] for c in _SPANS}, _SPANS)], schema=pa.schema(list(_SPANS.items())))


def _cut(docs: pa.Table, repeats: pa.Table) -> pa.Table:
    """The last step at a part: its documents without what repeats."""
    d, t, s, n = (repeats.column(c).to_numpy() for c in _SPANS)
    order = np.lexsort((t, d))
    d, t, s, n = d[order], t[order], s[order], n[order]
    rows = []
    for doc_id, doc, tie, copies, text in zip(*(docs.column(c).to_pylist() for c in ("doc_id", "doc", "tie", "copies")), docs.column("text"), strict=True):
        each = words.raw(text).split()
        low, high = np.searchsorted(d, doc), np.searchsorted(d, doc, "right")
        low, high = low + np.searchsorted(t[low:high], tie), low + np.searchsorted(t[low:high], tie, "right")
        kept = each
        if high > low:
            over = np.zeros(len(each) + 1, np.int64)
            np.add.at(over, s[low:high], 1)
            np.add.at(over, s[low:high] + n[low:high] + LENGTH - 1, -1)
            kept = list(compress(each, np.cumsum(over)[:-1] == 0))
        rows.append((doc_id, len(each), len(each) - len(kept), b" ".join(kept), copies))
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.table({c: pa.array(x, k) for (c, k), x in zip({"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.binary(), "copies": pa.int64()}.items(), cols, strict=True)})


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("doc", "tie"), F.lit(parts)).cast("int").alias("part")


def repeated(docs: DataFrame, part: int = PART, rows_a_range: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """(documents by part, repeats): repeats has doc, tie, start, n: n windows from word ``start`` on also stand in a smaller document."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part))
    ranges = max(RANGES, size // 14 // rows_a_range)  # words of 6 bytes, three of seven hashed
    twice = not docs.groupBy(doc.alias("d")).count().filter("count > 1").isEmpty()
    tie = F.xxhash64("text") if twice else F.lit(0).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc.alias("doc"), tie.alias("tie"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.lit(1).cast("long").alias("copies"))
    if twice:  # rows that repeat id and text become one, so that no part gets them all
        rows = settled(rows.groupBy("doc_id", "doc", "tie", F.octet_length("text").alias("_b")).agg(F.first("text").alias("text"), F.count("*").alias("copies")).drop("_b"), "rows")
    rows = rows.select("*", _part(parts))
    wanted = settled(_anchors(rows, ranges).groupBy("bucket").applyInArrow(_counting, "h long, part int"), "anchors")
    windows = rows.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(_extended(ranges), _SCHEMA)
    found = windows.groupBy("bucket").applyInArrow(_met, "doc long, tie long, start long, n long")
    return rows, found.select("doc", "tie", "start", "n", _part(parts))


def cut(docs: DataFrame, part: int = PART, rows_a_range: int = RANGE) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (UTF-8 of the kept words, joined by one space) for every row of docs."""
    rows, out = repeated(docs, part, rows_a_range)
    done = rows.groupBy("part").cogroup(out.groupBy("part")).applyInArrow(_cut, "doc_id long, n_words long, n_removed long, kept binary, copies long")
    return done.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "_i")


def deduplicated(docs: DataFrame, part: int = PART, rows_a_range: int = RANGE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of docs."""
    return cut(docs, part, rows_a_range).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {LENGTH - 2}, 1))) AS i FROM d WHERE len(w) >= {LENGTH}),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {LENGTH - 1}], ' ')) AS g FROM s),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
r AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT doc_id, i, unnest(range(0, {LENGTH})) AS k FROM g JOIN f USING (g) WHERE doc_id > first)),
n AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, len(coalesce(gone, [])) AS n_removed, array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(coalesce(gone, []), i)], ' ') AS kept FROM d LEFT JOIN n USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(kept) AS kept_sha256 FROM k
"""
