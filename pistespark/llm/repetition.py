"""Repetition coverage of a text: characters inside repeated n-grams and lines, by rolling hashes in numpy.

Words get integer ids; the hash of each n-gram grows from that of the (n-1)-gram at the same place by one
multiplication and addition over the whole array (mod 2**64). An n-gram that comes twice repeats all its
parts, so the lengths are tried from short to long and the loop ends at the first without a repeat.
Windows of three words are compared exactly (ids packed into one integer), not by hash.

Defined results: null is the empty text, which has no words and fails; each row is judged on its own, so
repeated rows and extra columns change nothing; memory is a few arrays over the words of the text at hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Limits, as shares of the characters in words: the commonest n-gram, later repeats of n-grams, later repeats of lines.
TOP = {2: 0.20, 3: 0.18, 4: 0.16}
DUPLICATE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_CHARS, LINES = 0.20, 0.30
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _points(b: bytes) -> int:
    return len(b.decode("utf-8", "replace"))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key comes twice or more."""
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside the windows of n words that begin where ``starts`` is true."""
    step = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def _triples(ids: np.ndarray, kinds: int) -> np.ndarray:
    """A key for each window of three words, equal only for equal windows."""
    a, b, c = ids[:-2], ids[1:-1], ids[2:]
    if kinds < 1 << 21:
        return (a << 42) | (b << 21) | c
    pairs = np.unique(a * kinds + b, return_inverse=True)[1].astype(np.int64)
    return pairs * kinds + c


def measure(text: str | None) -> tuple:
    """The values of SCHEMA after doc_id."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    word_chars = _points(data) - (len(data) - sum(map(len, words)))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    n_lines = n_dup_lines = dup_line_chars = 0
    for line in data.split(b"\n"):
        if line.strip():
            n_lines += 1
            if line in seen:
                n_dup_lines += 1
                dup_line_chars += _points(b"".join(line.split()))
            else:
                seen.add(line)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    length = np.fromiter(map(_points, known), np.int64, len(known))[ids] if n else np.zeros(0, np.int64)
    n_repeat_words = 0
    if n >= 4:
        n_repeat_words = int(_covered(_repeated(_triples(ids, len(known))), 3, n).sum())
    worst, fails, share = 0.0, False, {}
    if n:
        upto = np.concatenate([[0], np.cumsum(length)])
        roll = (ids.astype(np.uint64) + np.uint64(1)) * _BASE
        ids64, whole = roll, max(word_chars, 1)
        for k in range(2, max(DUPLICATE) + 1):
            if n < k:
                break
            roll = roll[:-1] * _BASE + (ids64[k - 1 :] ^ (ids64[k - 1 :] >> np.uint64(29)))
            twice = _repeated(roll)
            if not twice.any():
                break
            kinds, first, counts = np.unique(roll[twice], return_index=True, return_counts=True)
            at = np.flatnonzero(twice)[first]
            if k in TOP:
                share[k], limit = min(1.0, float((counts * (upto[at + k] - upto[at])).max()) / whole), TOP[k]
            else:
                twice[at] = False  # the first of each is no repeat
                share[k], limit = float(length[_covered(twice, k, n)].sum()) / whole, DUPLICATE[k]
            worst, fails = max(worst, share[k] / limit), fails or share[k] > limit
    line_share = dup_line_chars / max(word_chars, 1)
    fails = fails or line_share > LINE_CHARS or n_dup_lines > LINES * n_lines
    base_failed = n < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n
    return n, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not fails, line_share, share.get(5, 0.0), share.get(10, 0.0), worst


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, dup_line_share double, dup_5gram_share double, dup_10gram_share double, worst double"


def repetition(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, the verdict and the shares it rests on. See SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = [measure(x.as_py()) for x in batch.column(1)]
            cols = [batch.column(0), *(list(c) for c in zip(*rows, strict=True))] if rows else [batch.column(0), *[[]] * (len(names) - 1)]
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 4
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)

_LIMITS = ", ".join(f"({k}, {v})" for k, v in {**TOP, **DUPLICATE}.items())
#: The verdict of the same rules, with texts compared instead of hashes. Fast enough for small tables only.
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT doc_id, t, w, len(w) AS n, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS chars FROM d),
g AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM b, unnest(range(2, {max(DUPLICATE) + 1})) AS x(k), unnest(range(1, len(w) - k + 2)) AS y(i)),
c AS (SELECT *, count(*) OVER (PARTITION BY doc_id, k, g) AS c, row_number() OVER (PARTITION BY doc_id, k, g ORDER BY i) AS r FROM g),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM c, unnest(range(0, 3)) AS z(j) WHERE k = 3 AND c > 1 GROUP BY doc_id),
top AS (SELECT doc_id, k, max(c * (length(g) - k + 1)) AS x FROM c WHERE k <= {max(TOP)} AND c > 1 GROUP BY doc_id, k),
cov AS (SELECT doc_id, k, sum(length(w[p])) AS x FROM (SELECT DISTINCT doc_id, k, i + j AS p FROM c, unnest(range(0, k)) AS z(j) WHERE k > {max(TOP)} AND r > 1) JOIN b USING (doc_id) GROUP BY doc_id, k),
bad AS (SELECT DISTINCT doc_id FROM (SELECT * FROM top UNION ALL SELECT * FROM cov) JOIN b USING (doc_id) JOIN (VALUES {_LIMITS}) AS v(k, most) USING (k) WHERE least(1.0::double, x::double / greatest(chars, 1)) > most::double),
l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS r FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
s AS (SELECT doc_id, count(*) AS lines, count(*) FILTER (r > 1) AS dup, coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (r > 1), 0) AS x FROM l GROUP BY doc_id),
f AS (SELECT b.doc_id, b.n AS n_words, chars AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(s.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
  bad.doc_id IS NULL AND coalesce(s.x, 0)::double / greatest(chars, 1) <= {LINE_CHARS}::double AND coalesce(s.dup, 0) <= {LINES}::double * coalesce(s.lines, 0) AS fine
  FROM b LEFT JOIN rep USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN bad USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed, NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND fine AS kept FROM f
"""
