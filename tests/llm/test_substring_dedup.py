"""Repeated passages of words against brute force, whatever the sizes of parts and ranges."""

import hashlib
import random

import pytest

from pistespark.llm import substring_dedup as op


def brute(rows):
    far = (1 << 63) - 1
    first = {}
    each = [(i if i is not None else far, (t or "").encode().split()) for i, t in rows]
    for doc, w in each:
        for s in range(len(w) - 12):
            k = tuple(w[s : s + 13])
            first[k] = min(first.get(k, far), doc)
    out = []
    for (i, _), (doc, w) in zip(rows, each, strict=True):
        gone = set()
        for s in range(len(w) - 12):
            if first[tuple(w[s : s + 13])] < doc:
                gone.update(range(s, s + 13))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé馬") for _ in range(rng.randrange(1, 5)))
    shared = [[word() for _ in range(n)] for n in (13, 14, 20, 60, 300, 12)]
    rows = []
    for i in range(220):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            parts += [word() for _ in range(rng.randrange(0, 30))]
            if rng.random() < 0.5:
                p = rng.choice(shared)
                at = rng.randrange(0, len(p) - 8)
                parts += p[at:] if rng.random() < 0.5 else p
        rows.append((i * 7 % 300, rng.choice([" ", "  ", "\n", "\t "]).join(parts)))
    rows += [(1000 + i, "the same long line of text that a third of all rows hold " * 3) for i in range(60)]
    rows += [(None, None), (None, rows[3][1]), (None, rows[3][1]), (2000, ""), (2001, "x y z"), (2002, "b" * 600_000 + " " + " ".join(shared[2])), (2003, "b" * 600_000 + " " + " ".join(shared[2]))]
    rows += [(2004, "a a a a a a a a a a a a a a a a a a a a"), (2005, "a " * 13), (2005, "a " * 13), (2005, "a " * 15), (5, rows[0][1]), (5, rows[0][1])]
    return rows


@pytest.mark.parametrize("part,ranges", [(8 << 20, 1 << 20), (3000, 50)])
def test_repeats(spark, part, ranges):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, kept string, doc int").repartition(7)
    have = got(op.deduplicated(docs, part, ranges))
    assert have == brute(rows)
    assert sum(r[2] for r in have) > 1000


def test_tasks_that_fold_often(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(op, "FLUSH", 200)
    assert got(op.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_cover_meets_at_every_shift():
    for d in range(op.PERIOD):
        assert any((s % op.PERIOD in op.COVER) and ((s + d) % op.PERIOD in op.COVER) for s in range(op.PERIOD))


def test_no_rows(spark):
    assert got(op.deduplicated(spark.createDataFrame([], "doc_id long, text string"))) == []
