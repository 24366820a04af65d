"""Phrases against a plain count, at any budget, number of listed words and passes."""

import re
from collections import Counter

import pytest

from pistespark.llm import collocations


def brute(rows, least, best, covered=collocations.COVERED):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 5):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    f = {k: v for k, v in f.items() if v >= least}
    inside = {}
    for (lang, g), a in f.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                k = (lang, g[i : i + m])
                inside[k] = max(inside.get(k, 0), a)
    out = {}
    for (lang, g), a in f.items():
        if len(g) < 2 or 100 * inside.get((lang, g), 0) >= covered * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), left, right))
    return sorted((lang, i, t[2].decode(), -t[1], t[3], t[4], n[lang], -t[0]) for lang, each in out.items() for i, t in enumerate(sorted(each)[:best], 1))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    import random

    rng = random.Random(5)
    names = ["a", "b", "c", "dé", "E", "fox", " g", "hh"]
    rows = []
    for i in range(300):
        words = [rng.choice(names[: 3 + i % 6]) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " "]) for w in words)
        rows.append((i, text, ["en", "de", None, ""][i % 4]))
    rows += [(900, None, "en"), (901, "", "de"), (902, " .,;", None), (None, "fox fox fox fox fox", "en"), (903, "a b c dé E " * 3000, "en"), (904, "x" * 700_000 + " a b", "en"), (904, "x" * 700_000 + " a b", "en")]
    return rows


@pytest.mark.parametrize("budget,listed,passes", [(1 << 20, 1 << 20, 1), (300, 1 << 20, 3), (50, 4, 2)])
def test_phrases(spark, texts, budget, listed, passes):
    docs = spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, lang string, phrase string").repartition(5)
    got = rows_of(collocations.ranked(docs, best=40, least=8, budget=budget, listed=listed, passes=passes))
    assert got == brute([(lang, text) for _, text, lang in texts], 8, 40)


def test_ties_by_bytes_and_first_cut(spark):
    docs = spark.createDataFrame([(1, "a b. z y. é b. \U0001f600 b. 馬 b. " * 30, "x")], "doc_id long, text string, lang string")
    got = rows_of(collocations.ranked(docs))
    assert got == brute([("x", "a b. z y. é b. \U0001f600 b. 馬 b. " * 30)], 30, 2000)
    assert [r[2] for r in got] == ["z y", "a b", "é b", "馬 b", "\U0001f600 b"]


def test_no_rows(spark):
    assert rows_of(collocations.ranked(spark.createDataFrame([], "doc_id long, text string, lang string"))) == []
    assert rows_of(collocations.ranked(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string"))) == []


@pytest.mark.parametrize("parts", [1, 30])
def test_words_that_share_a_hash_change_the_seed(spark, parts):
    many = [f"w{i}" for i in range(30)]
    alone = lambda seed: len(set(collocations._tokens("x", " ".join(many).encode(), seed, 9)[3].tolist())) == len(many)
    seed = next(s for s in range(100) if alone(s))
    assert seed > 0
    docs = spark.createDataFrame([(i, w, "x") for i, w in enumerate(many)], "doc_id long, text string, lang string").repartition(parts)
    assert collocations.vocabulary(docs, 9)[1] == seed
