"""What is learned rests on distinct rows: copies of a row neither push out others nor count twice."""

import random

import numpy as np

from pistespark.llm import language, toxicity


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 7))) for _ in range(n))


def test_copies_lose_no_language(spark):
    rng = random.Random(1)
    rows = [(i, "en", words(rng, "abcdeth", 30)) for i in range(60)]
    for doc_id in (901, 903, 904, 907):
        docs = spark.createDataFrame(rows + [(doc_id, "de", words(rng, "üßkrz", 30))] * 3000, "doc_id long, lang string, text string").repartition(4)
        assert language.learn(docs, sample=5).languages == (["en"] if language_held_out(doc_id) else ["de", "en"])


def language_held_out(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_copies_leave_the_fit_as_it_is(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, "abcde", 12) + (" vile scum" if i % 3 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    copies = spark.createDataFrame(rows + [rows[1]] * 20_000, "doc_id long, text string")
    a, b = (toxicity.learn(d, labels, sample=300) for d in (plain, copies.repartition(7)))
    assert a.place == b.place and a.place and np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)
