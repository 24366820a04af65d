import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars int, part int, size string, node long, score string, keep_id string, count double"
#: Names that operators use inside.
CLASH = ["_id", "_hash", "_parts", "_r", "_sha", "_n", "_whole", "_h", "_k", "id", "hash", "from", "parts", "key", "points", "src", "words", "row", "toxic", "text_hash", "salt", "_row"]
DDL += ", " + ", ".join(f"`{c}` string" for c in CLASH)


def words(rnd, n, kinds=400):
    return " ".join(f"w{rnd.randrange(kinds)}" for _ in range(n))


def edge_rows():
    """Documents with every odd case, and columns whose names operators use themselves."""
    rnd = random.Random(7)
    base = [words(rnd, rnd.randint(20, 90)) + ".\n" + words(rnd, 5) + "." for _ in range(25)]
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 4}") for i, t in enumerate(base)]
    rows += [(100 + i, base[i].replace(" ", "\n "), "en", "s0") for i in range(5)]  # equal but for white space
    rows += [(200 + i, base[i] + " w9", "en", "s1") for i in range(5)]
    rows += [(300, None, "en", "s0"), (301, "", None, None), (302, " \t\n", "en", "s2"), (303, "...", "en", ""), (304, "one", "en", "tiny"), (305, "two words", None, "tiny")]
    rows += [(None, base[3], "en", None), (None, "no id here at all", None, "s3"), (7, base[7], "en", "s3"), (7, base[7], "en", "s3"), (7, "another text of seven", "de", "s3")]
    rows += [(400, words(rnd, 30_000, 5000), "en", "s2"), (401, "x" * 300_000, "en", "s2"), (402, "é☃ñ " * 500, "fr", "s2"), (403, "ab" * 200, None, "s1")]
    return [(i, t, la, s, None if t is None else len(t), 1, "x", 2, "y", "z", 0.5, *CLASH) for i, t, la, s in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DDL).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def pairs():
    """(doc_id, text) of the edge documents."""
    return [(r[0], r[1]) for r in edge_rows()]
