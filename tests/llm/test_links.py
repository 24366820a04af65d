"""Links with sketches: a group that stays large is searched whole, and no candidate is lost where the forest's pair is no link."""

import random

import numpy as np

from pistespark.llm import simhash


def test_far_ends_of_a_dense_group_are_linked(spark):
    # equal fingerprints, so no level parts them; only nodes i and i + 40 have equal sketches, which windows of 16 rows never see together
    rng = np.random.default_rng(5)
    sketch = [np.packbits(np.concatenate([np.ones(simhash.BINS, bool), rng.random(simhash.BINS) < 0.5])).tobytes() for _ in range(40)]
    nodes = spark.createDataFrame([(i, 7, bytearray(sketch[i % 40])) for i in range(80)], "node long, fp long, sketch binary")
    got = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in simhash.links(nodes, 3, 8, 1).collect() if r["similarity"] >= simhash.SURE}
    assert got == {(i, i + 40) for i in range(40)}


def test_known_gives_all_candidates_in_pieces():
    rng = np.random.default_rng(2)
    n = 120
    fp, group, known = rng.integers(0, 4, n).astype(np.uint64), rng.integers(0, 3, n), rng.integers(0, 9, n)
    filled, bits = np.ones((n, simhash.BINS), bool), np.tile(rng.random(simhash.BINS) < 0.5, (n, 1))
    bits ^= rng.random(bits.shape) < 0.06
    sketch = np.packbits(np.concatenate([filled, bits], axis=1), axis=1).view(np.uint64)
    i, j = np.triu_indices(n, 1)
    s = simhash.similarity(sketch[i], sketch[j])
    use = (group[i] == group[j]) & (known[i] != known[j]) & (s >= simhash.MAYBE) & (s < simhash.SURE)
    assert 100 < use.sum() < len(i)
    pieces = list(simhash.linked_pieces(group, fp, 6, 8, 50, sketch, known))
    assert len(pieces) > 1
    a, b, _ = simhash.linked(group, fp, 6, room=50, sketch=sketch, known=known)
    assert sorted(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True)) == sorted(zip(i[use].tolist(), j[use].tolist(), strict=True))


def triple():
    """Three texts: the first two are sure copies, the third is a link of the second only, but its estimate is greater with the first."""
    rnd = random.Random(1)
    for _ in range(2000):
        texts = [[f"w{rnd.randrange(5000)}" for _ in range(300)]]
        for n in (1, rnd.randint(6, 7)):
            texts.append(list(texts[-1]))
            for _ in range(n):
                texts[-1][rnd.randrange(300)] = f"x{rnd.randrange(5000)}"
        made = [simhash.codes(" ".join(t), {}) for t in texts]
        near = all(min((made[i][c] ^ made[j][c]).bit_count() for c in (0, 1)) <= simhash.WIDE_K for i, j in ((0, 1), (0, 2), (1, 2)))
        sets = [{" ".join(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
        true = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])  # noqa: E731, B023
        sketch = np.frombuffer(b"".join(m[2] for m in made), np.uint64).reshape(3, -1)
        first, second, both = simhash.similarity(sketch[[0, 1, 0]], sketch[[2, 2, 1]])
        if near and both >= simhash.SURE and true(0, 2) < simhash.SIMILAR <= true(1, 2) and simhash.MAYBE <= second < first < simhash.SURE:
            return [" ".join(t) for t in texts]
    raise AssertionError("none found")


def test_a_link_is_kept_beside_a_greater_estimate_that_is_none(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*triple(), "some other text"])], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keepers(df).collect()) == [0, 3]
