"""Mixing, packing and the pipeline."""

import itertools
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pistespark.llm import mixing, packing, queries
from pistespark.shared import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets():
    got = {s: t for s, _, t in mixing.targets([("b", 100), ("a", 100), (None, 100), ("c", 1)])}
    assert got["a"] + got["b"] + got["c"] + got[None] == pytest.approx(301)
    assert got["c"] == 3 and got["a"] / got["b"] == pytest.approx(5 / 2) and got[None] / got["a"] == pytest.approx(1)  # weights 5, 2, 1, 5
    assert mixing.targets([]) == [] and mixing.targets([("a", 0)]) == [("a", 0, 0.0)]
    assert all(t <= 3 * n + 1e-9 for _, n, t in mixing.targets([(f"s{i}", 10 * i) for i in range(9)]))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000])
def test_permutations(spark, n):
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("x")).collect()
    assert sorted(r["x"] for r in got) == list(range(n))


@pytest.mark.parametrize("block", [64, 7])
def test_mix(edge, empty, pairs, block):
    rows = mixing.taken(edge, block).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(i), len(WORD.findall(t or ""))) for i, t in pairs)
    assert rows and sorted(map(str, rows)) == sorted(map(str, mixing.taken(edge, block).collect()))
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    placed, slots = mixing.mix(edge, block)
    sources = {r["src"]: r for r in placed.select("src", "source", "source_size", "target").distinct().collect()}
    words = {r["src"]: r["n"] for r in mixing.pieces(placed, slots, block).groupBy("src").agg(F.sum("words").alias("n")).collect()}
    assert None in {r["source"] for r in sources.values()}
    for s, r in sources.items():
        assert abs(words.get(s, 0) - r["target"]) <= 0.5 + 1e-9 and words.get(s, 0) <= 3 * r["source_size"]
    assert mixing.taken(empty, block).count() == 0 and mixing.mixed(empty).count() == 0


def test_taken_equals_brute_force(spark):
    """What each document gives, counted word by word from the documents' places and the slots; small sources meet their targets."""
    rows = [(i, " ".join(f"w{k}" for k in range(37 * i % 150 + (i > 3))), f"s{i % 23:02d}") for i in range(60)] + [(None, "no id", "s01"), (9, "twice", "s02"), (9, "twice", "s02"), (9, "other text", "s02")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    placed, slots = mixing.mix(df, 16, 8)
    drawn, got = defaultdict(Counter), Counter()
    for r in slots.collect():
        for k in range(r["take"]):
            drawn[r["src"]][r["block"] * 16 + k] += 1
    for r in placed.collect():
        got[str(r["doc_id"]), r["size"]] += sum(drawn[r["src"]][r["offset"] + k] for k in range(r["size"]))
    made = Counter()
    for r in mixing.taken(df, 16).collect():
        made[str(r["doc_id"]), r["size"]] += r["taken"]
    want = {s: t for s, _, t in mixing.targets([(s, sum(len(WORD.findall(t)) for _, t, o in rows if o == s)) for s in {r[2] for r in rows}])}
    sums = defaultdict(int)
    for r in placed.select("src", "source").distinct().collect():
        sums[r["source"]] = sum(n for at, n in drawn[r["src"]].items() if at < sum(len(WORD.findall(t)) for _, t, o in rows if o == r["source"]))
    assert {s: abs(sums[s] - t) <= 0.5 + 1e-9 for s, t in want.items()} == dict.fromkeys(want, True)
    each = slots.groupBy("src", "epoch").agg(F.count("*").alias("n"), F.countDistinct("block").alias("kinds")).collect()
    assert all(r["n"] == r["kinds"] for r in each)
    assert sum(got.values()) == sum(made.values()) and {k: v for k, v in got.items() if k[0] != "9"} == {k: v for k, v in made.items() if k[0] != "9"}


def test_shards_are_multinomial_draws_with_exact_totals(spark):
    plan = [{"src": i, "n": n} for i, n in enumerate([40_000, 0, 20_000, 3_000, 1])]
    rows = mixing.shards(spark.createDataFrame([], "x int"), plan, 500, 3).collect()
    counts, seen = defaultdict(Counter), defaultdict(list)
    for r in rows:
        counts[r["shard"]][r["src"]] += r["n"]
        seen[r["src"]] += range(r["first"], r["first"] + r["n"])
    assert {s: sorted(x) for s, x in seen.items()} == {x["src"]: list(range(x["n"])) for x in plan if x["n"]}
    assert all(sum(c.values()) == 500 for s, c in counts.items() if s != max(counts))
    share = 20_000 / 63_001
    spread = [c[2] for s, c in counts.items() if s != max(counts)]
    var = sum((x - 500 * share) ** 2 for x in spread) / len(spread)
    assert 0.6 < var / (500 * share * (1 - share)) < 1.6  # as independent draws spread, and not as a fixed share would


def test_mixed_texts(edge):
    docs = edge.filter("doc_id IS NOT NULL AND doc_id <> 7")
    want = {r["doc_id"]: r["taken"] for r in mixing.taken(docs).collect() if r["taken"]}
    out = mixing.mixed(docs)
    got = Counter()
    source = {r["doc_id"]: WORD.findall(r["text"] or "") for r in docs.collect()}
    for r in out.collect():
        words = WORD.findall(r["text"])
        got[r["doc_id"]] += len(words)
        assert r["n_chars"] == len(r["text"]) and not Counter(words) - Counter(source[r["doc_id"]])
    assert got == want and out.columns == docs.columns


def test_bounds_are_optimal():
    counts = {3: 5, 4: 1, 7: 9, 8: 2, 12: 4, 20: 1, 21: 3}
    lengths = sorted(counts)
    pad = lambda tops: sum(c * (min(t for t in tops if t >= n) - n) for n, c in counts.items())
    for k in range(1, 8):
        got = packing.bounds(counts, k)
        assert len(got) <= k and pad(got) == min(pad([*some, 21]) for some in itertools.combinations(lengths[:-1], k - 1))
    assert packing.bounds({}) == [] and packing.bounds({0: 4}) == []


def test_packed(edge, empty, pairs):
    rows = packing.packed(edge, max_len=100, buckets=4, budget=300).collect()
    total = Counter()
    for r in rows:
        total[str(r["doc_id"])] += r["n_tokens"]
    want = Counter()
    for i, t in pairs:
        want[str(i)] += len(WORD.findall(t or ""))
    assert +total == +want and len({r["bound"] for r in rows if r["n_tokens"]}) <= 4
    batches = defaultdict(list)
    for r in rows:
        if r["n_tokens"] == 0:
            assert r["batch"] is None and r["bucket"] is None
            continue
        assert r["n_tokens"] + r["padding"] == r["bound"]
        batches[r["batch"]].append(r)
    for b in batches.values():
        assert len({r["bucket"] for r in b}) == 1 and len(b) * b[0]["bound"] <= max(300, b[0]["bound"])
        assert sorted(r["slot"] for r in b) == list(range(len(b)))
    assert sorted(batches) == list(range(len(batches)))
    assert packing.packed(empty).count() == 0


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    n = docs.count()
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf)
    gone = {r["doc_id"] for r in docs.select("doc_id").subtract(clean.select("doc_id")).collect()}
    assert sum(labels.get(i, 1) == 0 for i in gone) <= 1
    once = stages["exact_dedup"](spark, clean, sf)
    assert once.count() == len({re.sub(r"[\x20\x09-\x0D]", "", r["text"]) for r in clean.collect()})
    near = stages["near_dedup"](spark, once, sf)
    mixed = stages["mixing"](spark, near, sf)
    assert n >= clean.count() >= once.count() >= near.count() > 0.7 * once.count()
    assert clean.columns == once.columns == near.columns == mixed.columns == docs.columns
    assert set(clean.dtypes) == set(docs.dtypes) == set(mixed.dtypes)
    out = corpus_pipeline.run(spark, sf)
    assert out.agg(F.sum("n_tokens")).first()[0] == pytest.approx(sum(len(WORD.findall(r["text"])) for r in near.collect()), rel=0.02)


def test_pipeline_on_odd_rows(spark, edge, empty):
    """All stages in a chain: nulls, blank and very long texts, repeated ids and rows, columns of any name; and an empty table."""
    sf = "/root/testdata/sf0.001"
    docs, kept = edge.unionByName(edge.filter("doc_id < 3")), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), name)
        assert docs.columns == edge.columns and docs.dtypes == edge.dtypes
        kept.append(docs.count())
    assert kept[1] == docs_of(edge) and kept[2] <= kept[1]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.count() >= kept[3] > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def docs_of(edge):
    return len({re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in edge.select("text").collect()})


def test_queries_are_registered():
    assert [k.split("_")[0] for k in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_many_sources(spark):
    """Sources by the thousand, one of them with a third of all rows: the plan is a table, and each meets its target."""
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id").cast("string")))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 90).cast("int")).alias("text"), source.alias("source"))
    rows = mixing.taken(df).collect()
    words, target = Counter(), {}
    for r in rows:
        key = "hot" if r["doc_id"] % 3 == 0 else r["doc_id"]
        words[key] += r["taken"]
        target[key] = r["target"]
    assert len(rows) == 3000 and len(target) == 2001
    assert all(abs(words[k] - t) <= 0.5 + 1e-9 for k, t in target.items()) and all(r["taken"] <= 3 * r["size"] for r in rows)
