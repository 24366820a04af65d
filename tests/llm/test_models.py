"""Language model, language identification, toxicity, repetition and URL filter."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from pistespark.llm import common, language, language_model, repetition, toxicity, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def held(i, mod):
    return zlib.crc32(("" if i is None else str(i)).encode()) % mod == 2


@pytest.mark.parametrize(("part", "vocabulary", "triples"), [(1 << 24, 65_000, 2_000_000), (1 << 17, 40, 4000)])
def test_language_model(edge, empty, pairs, part, vocabulary, triples):
    """Base figures are exact; the model is better than the base on held-out text; many parts and tasks change no base figure."""
    count = collections.Counter(t for i, x in pairs if not held(i, 7) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), held(i, 7), len(tokens(x)), sum(count[t] > 0 for t in tokens(x)), n, round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(x)), 6)) for i, x in pairs)
    rows = language_model.scores(edge, part, vocabulary, triples).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    total = lambda c: sum(r[c] for r in rows if not r["held_out"])
    assert total("score") > total("base_score")
    assert language_model.scores(empty).count() == 0


def test_language_model_reruns_agree(edge):
    a, b = ({(r["doc_id"], r["n_tokens"], r["score"]) for r in language_model.scores(edge, 1 << 17, 100, 20_000).collect()} for _ in range(2))
    assert a == b


def test_language_model_is_one_however_it_is_dealt(spark):
    """A frequent word's contexts learn from all parts and share one restaurant, however many parts and tasks there are."""
    rnd = random.Random(8)
    follow = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(f"the {follow[min(int(rnd.expovariate(0.1)), 59)]}" for _ in range(60))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole, dealt = ({r["doc_id"]: r["score"] / r["n_tokens"] for r in language_model.scores(df, part, 65_000, triples).collect()} for part, triples in ((1 << 24, 2_000_000), (1 << 12, 80)))
    assert dealt == pytest.approx(whole, abs=0.03)


def test_language_model_learns_every_word(spark):
    """Words beyond the root's own, and words seen less than four times, keep what follows what."""
    rnd = random.Random(6)
    pair = [(f"a{i}", f"b{i}") for i in range(600)]
    rows = [(i, " ".join(" ".join(pair[(3 * i + k) % 600]) for k in rnd.sample(range(9), 9))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    few, all_ = (language_model.scores(df, vocabulary=v).collect() for v in (20, 65_000))
    for out in (few, all_):  # a pair's second word is sure, its first one of 600: half of all tokens cost little
        part = [r for r in out if not r["held_out"]]
        assert sum(r["score"] for r in part) / sum(r["n_tokens"] for r in part) > -1.9


def test_long_words_stay_whole():
    """Windows never cut a word, whatever white space parts the words."""
    for text in ("Ab9é" * 500_000, "\r".join(f"word{i}" for i in range(300_000)), "x" * (1 << 19) + "\v" + "y" * 9, "x " * (1 << 18) + "tail", "z" * ((1 << 19) - 1) + "\f" + "q"):
        want, got = WORD.findall(text), language_model.words(text)
        assert len(got) == len(want) + 1
        assert got[0] == language_model.words("a " + want[0])[1] and got[-2] == language_model.words("a " + want[-1])[1]
    assert len({int(language_model.words("x" * n)[0]) for n in (9, 2_000_000, 2_000_001)}) == 3
    assert language_model.words("a " + "X" * 2_000_000)[1] == language_model.words("x" * 2_000_000 + " b")[0]


def test_seatings_give_a_distribution():
    """Over all words, the predictive probabilities of every context add up to one."""
    rng = np.random.default_rng(3)
    dishes = 30
    b, a, w = (rng.integers(0, k, 3000) for k in (4, 6, dishes))
    every = np.stack(np.meshgrid(np.arange(4), np.arange(6), np.arange(dishes), indexing="ij")).reshape(3, -1)
    key = lambda x: (x[0] << 32 | x[1] << 16 | x[2]).astype(np.uint64)
    kinds, n = np.unique(key(np.stack([b, a, w]).astype(np.int64)), return_counts=True)
    keys = np.sort(key(every.astype(np.int64)))
    count = np.zeros(len(keys), np.int64)
    count[np.searchsorted(keys, kinds)] = n
    r = language_model.Restaurants(keys, count)
    root = language_model.root_table(rng.integers(0, 50, dishes), dishes)
    assert root.sum() == pytest.approx(1)
    for _ in range(3):
        r.sweep(root, rng)
        assert ((r.t >= np.minimum(count, 1)) & (r.t <= count)).all() and (r.t2 <= r.n2).all()
    sums = np.bincount(r.context, r.predictive(root))
    assert sums == pytest.approx(np.ones(24))


def test_stirling_numbers():
    s = np.exp(language_model.stirling(0.0, 5))
    assert s[4, 1:5] == pytest.approx([6, 11, 6, 1])  # without a discount: those of the first kind


def text(rnd, letters, n):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(n))


def test_language(spark, edge, empty):
    rnd = random.Random(1)
    kinds = {"aa": "abcde ", "bb": "cdefg", "cc": "çéàbc", "d" * 3: "жзик"}
    rows = [(i, text(rnd, kinds[k], rnd.randint(3, 40)), k if i % 5 else None, k) for i, k in enumerate(list(kinds) * 60)]
    rows += [(900, None, "aa", "-"), (901, "", "bb", "-"), (902, "12 !?", None, "-"), (None, "abba dad", "aa", "aa"), (903, "中文", None, "-")]
    out = language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string, kind string")).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert [by[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    tested = [(by[i]["lang_pred"], k) for i, _, _, k in rows if i is not None and i < 900 and held(i, 4)]
    assert sum(a == b for a, b in tested) / len(tested) > 0.95
    assert all(r["held_out"] == held(r["doc_id"], 4) for r in out)
    assert {r["lang_pred"] for r in language.languages(edge).collect()} <= {"en", "de", "fr", "und"}
    assert language.languages(empty).count() == 0
    assert {r["lang_pred"] for r in language.languages(edge.withColumn("lang", edge["lang"].substr(9, 1)).filter("lang IS NULL")).collect()} <= {"und"}


def test_ngrams_do_not_depend_on_slices():
    text_ = "Ab, çd  efg--ΣΑΣ 中文x\n" * 37 + "1 2 3" + "z" * 50
    want = np.sort(language.ngrams(text_))
    for size in (1, 2, 3, 5, 7, 64, 1000):
        assert (np.sort(np.concatenate(list(language.grams(text_, size=size)))) == want).all()
    plain_ = " " + re.sub(r"[^a-z]+", " ", "ab, cd!e") + " "
    assert len(language.ngrams("ab, cd!e")) == sum(len(plain_) - n + 1 for n in (2, 3, 4))


def test_slices_cut_no_word():
    for data in (b"x" * 5000, b"\r".join(b"word%d" % i for i in range(999)), b"a" * 100 + b"\v" + b"b" * 3000 + b"\f\f c", b"", b" " * 500):
        parts = list(common.slices(data, 64))
        assert b"".join(parts) == data and [w for p in parts for w in p.split()] == data.split()


def test_samples_are_by_row_and_bounded(spark):
    """4,000 rows of one id: each is as likely to be learned as any other, and no more than the sample; repeated rows count once."""
    rnd = random.Random(3)
    for id_ in (5, 6):
        rows = [(id_, text(rnd, "жзик", 5), "ru") for _ in range(400)] + [(1000 + i, text(rnd, "abcde", 5), "en") for i in range(400)]
        f = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=50)
        assert f.languages == (["en", "ru"] if not held(id_, 4) else ["en"])
    docs = spark.createDataFrame([(1, f"w{i} bad{i % 2}") for i in range(500)] + [(1, "same bad1")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    a = toxicity.learn(docs, labels, sample=40)
    b = toxicity.learn(docs.repartition(7), labels, sample=40)
    assert a.w0 == b.w0 and (a.w == b.w).all()


def test_filters_return_every_language_of_an_ngram():
    rng = np.random.default_rng(2)
    grams = {f"l{i:02d}": rng.integers(0, 2**63, 500, dtype=np.uint64) for i in range(11)}
    f = language.Filters.built(grams)
    for i, name in enumerate(f.languages):
        at = list(f.places(grams[name]))
        masks = np.bitwise_and.reduce([f.table[i // 8][x] for x in at])
        assert ((masks >> (i % 8)) & 1).all()
    assert (f.rates < 0.01).all()


def test_factorization_machine_learns_a_pair():
    """Either term alone is harmless; only both together count. No linear weights separate that from the two alone."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, (4000, 6)).astype(np.uint8)
    y = (x[:, 0] == x[:, 1]).astype(float)
    w0, w, v = toxicity.fit(x, y)
    s = x @ v
    z = w0 + x @ w + 0.5 * ((s**2).sum(1) - x @ (v**2).sum(1))
    assert ((z > 0) == (y > 0)).mean() > 0.97


def test_toxicity(spark, edge, empty):
    rnd = random.Random(6)
    bad = ["blorg", "snarfen", "snarfing", "zug"]
    rows = []
    for i in range(600):
        w = [f"w{rnd.randrange(300)}" for _ in range(rnd.randint(5, 60))]
        if i % 7 == 0:
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        rows.append((i, " ".join(w), int(i % 7 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(800, None), (801, ""), (None, "BLORG!"), (802, "snarfoo")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 3] + [(800, None, None), (None, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    out = toxicity.scores(docs, labels).collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == 604 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert all(by[i]["predicted"] == y for i, _, y in rows if held(i, 4))
    assert by[None]["predicted"] == 1 and by[800]["predicted"] == 0 and by[801]["predicted"] == 0
    kept = toxicity.clean(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out if not r["predicted"]}
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.scores(edge, none).collect()} == {0.0}
    assert toxicity.clean(edge, none).count() == edge.count() and toxicity.scores(empty, labels).count() == 0


def plain(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    c = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) for k in range(3) if c[tuple(w[i : i + 3])] > 1}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_repetition(spark, edge, empty, pairs):
    rnd = random.Random(8)
    more = [(5000 + i, "\n".join(rnd.choice(["a b c d", "e #f% g", " ", "h i j", "<k> l|m"]) for _ in range(rnd.randint(1, 40)))) for i in range(40)]
    df = edge.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), *tuple(r)[1:7]) for r in repetition.repetition(df).collect())
    assert got == sorted((str(i), *plain(t)) for i, t in [*pairs, *more])
    assert repetition.repetition(empty).count() == 0
    good = " ".join(f"w{i}" for i in range(200))
    assert repetition.measure(good)[6] and not repetition.measure(good + " " + " ".join(["one two three four five six"] * 20))[6]
    assert not repetition.measure("\n".join([good[:300]] * 3))[6]


def test_wide_vocabulary_triples():
    ids = np.array([0, 1, 2, 0, 1, 2, 5])
    assert (repetition._repeated(repetition._triples(ids, 8)) == repetition._repeated(repetition._triples(ids, 1 << 22))).all()


def test_url_filter(spark):
    c = duckdb.connect()
    for t in ("pages", "labels"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
    got = url_filter.verdicts(read("pages"), url_filter.labelled(read("labels"))).collect()
    cols = ["page_id", "host", "path", "rule", "verdict", "n_labelled"]
    want = c.sql(f"SELECT {', '.join(cols)} FROM ({url_filter.SQL})").fetchall()
    assert sorted(map(str, (tuple(r[k] for k in cols) for r in got))) == sorted(map(str, want))


def test_url_filter_cases(spark):
    urls = {1: "http://A.Example.COM/en/7x?q#f", 2: "https://x.com/en/1", 3: "//nothing", 4: None, 5: "a://b://c/d", 6: "http://net/de/8", 7: "http://example.net/de/81", 8: "http://host", 9: "HTTP://h.org?/es/", 10: "http://u.org/es/", 11: "http://xcom/en/"}
    pages = spark.createDataFrame([(k, u, "h", 1) for k, u in urls.items()] + [(None, "http://bad.test/x", "h", 1)], "page_id long, url string, host string, n int")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.verdicts(pages, url_filter.labelled(labels)).collect()}
    assert out[1] == ("a.example.com", "/en/7x", "example.com/en/7", "allow") and out[2] == ("x.com", "/en/1", "com/en/", "block")
    assert out[3][:3] == out[4][:3] == ("", "", None) and out[5][:2] == ("b:", "//c/d") and out[6][2:] == ("net/de/", "allow") and out[7][2:] == ("example.net/de/8", "block")
    assert out[8][:2] == ("host", "") and out[9][:3] == ("h.org", "", None) and out[10][3] == "block" and out[11][2] is None and len(out) == 12
    assert url_filter.verdicts(pages.limit(0), url_filter.labelled(labels)).count() == 0
    assert {r["verdict"] for r in url_filter.verdicts(pages, url_filter.labelled(labels.limit(0))).filter("rule IS NULL").collect()} == {"allow"}


def test_reputation_shrinks(spark):
    hosts = [(f"h{i}.bad.co.uk", 20, 20) for i in range(10)] + [("new.bad.co.uk", 0, 0), ("one.good.org", 1, 1)] + [(f"g{i}.good.org", 40, 1) for i in range(20)]
    got = {r["host"]: r for r in url_filter.reputation(spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
    assert got["h1.bad.co.uk"]["bound"] > 0.5 and got["new.bad.co.uk"]["mean"] > 0.5 > got["one.good.org"]["bound"]


def test_url_rules_are_those_of_the_contract(spark):
    """Every rule's word, also where labels would block the host: a net/de/ page is allowed, but for example.net/de/8."""
    want = {"com/en/": "block", "example.com/en/7": "allow", "net/de/": "allow", "example.net/de/8": "block", "org/es/": "block"}
    assert {h + p: v for h, p, v in url_filter.RULES} == want
    pages = spark.createDataFrame([(i, f"http://www.{rule}x") for i, rule in enumerate(want)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 1) for i in range(5)], "doc_id long, quality int, toxic int")
    assert {r["rule"]: r["verdict"] for r in url_filter.verdicts(pages, url_filter.labelled(labels)).collect()} == want
    c = duckdb.connect()
    c.sql("CREATE TABLE labels AS SELECT range doc_id, 0 quality, 1 toxic FROM range(5)")
    c.sql("CREATE TABLE pages AS " + " UNION ALL ".join(f"SELECT {i} page_id, 'http://www.{rule}x' url" for i, rule in enumerate(want)))
    assert dict(c.sql(f"SELECT rule, verdict FROM ({url_filter.SQL})").fetchall()) == want
