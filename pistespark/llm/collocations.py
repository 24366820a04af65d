"""Phrases of two to four words that hold together, from truncated suffix trees built group by group.

The corpus is too long for one suffix tree, so it is split vertically: by what suffixes begin with.

1. *Words.* All words are counted. The most frequent ones (at most LISTED, which is what bounds the broadcast) get small
   numbers. Words that come less than LEAST times cannot be in a phrase that counts: they end a stretch, as a mark does. Of
   words that are frequent and yet not listed, each keeps the 63-bit hash of its language and itself, and no two words of
   the corpus may share one; if two do, the hash is changed and the count repeated. The texts become a table of numbers.
2. *Prefixes.* A suffix is the next four words. All suffixes that begin with one word belong to that prefix; a prefix with
   more suffixes than ``budget`` is extended by a word, and again, up to four. A suffix of four words is
   counted before it is sent, so a phrase on every other page costs a row per task. The prefixes that were extended are
   at most (words / budget) for each length, and are all that tasks need to know of them.
3. *Groups.* The prefixes of one length are put in the order of a hash and grouped by their counts up to the budget, so a
   group is a range of hashes that any task can tell. Bins of hashes, some 16 a group, carry the counts to the driver.
4. *Subtrees.* Each group's suffixes are sorted by themselves, no other group being needed: the nodes of its subtree are the
   runs that share their first words, and a node's count is the sum of its leaves. Groups go in PASSES passes, each
   ending in a table, so that only a part of the suffixes is in the shuffle at a time.
5. *Scores.* Counts of parts and of longer phrases come by joins on the phrases. Keys as common as "the" are split by AQE.

``phrases`` returns all candidates; ``ranked`` the best of each language. Counts are exact and scores whole numbers
of decimals, so sizes beyond 64 bits do no harm.

Defined results: null text is the empty text; a null lang is ``und``; only A-Z are lower-cased; a word is one however long it
is; repeated rows count each; doc_id is not used; extra columns are ignored; an empty table gives no rows. Ties go by phrase,
in the order of its UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pistespark.llm import words
from pistespark.shared import settled, spread_join

LEAST, LONGEST, BEST, COVERED, SCALE = 30, 4, 2000, 80, 2_000_000
LISTED, BUDGET, PASSES = 1 << 20, 1 << 20, 2
#: Bytes of text at which a task folds what it holds; codes in a row of the table of numbers.
FLUSH, CODES = 16 << 20, 1 << 17
_U = np.uint64
_BREAK = words.table(b".,;:!?\x0a\x0b\x0c\x0d")
_STOP = _BREAK | words.table(b"\x20\x09")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _tokens(lang: str, text: bytes, seed: int, bits: int = 63, n_hashes: int = 1) -> tuple[np.ndarray, ...]:
    """(bytes in lower case, starts, ends, hashes of language and word, other hashes of the word, whether a word and the one before it are in one piece)."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    start, end, (h, *other) = words.hashed(data, _STOP[data], 2 if seed else n_hashes)
    if seed:
        h = words.mixed(h + other[0] * _U(seed))
    own = _U(xxhash.xxh64_intdigest(lang, seed=seed))
    marks = np.cumsum(_BREAK[data])
    piece = marks[start] if len(start) else start
    near = np.concatenate([[False], piece[1:] == piece[:-1]]) if len(start) else np.zeros(0, bool)
    return data, start, end, words.mixed(h ^ own) >> _U(64 - bits), other[0] if other else h, near


_WORD = {"h": pa.int64(), "lang": pa.string(), "word": pa.string(), "n": pa.int64()}


def _batch(kinds: dict[str, pa.DataType], *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def _counted(docs: DataFrame, seed: int, bits: int) -> DataFrame:
    """(h, lang, word, n, clash): all words of all languages; clash where two share a hash."""

    def folded(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        by: dict[str, list[tuple]] = {}
        for lang, *rest in held:
            by.setdefault(lang, []).append(rest)
        for lang, each in by.items():
            h, other = (np.concatenate([x[k] for x in each]) for k in (3, 4))
            order = np.argsort(h, kind="stable")
            start = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])) if len(h) else np.zeros(0, np.int64)
            n, first = np.diff(np.append(start, len(h))), order[start]
            if len(h):  # a hash with two words sends a word of either kind
                o = other[order]
                two = np.flatnonzero(np.minimum.reduceat(o, start) != np.maximum.reduceat(o, start))
                more = np.array([order[start[i] : start[i] + n[i]][(o[start[i] : start[i] + n[i]] != o[start[i]]).argmax()] for i in two], np.int64)
                n, first = np.concatenate([n, np.zeros(len(more), np.int64)]), np.concatenate([first, more])
            ends = np.cumsum([len(x[3]) for x in each])
            doc = np.searchsorted(ends, first, "right")
            place = first - np.concatenate([[0], ends[:-1]])[doc]
            texts = [each[d][0][each[d][1][p] : each[d][2][p]].tobytes() for d, p in zip(doc, place, strict=True)]
            for at in range(0, len(first), 1 << 16):
                s = slice(at, at + (1 << 16))
                m = len(first[s])
                yield _batch(_WORD, h[first[s]].view(np.int64), [lang] * m, pa.array(texts[s], pa.binary()).cast(pa.string()), n[s])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = words.raw(text)
                held.append((lang, *_tokens(lang, raw, seed, bits, 2)[:5]))
                size += len(raw)
                if size >= FLUSH:
                    yield from folded(held)
                    held, size = [], 0
        yield from folded(held)

    rows = _texts(docs).mapInArrow(run, "h long, lang string, word string, n long")
    named = rows.groupBy("h").agg(F.min(F.struct("lang", "word")).alias("a"), F.max(F.struct("lang", "word")).alias("b"), F.sum("n").alias("n"))
    return named.select("h", "a.lang", "a.word", "n", (F.col("a") != F.col("b")).alias("clash"))


def _texts(docs: DataFrame) -> DataFrame:
    """lang, text; an empty lang stays one, a null is ``und``."""
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def vocabulary(docs: DataFrame, bits: int = 63) -> tuple[DataFrame, int]:
    """(h, lang, word, n) of all words, and the seed under which each has a hash of its own. Fewer bits serve the tests."""
    for seed in range(100):
        found = settled(_counted(docs, seed, bits), "words")
        if found.filter("clash").isEmpty():
            return found.drop("clash"), seed
    raise ValueError("no seed keeps all words apart")


def _numbered(docs: DataFrame, hashes: np.ndarray, numbers: np.ndarray, all_listed: bool, seed: int) -> DataFrame:
    """The texts as ``codes``: packed numbers of words, stretches of countable words being parted by 0."""
    shared = docs.sparkSession.sparkContext.broadcast((hashes, numbers))

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        codes = np.concatenate(held)
        kind = "<i4" if len(codes) == 0 or (codes.min() >= 0 and codes.max() < 1 << 31) else "<i8"
        block = zstandard.ZstdCompressor(level=1).compress(codes.astype(kind).tobytes())
        return _batch({"wide": pa.bool_(), "codes": pa.binary()}, [kind == "<i8"], [block])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shared.value
        held, size = [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _, _, _, h, _, near = _tokens(lang, words.raw(text), seed)
                if not len(h) or not len(known):
                    continue
                h = h.view(np.int64)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                code = np.where(known[at] == h, number[at], 0 if all_listed else -1 - h)
                # a 0 where a piece begins, and one for each word that does not count; of a run of 0 one stays
                wide = np.zeros(2 * len(code) + 1, np.int64)
                wide[1:-1:2] = code
                keep = np.zeros(len(wide), bool)
                keep[1:-1:2] = True
                keep[0:-1:2] = ~near
                keep[-1] = True
                codes = wide[keep]
                codes = codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]
                held.append(codes)
                size += len(codes)
                if size >= CODES:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return _texts(docs).mapInArrow(run, "wide boolean, codes binary")


def _unpacked(wide: bool, block: bytes) -> np.ndarray:
    out = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), "<i8" if wide else "<i4").astype(np.int64)
    return np.concatenate([out, np.zeros(LONGEST, np.int64)])


def _suffixes(codes: np.ndarray) -> np.ndarray:
    """The suffixes of at least two words, LONGEST columns of codes, 0 after an end."""
    at = np.flatnonzero((codes[:-LONGEST] != 0) & (codes[1 : len(codes) - LONGEST + 1] != 0))
    out = codes[at[:, None] + np.arange(LONGEST)]
    for k in range(2, LONGEST):
        out[:, k] *= out[:, k - 1] != 0
    return out


def _keys(suffixes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the first words."""
    out = np.full(len(suffixes), _U(length), np.uint64)
    for k in range(length):
        out = words.mixed(out * _U(words.BASES[0]) + suffixes[:, k].view(np.uint64))
    return out


class Groups:
    """Which group a suffix goes to. ``hot``: by length, the sorted hashes of prefixes that are extended; ``ends``: by length,
    the last hash of each group. Both are bounded by (words / budget) for each length."""

    def __init__(self) -> None:
        self.hot: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []

    def place(self, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(group, length of its prefixes); group -1 where the prefix is not yet grouped."""
        group, length = np.full(len(suffixes), -1, np.int64), np.zeros(len(suffixes), np.int64)
        left, base = np.arange(len(suffixes)), 0
        for k, (hot, ends) in enumerate(zip(self.hot, self.ends, strict=True)):
            key = _keys(suffixes[left], k + 1)
            longer = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key if len(hot) else np.zeros(len(key), bool)
            group[left[~longer]] = base + np.searchsorted(ends, key[~longer])
            length[left[~longer]] = k + 1
            left, base = left[longer], base + len(ends) + 1
        return group, length

    def lengths(self) -> np.ndarray:
        """The length of each group's prefixes, by group."""
        return np.repeat(np.arange(len(self.ends)) + 1, [len(e) + 1 for e in self.ends])

    def add(self, counts: DataFrame, budget: int) -> None:
        """Group the prefixes of the next length. counts: key, n."""
        total = counts.agg(F.sum("n")).first()[0] or 0
        longest = len(self.hot) + 1 == LONGEST
        hot = np.zeros(0, np.uint64) if longest else np.sort(np.array([r["key"] for r in counts.filter(F.col("n") > budget).select("key").collect()], np.int64).view(np.uint64))
        bits = min(40, max(1, int(16 * total // budget)).bit_length())
        # the top bits of the key as an unsigned number
        bins = counts.filter((F.col("n") <= budget) | F.lit(longest)).groupBy(F.shiftrightunsigned("key", 64 - bits).alias("bin")).agg(F.sum("n").alias("n")).orderBy("bin").collect()
        ends, held = [], 0
        for i, r in enumerate(bins):
            held += r["n"]
            if i + 1 < len(bins) and held + bins[i + 1]["n"] > budget:
                ends.append(((r["bin"] + 1) << (64 - bits)) - 1)
                held = 0
        self.hot.append(hot)
        self.ends.append(np.array(ends, np.uint64))


def _prefixes(codes: DataFrame, groups: Groups) -> DataFrame:
    """(key, n) of prefixes one word longer than those that are extended, for suffixes that begin with these."""
    length = len(groups.hot) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wide, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = _suffixes(_unpacked(wide, block))
                key, n = np.unique(_keys(s[groups.place(s)[0] < 0], length), return_counts=True)
                yield _batch({"key": pa.int64(), "n": pa.int64()}, key.view(np.int64), n)

    return codes.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


_SUFFIX = {"bucket": pa.int64(), **{f"c{k}": pa.int64() for k in range(1, LONGEST + 1)}, "n": pa.int64()}
_SUFFIX_SCHEMA = ", ".join(f"{c} long" for c in _SUFFIX)


def _folded(s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal suffixes as one with the sum of their counts; those that a clash of hashes parts stay apart."""
    order = np.argsort(_keys(s, LONGEST), kind="stable")
    s = s[order]
    new = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]).any(1)]))
    return s[new], np.add.reduceat(n[order], new)


def _dealt(codes: DataFrame, groups: Groups, part: int, passes: int) -> DataFrame:
    """Suffixes by group, those of one pass, folded task by task."""

    def sent(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        s = np.concatenate(held)
        s, n = _folded(s, np.ones(len(s), np.int64))
        group = groups.place(s)[0]
        for at in range(0, len(s), 1 << 17):
            x = slice(at, at + (1 << 17))
            yield _batch(_SUFFIX, group[x], *(s[x, k] for k in range(LONGEST)), n[x])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for wide, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = _suffixes(_unpacked(wide, block))
                s = s[groups.place(s)[0] % passes == part]
                if len(s):
                    held.append(s)
                    size += len(s)
                if size >= 1 << 20:
                    yield from sent(held)
                    held, size = [], 0
        if held:
            yield from sent(held)

    return codes.mapInArrow(run, _SUFFIX_SCHEMA)


_NODE = {"phrase": pa.list_(pa.int64()), "n": pa.int64()}


def _subtree(lengths: np.ndarray, least: int):
    """The step at a group: the nodes of its truncated suffix tree, from two words on. Nodes above the group's prefixes are parts of nodes."""

    def run(rows: pa.Table) -> pa.Table:
        length = int(lengths[rows.column("bucket")[0].as_py()])
        s = np.stack([rows.column(f"c{k}").to_numpy() for k in range(1, LONGEST + 1)], 1)
        n = rows.column("n").to_numpy()
        order = np.lexsort(s.T[::-1])
        s, n = s[order], n[order]
        out, new = [], np.zeros(len(s), bool)
        new[0] = True
        for d in range(1, LONGEST + 1):
            new[1:] |= s[1:, d - 1] != s[:-1, d - 1]
            start = np.flatnonzero(new)
            total = np.add.reduceat(n, start)
            keep = (s[start, d - 1] != 0) & ((total >= least) | (d < length))
            if d >= 2 and keep.any():
                flat = s[start[keep], :d].ravel()
                out.append(_batch(_NODE, pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, d, dtype=np.int32), pa.array(flat)), total[keep]))
        return pa.Table.from_batches(out, schema=pa.schema(list(_NODE.items())))

    return run


def nodes(docs: DataFrame, least: int = LEAST, budget: int = BUDGET, listed: int = LISTED, passes: int = PASSES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words: h, lang, word, n; names: code, lang, word, n of the countable ones; phrases: phrase (codes of 1 to LONGEST words), n)."""
    spark = docs.sparkSession
    vocab, seed = vocabulary(docs)
    often = vocab.filter(F.col("n") >= least)
    top = often.orderBy(F.desc("n"), "h").select("h").limit(listed).toArrow().column("h").to_numpy()
    all_listed = len(top) < listed
    order = np.argsort(top)
    hashes, numbers = top[order], order.astype(np.int64) + 1
    given = spark.createDataFrame(pa.table({"h": hashes, "number": numbers}))
    names = settled(often.join(given, "h", "left").select(F.coalesce("number", -1 - F.col("h")).alias("code"), "lang", "word", "n"), "names")
    codes = settled(_numbered(docs, hashes, numbers, all_listed, seed), "codes")
    groups = Groups()
    first = names.select("code", "n").mapInArrow(_first_keys, "key long, n long")
    groups.add(first, budget)
    while len(groups.hot[-1]):
        groups.add(settled(_prefixes(codes, groups), "prefixes"), budget)
    lengths = groups.lengths()
    parts = [settled(_dealt(codes, groups, p, passes).groupBy("bucket").applyInArrow(_subtree(lengths, least), "phrase array<long>, n long"), "nodes") for p in range(passes)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    # only what stands above a group's prefixes comes more than once
    found = found.groupBy("phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return vocab, names, settled(found.unionByName(names.select(F.array("code").alias("phrase"), "n")), "phrases")


def _first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        code = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        yield _batch({"key": pa.int64(), "n": pa.int64()}, _keys(code[:, None], 1).view(np.int64), batch.column(1))


def phrases(docs: DataFrame, least: int = LEAST, covered: int = COVERED, budget: int = BUDGET, listed: int = LISTED, passes: int = PASSES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates that stay: phrase (codes), a, l, r, score; names; words). A candidate inside a longer one that has at least
    ``covered`` percent of its count is dropped."""
    vocab, names, known = nodes(docs, least, budget, listed, passes)
    p, size = F.col("phrase"), F.size("phrase")
    cands = known.filter(size >= 2).withColumnRenamed("n", "a")
    inner = known.filter(size >= 3).select("n", "phrase", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inner = inner.select("n", "phrase", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("i")).select(F.slice(p, F.col("i"), F.col("m")).alias("phrase"), "n")
    longer = inner.groupBy("phrase").agg(F.max("n").alias("most"))
    cands = cands.join(longer, "phrase", "left").filter(F.col("most").isNull() | (F.col("most").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * covered)).drop("most")
    cuts = cands.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns({"left": F.slice(p, F.lit(1), F.col("k")), "right": F.slice(p, F.col("k") + 1, size - F.col("k"))})
    cuts = spread_join(cuts, known.select(p.alias("left"), F.col("n").alias("l")), ["left"])
    cuts = spread_join(cuts, known.select(p.alias("right"), F.col("n").alias("r")), ["right"])
    score = F.expr(f"CAST(CAST({SCALE} AS DECIMAL(38,0)) * CAST(a AS DECIMAL(30,0)) DIV (CAST(l AS DECIMAL(30,0)) + r) AS LONG)")
    best = cuts.withColumn("score", score).groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("phrase", "a", "b.l", "b.r", "b.score"), names, vocab


def ranked(docs: DataFrame, best: int = BEST, **options: int) -> DataFrame:
    """The first ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found, names, vocab = phrases(docs, **options)
    lang = names.select(F.col("code").alias("_c"), "lang")
    found = spread_join(found.withColumn("_c", F.element_at("phrase", 1)), lang, ["_c"]).drop("_c")
    # ranks by numbers first, ties kept: Spark drops what no task needs before it shuffles; words are looked up for what is left
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    some = settled(found.withColumn("at", F.rank().over(by)).filter(F.col("at") <= best), "best")
    each = some.select("phrase", F.posexplode("phrase").alias("i", "code"))
    told = spread_join(each, names.select("code", "word"), ["code"]).groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    told = told.select("phrase", F.array_join("w.word", " ").alias("text"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text")
    out = some.join(told, "phrase").withColumn("rank", F.row_number().over(last).cast("long")).filter(F.col("rank") <= best)
    sizes = vocab.groupBy("lang").agg(F.sum("n").alias("n"))
    return out.join(sizes, "lang").select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")


SQL = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w[i:i + m - 1] AS g FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest(range(1, {LONGEST + 1})) AS m FROM w) WHERE len(w) >= m)),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
f AS (SELECT lang, g, CAST(count(*) AS HUGEINT) AS n FROM g GROUP BY lang, g HAVING count(*) >= {LEAST}),
i AS (SELECT lang, g[s:s + m - 1] AS g, max(n) AS most FROM (SELECT lang, g, n, m, unnest(range(1, len(g) - m + 2)) AS s FROM (SELECT lang, g, n, unnest(range(2, len(g))) AS m FROM f WHERE len(g) >= 3)) GROUP BY ALL),
c AS (SELECT lang, g, n AS a, unnest(range(1, len(g))) AS k FROM f LEFT JOIN i USING (lang, g) WHERE len(g) >= 2 AND NOT coalesce(100 * most >= {COVERED} * n, false)),
s AS (SELECT c.lang, c.g, a, k, x.n AS l, y.n AS r, {SCALE} * a // (x.n + y.n) AS score FROM c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
r AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM b)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM r JOIN n USING (lang) WHERE rank <= {BEST}
"""
