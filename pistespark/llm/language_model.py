"""Scoring texts by a hierarchical Pitman-Yor model of word triples.

The model: a restaurant for each two-word context (a, b), whose parent is the restaurant of b, whose parent is
that of all words, over a uniform base. Contexts that end in the same word share their parent: each table in a
child is a customer in it. Seatings are sampled by Gibbs sweeps: given the rest, the number of tables that the
n customers of a dish occupy is drawn from its exact conditional, generalised Stirling numbers times the
parent's predictive probability to the power of the tables (above ``EXACT`` customers, the later ones sit down one
after another, as a Poisson number of new tables). Dishes of a sweep are drawn side by side. Predictive
probabilities are averaged over the sweeps after burn-in, and their log10 sums to a text's score.

Words: each training word has a dish and contexts of its own; ids have 32 bits. Only the root's table, which every
task needs, is bounded: words of at least a count c*, the least that leaves at most ``VOCABULARY`` words, have a
dish in it, and the root's probability of any other is that of the dish RARE times the word's add-one share of the
rare words' training tokens, which its count, sent along, gives. Words that no training row has are one dish, with
the share of one more. So the model sums to one.

Data flow. Documents are dealt by id into parts of about PART bytes.
1. Each part sends its distinct words with their training counts, by hash range, and gets their corpus counts
   back in the same order; with them it has n_tokens, n_known and base_score. (Text moves: once.)
2. Each part sends its distinct triples with their training counts, packed and sorted, by the middle word b: a
   task then has the restaurants of b and of all contexts that end in b. The occurrences to be scored lie in a
   column of their own, which only the last round reads. (Text moves: a second time.)
3. Two rounds over the packed triples: sweeps give the tables that b's restaurants have of each dish, which sum
   up to the root's customers; with the root reseated, sweeps go on and the triples are scored.
4. Each task returns one packed block of sums per part. This last round takes the tasks in ``PASSES`` shares.
The contexts that end in a word with very many occurrences are dealt by a hash of the word before it. A context
is whole in one task, with the counts of all parts, and is seated from its distinct dishes, so its load does not
grow with a pair's occurrences. The restaurant of such a word is one, too: between the rounds a task sums the
tables of all its contexts, seats it, and sends its probabilities back to the tasks of the contexts.

Defined results: null is the empty text, which has the end token alone; a null doc_id counts as the empty string
for the fold; repeated rows are learned and scored each; extra columns are ignored; with no training row the
model is uniform; an empty table gives none.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pistespark.llm.common import held_out, written
from pistespark.shared import dropped, released

FOLD, VOCABULARY, PART, WORDS_RANGE, TRIPLES, BURN, SAMPLES, EXACT, PASSES, SEED = 7, 65_000, 8 << 20, 400_000, 1_000_000, 2, 3, 48, 2, 11
STRENGTH = (1.0, 1.0, 1.0)
START, END, RARE, FIRST = 0, 1, 2, 3
END_HASH = np.uint64(1)
_U = np.uint64
_B = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(int(_B), -1, 1 << 64))
_MIX = _U(0xD6E8FEB86659FD93)
#: Bytes of a text that are hashed at once.
WINDOW = 1 << 19


def _powers(base: np.uint64) -> np.ndarray:
    out = np.full(WINDOW + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_B), _powers(_INV)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += _U(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _MIX
    return x ^ (x >> _U(32))


def words(text: str | None) -> np.ndarray:
    """Hashes of a text's tokens: its words, A-Z lower-cased, and the end."""
    whole = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    out: list[np.ndarray] = []
    run, length = 0, 0  # hash and length of a word that the window before left open
    for at in range(0, len(whole), WINDOW):
        now = whole[at : at + WINDOW]
        inside = np.zeros(len(now) + 2, bool)
        inside[1:-1] = _IS_WORD[now]
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        total = np.zeros(len(now) + 1, np.uint64)
        np.cumsum((_LOWER[now] + _U(1)) * _UP[: len(now)], dtype=np.uint64, out=total[1:])
        first, last = edge[::2], edge[1::2]
        size, value = (last - first).astype(np.uint64), (total[last] - total[first]) * _DOWN[first]
        if length and len(first) and first[0] == 0:
            value[0] = _U((run + pow(int(_B), length, 1 << 64) * int(value[0])) % (1 << 64))
            size[0] += _U(length)
        elif length:
            out.append(_mixed(np.array([run], np.uint64) ^ _U(length)))
        run, length = 0, 0
        if len(last) and last[-1] == len(now):
            run, length = int(value[-1]), int(size[-1])
            value, size = value[:-1], size[:-1]
        out.append(_mixed(value ^ size))
    if length:
        out.append(_mixed(np.array([run], np.uint64) ^ _U(length)))
    return np.concatenate([*out, [END_HASH]])


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, those of equal weight side by side, which compresses better."""
    head = struct.pack(f"<{len(arrays)}q", *(a.nbytes for a in arrays))
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"" for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _unpacked(block: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(block)
    at, out = 8 * len(kinds), []
    for n, k in zip(struct.unpack_from(f"<{len(kinds)}q", data), kinds, strict=True):
        width = np.dtype(k).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, n, at).reshape(width, -1).T).view(k).ravel())
        at += n
    return out


def _range(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)


def _by(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, its places in order) of each value of ``to``: one sort, whatever the number of values."""
    order = np.argsort(to, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
        if len(at):
            yield int(to[at[0]]), at


def _ordered(docs: pa.Table) -> pa.Table:
    """A part's documents in an order that does not depend on the shuffle, those to learn from first."""
    return docs.sort_by([("held", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])


def _tokens(docs: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(tokens of each document, distinct tokens, training count of each in this part)."""
    each = [words(t.as_py()) for t in docs.column("text")]
    held = docs.column("held").to_numpy()
    learn = [t for t, h in zip(each, held, strict=True) if not h]
    kinds = np.unique(np.concatenate(each)) if each else np.zeros(0, np.uint64)
    count = np.zeros(len(kinds), np.int64)
    if learn:
        some, n = np.unique(np.concatenate(learn), return_counts=True)
        count[np.searchsorted(kinds, some)] = n
    return each, kinds, count


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


_WORDS = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("block", pa.binary())])
_COUNTS = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("block", pa.binary()), ("w", pa.int64()), ("c", pa.int64()), ("kinds", pa.int64())])
_SCORED = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("bucket", pa.int32()), ("block", pa.binary()), ("docs", pa.binary())])
_SQL = {pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.bool_(): "boolean", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema)


def _send_words(buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        part = docs.column("part")[0].as_py()
        _, kinds, count = _tokens(docs)
        to = _range(_mixed(kinds), buckets)
        rows = [(b, part, _packed(kinds[at], count[at].astype(np.uint32))) for b, at in _by(to)]
        return _table(rows, _WORDS)

    return run


def _count_words(table: pa.Table) -> pa.Table:
    """Corpus counts of a range's words: a block per part in the order it sent, with each training word's number in the range, and the training words' counts."""
    bucket = table.column("bucket")[0].as_py()
    parts = table.column("part").to_pylist()
    sent = [_unpacked(b.as_py(), "<u8", "<u4") for b in table.column("block")]
    kinds, place = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
    total = np.bincount(place, np.concatenate([s[1] for s in sent]), len(kinds)).astype(np.int64)
    number = np.cumsum(total > 0) - 1
    rows: list[tuple] = []
    at = 0
    for part, s in zip(parts, sent, strict=True):
        own = place[at : at + len(s[0])]
        rows.append((part, bucket, _packed(total[own].astype(np.uint64), number[own].astype(np.int64)), None, None, None))
        at += len(s[0])
    known = total[total > 0]
    rows.append((None, bucket, None, None, int(known.sum()), len(known)))
    often = total > 0
    rows += [(None, bucket, None, int(w), int(c), None) for w, c in zip(kinds[often].view(np.int64), total[often], strict=True)]
    return _table(rows, _COUNTS)


class Vocabulary:
    """The words that have a dish of their own in the root, by hash, and how the contexts that end in them are dealt. At most VOCABULARY words."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, tokens: int, kinds: int, buckets: int, docs: int = 0):
        often = np.lexsort((hashes, -counts))  # frequent words have small ids, which pack better
        self.counts = counts[often]
        order = np.argsort(hashes[often])
        self.hashes, self.rank = hashes[often][order], order
        self.tokens, self.kinds, self.buckets = tokens, kinds, buckets
        self.rare_tokens, self.rare_kinds = tokens - int(counts.sum()), kinds - len(counts)
        # tasks that share the contexts of a word, dealt by the word before; each document has START once, and END as no middle
        own = np.concatenate([[docs, 0, self.rare_tokens], self.counts])
        self.pieces = np.maximum(1, np.ceil(own / max(1.0, tokens / buckets / 4))).astype(np.int64)
        self.root0 = np.maximum(np.concatenate([[0, 0, self.rare_tokens], self.counts]), 0).astype(float)

    def ids(self, kinds: np.ndarray, count: np.ndarray, number: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Ids of words with their corpus counts, and their numbers in their ranges: RARE is what no training row has."""
        out = np.where(count > 0, FIRST + len(self.hashes) + number * self.words_range + to, RARE)
        if out.max(initial=0) >> 32:
            raise ValueError("more words than 32 bits can number")
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, kinds), len(self.hashes) - 1)
            hit = self.hashes[at] == kinds
            out[hit] = FIRST + self.rank[at[hit]]
        out[kinds == END_HASH] = END
        return out


def dealt_to(pieces: np.ndarray, b: np.ndarray) -> np.ndarray:
    """To how many tasks the contexts go that end in each word: one where the root has no dish of it."""
    return np.where(b < len(pieces), pieces[np.minimum(b, len(pieces) - 1)], 1)


def rooted(root: np.ndarray, w: np.ndarray, rare: np.ndarray, all_rare: int) -> np.ndarray:
    """The root's probabilities of words: of those it has no dish of, a share of RARE's."""
    return np.where(rare > 0, root[RARE] * rare / all_rare, root[np.where(rare > 0, RARE, w)])


def _send_triples(vocabulary):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], _SCORED)
        v: Vocabulary = vocabulary.value
        docs = _ordered(docs)
        part = docs.column("part")[0].as_py()
        each, kinds, _ = _tokens(docs)
        to = _range(_mixed(kinds), v.words_range)
        count, number = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        places = dict(_by(to))
        for b, block in zip(replies.column("bucket").to_pylist(), replies.column("block"), strict=True):
            count[places[b]], number[places[b]] = _unpacked(block.as_py(), "<u8", "<i8")
        ids = v.ids(kinds, count, number, to)
        base = np.log10((count + 1) / (v.tokens + v.kinds + 1))
        # what the root's share of a word goes by: its count, or 0 where it has a dish there
        rare = np.where((ids == RARE) | (ids >= FIRST + len(v.hashes)), count + 1, 0).astype(np.uint32)
        size = np.array([len(t) for t in each])
        at = np.searchsorted(kinds, np.concatenate(each)).astype(np.int32)
        del each
        start = np.cumsum(size) - size
        sums = [np.add.reduceat(x[at], start) for x in ((count > 0).astype(np.int64), base)]
        w, rare = ids.astype(np.uint32)[at], rare[at]
        del at, kinds, count, number, base
        b = np.concatenate([[START], w[:-1]]).astype(np.uint32)
        b[start] = START
        a = np.concatenate([[START], b[:-1]]).astype(np.uint32)
        a[start] = START
        held = docs.column("held").to_numpy()
        rows: list[tuple] = [(part, i, d, h, int(n), int(k), float(s), None, None, None) for i, (d, h, n, k, s) in enumerate(zip(docs.column("doc_id").to_pylist(), held, size, *sums, strict=True))]
        piece = _mixed(a.astype(np.uint64) + _U(977)) % dealt_to(v.pieces, b).astype(np.uint64)
        to_b = (_mixed((b.astype(np.uint64) << _U(32)) + piece + _U(5)) % _U(v.buckets) << _U(32)) | b
        a_w = (a.astype(np.uint64) << _U(32)) | w
        del a, b, w, piece
        order = np.lexsort((a_w, to_b))  # stable: documents stay in order
        to_b, a_w = to_b[order], a_w[order]
        doc = np.repeat(np.arange(len(size), dtype=np.uint32), size)[order]
        rare = rare[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], (to_b[1:] != to_b[:-1]) | (a_w[1:] != a_w[:-1])]))
        learned = np.add.reduceat((doc < (~held).sum()).astype(np.uint32), first)
        to_b, a_w, many = to_b[first], a_w[first], np.diff(np.append(first, len(doc))).astype(np.uint32)
        bucket, low = (to_b >> _U(32)).astype(np.int64), _U(0xFFFFFFFF)
        columns = [x.astype(np.uint32) for x in (to_b & low, a_w >> _U(32), a_w & low, learned, rare[first])]
        first = np.append(first, len(doc))
        edge = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket))
        for x, y in zip(edge, edge[1:], strict=False):
            rows.append((part, None, None, None, None, None, None, int(bucket[x]), _packed(*(c[x:y] for c in columns)), _packed(many[x:y], doc[first[x] : first[y]])))
        return _table(rows, _SCORED)

    return run


def stirling(d: float, most: int = EXACT) -> np.ndarray:
    """log of the generalised Stirling numbers S(n, t) of discount d, n and t up to ``most``."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[0, 0] = 0
    for n in range(most):
        t = np.arange(most + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(n - d * t > 0, np.log(np.maximum(n - d * t, 1e-300)), -np.inf) + s[n]
        s[n + 1] = np.logaddexp(stay, np.concatenate([[-np.inf], s[n, :-1]]))
    return s


def seated(n: np.ndarray, other: np.ndarray, parent: np.ndarray, d: float, strength: float, table: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of the n customers of each dish, drawn given the restaurant's other tables and the parent's probability of the dish."""
    out = np.minimum(n, 1)
    small = np.minimum(n, EXACT)
    for size in np.unique(small[small > 1]):
        at = np.flatnonzero(small == size)
        for cut in range(0, len(at), 1 << 15):
            some = at[cut : cut + (1 << 15)]
            t = np.arange(1, size + 1)
            open_ = np.cumsum(np.log(strength + d * (other[some][:, None] + np.arange(size))), 1)
            p = table[size, 1 : size + 1] + open_ + t * np.log(np.maximum(parent[some], 1e-300))[:, None]
            out[some] = 1 + np.argmax(p + rng.gumbel(size=p.shape), 1)
    big = n > EXACT
    if big.any():
        weight = (strength + d * (other[big] + out[big])) * parent[big]
        more = rng.poisson(weight * np.log((weight + n[big]) / (weight + EXACT)))
        out[big] = np.minimum(n[big], out[big] + more)
    return out


def discount(counts: np.ndarray) -> float:
    """n1 / (n1 + 2 n2), within limits."""
    one, two = (counts == 1).sum(), (counts == 2).sum()
    return float(np.clip(one / max(one + 2 * two, 1), 0.1, 0.95)) if one else 0.5


def _group(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Number of each item's group, for keys sorted by group."""
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    return np.cumsum(new, dtype=np.int32) - 1, int(new.sum())


class Restaurants:
    """The restaurants of some middle words: dishes of contexts (a, b) and of b, with customers and tables."""

    def __init__(self, keys: np.ndarray, count: np.ndarray):
        """Distinct (b, a, w) in order, as rows of three or packed in 16 bits each, with training counts that may be 0."""
        b, a, w = keys if keys.ndim == 2 else [(keys >> _U(i)) & _U(0xFFFF) for i in (32, 16, 0)]
        b, a, w = b.astype(np.uint64), a.astype(np.uint64), w.astype(np.int32)
        self.w, self.n = w, count
        self.context, self.contexts = _group((b << _U(32)) | a)
        pair_key = (b << _U(32)) | w.astype(np.uint64)
        order = np.argsort(pair_key, kind="stable")
        pair, pairs = _group(pair_key[order])
        self.pair = np.empty(len(w), np.int32)
        self.pair[order] = pair
        del order, pair
        kept = np.zeros(pairs, np.uint64)
        kept[self.pair] = pair_key
        self.pair_b, self.pair_w = kept >> _U(32), (kept & _U(0xFFFFFFFF)).astype(np.int32)
        self.middle, self.middles = _group(self.pair_b)
        self.given = np.full(pairs, np.nan)
        self.t = np.minimum(count, 1)
        self.customers = np.bincount(self.context, count, self.contexts)
        self.n2 = np.bincount(self.pair, self.t, pairs).astype(np.int64)
        self.t2 = np.minimum(self.n2, 1)
        self.d, self.d2 = discount(count), discount(self.n2)
        self.s, self.s2 = stirling(self.d), stirling(self.d2)

    def parent(self, root: np.ndarray) -> np.ndarray:
        """Probability of each (b, w) in b's restaurant; that in ``given`` where b's restaurant is seated elsewhere."""
        tables = np.bincount(self.middle, self.t2, self.middles)[self.middle]
        all_ = np.bincount(self.middle, self.n2, self.middles)[self.middle]
        own = (self.n2 - self.d2 * self.t2 + (STRENGTH[1] + self.d2 * tables) * root[self.pair_w]) / (STRENGTH[1] + all_)
        return np.where(np.isnan(self.given), own, self.given)

    def sweep(self, root: np.ndarray, rng: np.random.Generator) -> None:
        tables = np.bincount(self.middle, self.t2, self.middles)[self.middle]
        self.t2 = seated(self.n2, tables - self.t2, root[self.pair_w], self.d2, STRENGTH[1], self.s2, rng)
        many = np.flatnonzero(self.n > 1)
        if len(many):
            # the parent without the tables of the dish at hand
            p, own = self.pair[many], self.t[many]
            tables = np.bincount(self.middle, self.t2, self.middles)[self.middle[p]]
            all_ = np.bincount(self.middle, self.n2, self.middles)[self.middle[p]] - own
            left = np.maximum(self.n2[p] - own, 0)
            t2 = np.minimum(self.t2[p], left)
            up = (left - self.d2 * t2 + (STRENGTH[1] + self.d2 * (tables - self.t2[p] + t2)) * root[self.pair_w[p]]) / (STRENGTH[1] + np.maximum(all_, 0))
            up = np.where(np.isnan(self.given[p]), up, self.given[p])
            other = np.bincount(self.context, self.t, self.contexts)[self.context[many]] - own
            self.t[many] = seated(self.n[many], other, up, self.d, STRENGTH[2], self.s, rng)
        self.n2 = np.bincount(self.pair, self.t, len(self.pair_w)).astype(np.int64)
        self.t2 = np.clip(self.t2, np.minimum(self.n2, 1), self.n2)

    def predictive(self, root: np.ndarray) -> np.ndarray:
        """Probability of each (a, b, w)."""
        tables = np.bincount(self.context, self.t, self.contexts)[self.context]
        up = self.parent(root)[self.pair]
        return (self.n - self.d * self.t + (STRENGTH[2] + self.d * tables) * up) / (STRENGTH[2] + self.customers[self.context])


class Middles:
    """Whole restaurants of words whose contexts are dealt to many tasks."""

    def __init__(self, b: np.ndarray, n: np.ndarray):
        """Middle word of each dish, in order, and its customers: the tables of all contexts."""
        self.middle, self.middles = _group(b)
        self.n, self.t, self.d = n, np.minimum(n, 1), discount(n)
        self.s = stirling(self.d)

    def sweep(self, root: np.ndarray, rng: np.random.Generator) -> None:
        other = np.bincount(self.middle, self.t, self.middles)[self.middle] - self.t
        self.t = seated(self.n, other, root, self.d, STRENGTH[1], self.s, rng)

    def predictive(self, root: np.ndarray) -> np.ndarray:
        tables = np.bincount(self.middle, self.t, self.middles)[self.middle]
        all_ = np.bincount(self.middle, self.n, self.middles)[self.middle]
        return (self.n - self.d * self.t + (STRENGTH[1] + self.d * tables) * root) / (STRENGTH[1] + all_)


def _dealt(table: pa.Table) -> tuple[Restaurants, np.ndarray, np.ndarray, np.ndarray]:
    """(restaurants with the counts of all parts, dish of each distinct triple of each block in turn, words, and their counts where rare).

    The restaurants have words by their places among the words."""
    b, a, w, n, rare = (np.concatenate(c) for c in zip(*(_unpacked(x.as_py(), *["<u4"] * 5) for x in table.column("block")), strict=True))
    words_, at, w = np.unique(w, return_index=True, return_inverse=True)
    a_w = (a.astype(np.uint64) << _U(32)) | w.astype(np.uint64)
    order = np.lexsort((a_w, b))
    new = np.concatenate([[True], (a_w[order][1:] != a_w[order][:-1]) | (b[order][1:] != b[order][:-1])])
    dish = np.empty(len(b), np.int32)
    dish[order] = np.cumsum(new, dtype=np.int32) - 1
    first = order[new]
    return Restaurants(np.stack([b[first], a[first], w[first]]), np.bincount(dish, n, len(first)).astype(np.int64)), dish, words_.astype(np.int64), rare[at].astype(np.int64)


def _elsewhere(r: Restaurants, pieces: np.ndarray, tasks: int) -> dict[int, np.ndarray]:
    """The pairs whose middle word has its restaurant in another task, by that task."""
    at = np.flatnonzero(dealt_to(pieces, r.pair_b.astype(np.int64)) > 1)
    to = (_mixed(r.pair_b[at] + _U(31)) % _U(tasks)).astype(np.int64)
    return {x: at[some] for x, some in _by(to)}


_ROOT = pa.schema([("w", pa.int32()), ("n", pa.int64()), ("task", pa.int32()), ("bucket", pa.int32()), ("block", pa.binary())])
_SUMS = pa.schema([("part", pa.int32()), ("block", pa.binary())])
_GIVEN = pa.schema([("bucket", pa.int32()), ("task", pa.int32()), ("block", pa.binary())])


def _customers(w: np.ndarray, rare: np.ndarray, n: np.ndarray) -> list[tuple]:
    """Rows of the root's customers."""
    total = np.bincount(np.where(rare > 0, RARE, w), n).astype(np.int64)
    return [(int(x), int(total[x]), None, None, None) for x in np.flatnonzero(total)]


def _rooted(root, seed: int, tasks: int):
    def run(table: pa.Table) -> pa.Table:
        first, pieces, all_rare = root.value
        r, _, w, rare = _dealt(table)
        first = rooted(first, w, rare, all_rare)
        bucket = table.column("bucket")[0].as_py()
        rng = np.random.default_rng([seed, bucket])
        for _ in range(BURN):
            r.sweep(first, rng)
        sent = _elsewhere(r, pieces, tasks)
        here = np.ones(len(r.pair_w), bool)
        rows = []
        for to, at in sent.items():
            here[at] = False
            rows.append((None, None, to, bucket, _packed(*(x.astype(np.uint32) for x in (r.pair_b[at], w[r.pair_w[at]], r.n2[at], rare[r.pair_w[at]])))))
        of = r.pair_w[here]
        return _table(rows + _customers(w[of], rare[of], r.t2[here]), _ROOT)

    return run


def _middles(table: pa.Table) -> tuple[Middles, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(restaurants with the tables of all contexts, their words, and their counts where rare, dish of each pair of each block in turn, the blocks' lengths)."""
    sent = [_unpacked(x.as_py(), *["<u4"] * 4) for x in table.column("block")]
    b, w, n, rare = (np.concatenate(c) for c in zip(*sent, strict=True))
    kinds, at, dish = np.unique((b.astype(np.uint64) << _U(32)) | w, return_index=True, return_inverse=True)
    return Middles(kinds >> _U(32), np.bincount(dish, n, len(kinds)).astype(np.int64)), w[at].astype(np.int64), rare[at].astype(np.int64), dish, [len(x[0]) for x in sent]


def _middles_rooted(root, seed: int):
    def run(table: pa.Table) -> pa.Table:
        first, _, all_rare = root.value
        m, w, rare, _, _ = _middles(table)
        first = rooted(first, w, rare, all_rare)
        rng = np.random.default_rng([seed, 1, table.column("task")[0].as_py()])
        for _ in range(BURN):
            m.sweep(first, rng)
        return _table(_customers(w, rare, m.t), _ROOT)

    return run


def _middles_given(root, seed: int):
    def run(table: pa.Table) -> pa.Table:
        first, _, all_rare = root.value
        m, w, rare, dish, sizes = _middles(table)
        first = rooted(first, w, rare, all_rare)
        task = table.column("task")[0].as_py()
        rng = np.random.default_rng([seed, 1, task])
        mean = np.zeros(len(w))
        for i in range(BURN + SAMPLES):
            m.sweep(first, rng)
            if i >= BURN:
                mean += m.predictive(first) / SAMPLES
        each = np.split(mean[dish].astype(np.float32), np.cumsum(sizes)[:-1])
        return _table([(bucket, task, _packed(p)) for bucket, p in zip(table.column("bucket").to_pylist(), each, strict=True)], _GIVEN)

    return run


def _scored(root, seed: int, tasks: int):
    def run(table: pa.Table, given: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([], _SUMS)
        first, pieces, all_rare = root.value
        r, dish, w, rare = _dealt(table)
        first = rooted(first, w, rare, all_rare)
        sent = _elsewhere(r, pieces, tasks)
        for task, p in zip(given.column("task").to_pylist(), given.column("block"), strict=True):
            r.given[sent[task]] = _unpacked(p.as_py(), "<f4")[0]
        rng = np.random.default_rng([seed, table.column("bucket")[0].as_py()])
        mean = np.zeros(len(r.w))
        for i in range(BURN + SAMPLES):
            r.sweep(first, rng)
            if i >= BURN:
                mean += r.predictive(first) / SAMPLES
        score = np.log10(mean)[dish]
        rows, at = [], 0
        for part, x in zip(table.column("part").to_pylist(), table.column("docs"), strict=True):
            many, doc = _unpacked(x.as_py(), "<u4", "<u4")
            sums = np.bincount(doc, np.repeat(score[at : at + len(many)], many))
            at += len(many)
            some = np.unique(doc)
            rows.append((part, _packed(some, sums[some].astype(np.float32))))
        return _table(rows, _SUMS)

    return run


_TOTAL = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("model", pa.float64())])


def _summed(table: pa.Table) -> pa.Table:
    """The sums of a part's documents."""
    part = table.column("part")[0].as_py()
    got = [_unpacked(x.as_py(), "<u4", "<f4") for x in table.column("block")]
    at = np.concatenate([g[0] for g in got]).astype(np.int64)
    total = np.bincount(at, np.concatenate([g[1] for g in got]).astype(np.float64))
    return pa.Table.from_arrays([pa.array(np.full(len(total), part, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], schema=_TOTAL)


def root_table(customers: np.ndarray, dishes: int, seed: int = SEED) -> np.ndarray:
    """Predictive probabilities of the root's dishes, averaged over seatings, over a uniform base."""
    base = 1.0 / max(dishes, 1)
    n = customers.astype(np.int64)
    d, rng = discount(n), np.random.default_rng(seed)
    table, t, mean = stirling(d), np.minimum(n, 1), np.zeros(len(n))
    for i in range(BURN + SAMPLES):
        t = seated(n, t.sum() - t, np.full(len(n), base), d, STRENGTH[0], table, rng)
        if i >= BURN:
            mean += (n - d * t + (STRENGTH[0] + d * t.sum()) * base) / (STRENGTH[0] + n.sum()) / SAMPLES
    return mean


def scores(docs: DataFrame, part: int = PART, vocabulary: int = VOCABULARY, triples: int = TRIPLES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(1, -(-((size[0] or 0) + 64 * size[1]) // part))
    # copies and very long texts of one id still go together; the hash of the text only spreads a repeated id
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), FOLD).alias("held"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(parts)).cast("int"))
    ranges = max(1, -(-parts * part // 8 // WORDS_RANGE))
    sent = rows.groupBy("part").applyInArrow(_send_words(ranges), _ddl(_WORDS))
    counts = written(sent.groupBy("bucket").applyInArrow(_count_words, _ddl(_COUNTS)), "counts")
    released(spark)
    tokens, kinds = counts.filter("kinds IS NOT NULL").agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    often = counts.filter(F.col("w").isNotNull() & (F.col("w") != int(END_HASH)))
    bins = {r["bin"]: r["n"] for r in often.groupBy(F.floor(8 * F.log2("c")).alias("bin")).agg(F.count("*").alias("n")).collect()}  # 8 bins for each doubling
    least, so_far = max(bins, default=0) + 1, 0
    for b in sorted(bins, reverse=True):
        so_far += bins[b]
        if so_far > vocabulary:
            break
        least = b
    chosen = often.filter(F.floor(8 * F.log2("c")) >= least).select("w", "c").collect()  # at most ``vocabulary`` rows
    ends = counts.filter(F.col("w") == int(END_HASH)).select("c").first()
    v = Vocabulary(np.array([r["w"] for r in chosen], np.int64).view(np.uint64), np.array([r["c"] for r in chosen], np.int64), tokens, kinds, max(1, -(-((size[0] or 0) // 6) // triples)), size[1])
    if ends:  # the end is a dish of its own and not rare
        v.rare_tokens, v.rare_kinds = v.rare_tokens - ends["c"], v.rare_kinds - 1
        v.root0[END], v.root0[RARE] = ends["c"], v.rare_tokens
    v.words_range = ranges
    shared = spark.sparkContext.broadcast(v)
    replies = counts.filter("block IS NOT NULL").select("part", "bucket", "block")
    made = written(rows.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(_send_triples(shared), _ddl(_SCORED)), "triples")
    dropped(counts)
    released(spark)
    packed = made.filter("block IS NOT NULL")
    dishes, all_rare = len(v.hashes) + 2, v.rare_tokens + v.rare_kinds + 1  # START is never a dish
    first = spark.sparkContext.broadcast(((v.root0 + 1) / (v.root0.sum() + dishes), v.pieces, all_rare))
    seated_ = written(packed.select("bucket", "block").groupBy("bucket").applyInArrow(_rooted(first, SEED, v.buckets), _ddl(_ROOT)), "seated")
    split = seated_.filter("block IS NOT NULL").select("task", "bucket", "block")
    root = seated_.filter("w IS NOT NULL").unionByName(split.groupBy("task").applyInArrow(_middles_rooted(first, SEED), _ddl(_ROOT)))
    customers = np.zeros(len(v.root0), np.int64)
    for r in root.groupBy("w").agg(F.sum("n").alias("n")).collect():  # at most one row per dish
        customers[r["w"]] = r["n"]
    del root  # it holds on to its shuffle files
    released(spark)
    second = spark.sparkContext.broadcast((root_table(customers, dishes), v.pieces, all_rare))
    given = written(split.groupBy("task").applyInArrow(_middles_given(second, SEED + 1), _ddl(_GIVEN)), "given")
    dropped(seated_)
    sums = None
    for i in range(PASSES):  # a share of the buckets at a time, so that only that share of the triples is shuffle files at once
        here = F.col("bucket") % PASSES == i
        one = packed.filter(here).select("bucket", "part", "block", "docs").groupBy("bucket").cogroup(given.filter(here).groupBy("bucket"))
        one = written(one.applyInArrow(_scored(second, SEED + 1, v.buckets), _ddl(_SUMS)), "sums")
        sums = one if sums is None else sums.unionByName(one)
        released(spark)
    total = sums.groupBy("part").applyInArrow(_summed, _ddl(_TOTAL))
    out = made.filter("place IS NOT NULL").drop("bucket", "block", "docs").join(total, ["part", "place"])
    return out.select("doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("model").alias("score"))
