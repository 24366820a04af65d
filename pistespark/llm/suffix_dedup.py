"""Removing repeated passages: every byte inside a 100-byte string that also starts earlier in the corpus.

The suffixes that can matter are sorted by a distributed merge sort that knows common prefixes:

1. *Which suffixes matter.* Each window of LENGTH bytes has an anchor: its GRAM-byte string of least hash. Equal
   windows have equal anchors, so a window whose anchor's hash comes once in the corpus is repeated nowhere.
   Tasks send each anchor hash once (with its count), and get back those that repeat. Nothing is lost: the
   filter only leaves out suffixes that have no partner. Windows next to each other mostly share their anchor;
   such a run of windows is one suffix, cut after the last window's end (at most 2 * LENGTH - GRAM bytes).
2. *Sorted runs.* Each task sorts its suffixes, keeps the first of equal ones (the others are repeats already),
   front-codes them (length of the prefix shared with the one before, and the rest) and sends them by key range.
3. *Merging.* A loser tree merges the runs of a range. It carries, for each run's head, the length of the prefix
   shared with the last output; heads that differ there are ordered by it alone, and otherwise bytes are
   compared from there on, so no known prefix is compared twice. The shared length with the last output tells
   equal suffixes: all but the earliest are repeats in full. Different suffixes with one anchor repeat each
   other in part: their windows are compared by hash and then byte by byte.
4. Repeats go back to their documents, which are cut.

An anchor that comes more than ``hot`` times (a common phrase in ever new surroundings) is not kept in one range:
its suffixes are dealt by their whole content, and its windows meet by their LENGTH bytes in a grouped minimum.

Documents are dealt by a hash of their id into parts of about PART bytes; the two steps that need the text with
its messages shuffle it. No step holds more than a part, a range, or one document.

Defined results: null text is the empty text; texts under LENGTH bytes lose nothing; a null doc_id comes after
all others; different texts with one doc_id are ordered by a hash of the text; fully repeated rows stand at the
same place, so none is earlier than the other: they are one row with a count up to the last step; extra columns
are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.llm.common import written
from pistespark.shared import dropped, released, spread_join

LENGTH, GRAM, PART, RANGE, HOT = 100, 32, 8 << 20, 8 << 20, 50_000
WIDE = LENGTH - GRAM + 1  # anchors to choose from in a window, and most windows in a run
KEY = 9 + WIDE + LENGTH - 1  # hash, length, bytes
_B = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_END = 1 << 20
_U = np.uint64
LAST = (1 << 63) - 1  # stands for a null id


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_B, _END), _powers(_INV, _END)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _MIX
    return x ^ (x >> _U(32))


def hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n bytes from each place on. Long texts go in overlapping pieces."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    if len(data) > _END - 1:
        step = _END - n
        return np.concatenate([hashes(data[at : at + step + n - 1], n) for at in range(0, len(data) - n + 1, step)])
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + _U(1)) * _UP[: len(data)], dtype=np.uint64, out=total[1:])
    return _mixed((total[n:] - total[:-n]) * _DOWN[: len(data) - n + 1])


def _sliding(f: np.ufunc, a: np.ndarray, w: int) -> np.ndarray:
    n, m = 1, a
    while 2 * n <= w:
        m, n = f(m[:-n], m[n:]), 2 * n
    return f(m[: len(a) - w + 1], m[w - n : len(a) - n + 1]) if n < w else m


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash at each place, least hash in each window)."""
    h = hashes(data, GRAM)
    return h, _sliding(np.minimum, h, WIDE)


def anchor_places(h: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Places that are the anchor of some window, ties included."""
    side = np.zeros(WIDE - 1, np.uint64)
    return np.flatnonzero(h == _sliding(np.maximum, np.concatenate([side, least, side]), WIDE))


def window_runs(h: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor hash, at most WIDE long: first window, windows, whether the anchor may come twice inside."""
    start = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.append(start, len(least)))
    if count.max() > WIDE:
        cuts = -(-count // WIDE)
        first = np.repeat(start, cuts)
        inner = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        count = np.minimum(np.repeat(count, cuts) - inner * WIDE, WIDE)
        start = first + inner * WIDE
    places = anchor_places(h, least)
    same = np.concatenate([[0], np.cumsum(h[places[1:]] == h[places[:-1]])]) if len(places) else np.zeros(1, np.int64)
    low, high = np.searchsorted(places, start), np.searchsorted(places, start + count + WIDE - 1) - 1
    return start, count, (high > low) & (same[np.maximum(high, 0)] > same[np.minimum(low, len(same) - 1)])


def front_coded(keys: np.ndarray, sizes: np.ndarray, where: list[np.ndarray]) -> bytes:
    """Sorted keys (rows of KEY bytes, of ``sizes`` used bytes) as shared lengths and rests, with columns that go along."""
    shared = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        other = keys[1:] != keys[:-1]
        shared[1:] = np.minimum(np.where(other.any(1), other.argmax(1), KEY), np.minimum(sizes[1:], sizes[:-1]))
    rest = (np.arange(KEY) >= shared[:, None]) & (np.arange(KEY) < sizes[:, None])
    parts = [shared.astype(np.uint8), sizes.astype(np.uint8), keys[rest], *where]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<qq", len(keys), int(rest.sum())) + b"".join(p.tobytes() for p in parts))


def decoded(block: bytes) -> tuple[list[bytes], list[int], list[np.ndarray]]:
    """Keys in order, lengths shared with the key before, and the columns (doc, tie, start, windows)."""
    data = zstandard.ZstdDecompressor().decompress(block)
    n, rest = struct.unpack_from("<qq", data)
    shared, size = data[16 : 16 + n], data[16 + n : 16 + 2 * n]
    at = 16 + 2 * n
    keys, key = [], b""
    for s, z in zip(shared, size, strict=True):
        key = key[:s] + data[at : at + z - s]
        at += z - s
        keys.append(key)
    cols = []
    for kind in ("<i8", "<i8", "<i4", "u1"):
        cols.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return keys, list(shared), cols


def _differ(x: bytes, y: bytes, at: int) -> int:
    """First place from ``at`` on where x and y differ."""
    end = min(len(x), len(y))
    d = int.from_bytes(x[at:end], "big") ^ int.from_bytes(y[at:end], "big")
    return end - (d.bit_length() + 7) // 8 if d else end


def merged(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[bytes, int, int, int]]:
    """Merge sorted runs with a loser tree over shared prefixes: (key, length shared with the last output, run, place in run)."""
    k = 1
    while k < len(runs):
        k *= 2
    head: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs))
    known, place = [0] * k, [0] * k  # known: length shared with what beat it, and for the winner with the last output

    def beats(a: int, b: int) -> bool:
        """Whether run a's head goes before b's; the loser's known length is set."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return y is None
        s, t = known[a], known[b]
        if s != t:
            return s > t
        if x == y:
            known[b] = len(x)
            return True
        m = _differ(x, y, s)
        if x[m : m + 1] < y[m : m + 1]:
            known[b] = m
            return True
        known[a] = m
        return False

    tree, winner = [0] * k, [0] * (2 * k)
    for i in range(k):
        winner[k + i] = i
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    top = winner[1]
    while head[top] is not None:
        at = place[top]
        yield head[top], known[top], top, at
        at += 1
        place[top] = at
        keys, shared = runs[top]
        if at < len(keys):
            head[top], known[top] = keys[at], shared[at]
        else:
            head[top] = None
        node = (k + top) // 2
        while node:
            other = tree[node]
            if beats(other, top):
                tree[node], top = top, other
            node //= 2


def windows_repeated(keys: np.ndarray, doc: np.ndarray, tie: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the suffixes ``keys`` (rows: bytes from place 9 on) that also start earlier in one of them: (row, offset)."""
    h, row, offset = window_hashes(keys, count)
    order = np.lexsort(((start[row] + offset), tie[row], doc[row], h))
    h, row, offset = h[order], row[order], offset[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = ~new & ((doc[row] != doc[row[first]]) | (tie[row] != tie[row[first]]) | (start[row] + offset != start[row[first]] + offset[first]))
    mine, its = np.flatnonzero(later), first[later]
    true = np.ones(len(mine), bool)
    for at in range(0, len(mine), 1 << 14):
        a, b = mine[at : at + (1 << 14)], its[at : at + (1 << 14)]
        span = np.arange(9, 9 + LENGTH)
        true[at : at + (1 << 14)] = (keys[row[a][:, None], offset[a][:, None] + span] == keys[row[b][:, None], offset[b][:, None] + span]).all(1)
    if not true.all():  # two strings with one hash: settle all of them by their bytes
        seen: dict[bytes, int] = {}
        found = []
        for i in np.lexsort((start[row] + offset, tie[row], doc[row])):
            text = keys[row[i], 9 + offset[i] : 9 + offset[i] + LENGTH].tobytes()
            f = seen.setdefault(text, i)
            if (doc[row[f]], tie[row[f]], start[row[f]] + offset[f]) != (doc[row[i]], tie[row[i]], start[row[i]] + offset[i]):
                found.append(i)
        mine = np.array(found, np.int64)
    return row[mine], offset[mine]


def window_hashes(keys: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, offset) of every window of every suffix."""
    total = np.zeros((len(keys), KEY - 8), np.uint64)
    np.cumsum((keys[:, 9:] + _U(1)) * _UP[: KEY - 9], axis=1, dtype=np.uint64, out=total[:, 1:])
    row = np.repeat(np.arange(len(keys)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return _mixed((total[row, offset + LENGTH] - total[row, offset]) * _DOWN[offset]), row, offset


def _batch(names: list[str], kinds: list[pa.DataType], *cols: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def _bytes(x: pa.Scalar) -> np.ndarray:
    return np.frombuffer((x.as_py() or "").encode("utf-8", "replace"), np.uint8)


_ANCHOR = "h long, part int, n int"
#: part of an _ANCHOR row: the part that holds the hash once; SEVERAL: the task holds it several times; -2 - part: such a part.
SEVERAL = -1


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """Per task and anchor hash: one row if it comes once, else one row with its count and one per part that holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, where = [], []
        for batch in batches:
            for part, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = _bytes(text)
                if len(data) >= LENGTH:
                    h, least = anchors(data)
                    found.append(h[anchor_places(h, least)])
                    where.append(np.full(len(found[-1]), part, np.int32))
        if not found:
            return
        h, part = np.concatenate(found), np.concatenate(where)
        order = np.lexsort((part, h))
        h, part = h[order], part[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        count = np.diff(np.append(np.flatnonzero(new), len(h)))
        many = np.repeat(count > 1, count)
        once = ~many
        pair = many & (new | np.concatenate([[True], part[1:] != part[:-1]]))
        for a, b, n in ((h[once], part[once], np.ones(once.sum())), (h[new & many], np.full((new & many).sum(), SEVERAL), count[count > 1]), (h[pair], -2 - part[pair], np.zeros(pair.sum()))):
            for at in range(0, len(a), 1 << 18):
                yield _batch(["h", "part", "n"], [pa.int64(), pa.int32(), pa.int32()], *(x[at : at + (1 << 18)] for x in (a.view(np.int64), b.astype(np.int32), n.astype(np.int32))))

    return docs.select("part", "text").mapInArrow(run, _ANCHOR)


def _repeated_anchors(rows: DataFrame, parts: int, hot: int) -> DataFrame:
    """(h, part, hot): for each part, the anchor hashes in it that repeat somewhere; hot only where a part-less row says so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if not held:
            return
        h, part, n = (np.concatenate(x) for x in zip(*held, strict=True))
        del held
        direct = part <= -2
        order = np.argsort(h[~direct], kind="stable")
        a, p, c = h[~direct][order], part[~direct][order], n[~direct][order]
        start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(a)))
        total = np.add.reduceat(c.astype(np.int64), start) if len(a) else np.zeros(0, np.int64)
        use = np.repeat(total > 1, size) & (p >= 0)
        often = a[start[total > hot]] if len(a) else a
        for x, y, z in ((a[use], p[use], False), (h[direct], -2 - part[direct], False), (often, np.full(len(often), SEVERAL), True)):
            yield _batch(["h", "part", "hot"], [pa.int64(), pa.int32(), pa.bool_()], x, y.astype(np.int32), np.full(len(x), z))

    dealt = F.when(F.col("part") <= -2, F.xxhash64("h", "part")).otherwise(F.col("h"))
    return rows.repartition(parts, dealt).mapInArrow(run, "h long, part int, hot boolean")


#: block: a front-coded run, or the bytes of a window.
_OUT = "kind int, bucket int, doc long, tie long, start int, n int, block binary"
_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
_NAMES = [x.split()[0] for x in _OUT.split(", ")]
REPEAT, BLOCK, WINDOW = 0, 1, 2


def _rows(kind: int, doc: np.ndarray, tie: np.ndarray, start: np.ndarray, n: np.ndarray, text: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of rows; text: a row of bytes for each."""
    for at in range(0, len(doc), 1 << 17):
        s = slice(at, at + (1 << 17))
        m = len(doc[s])
        none = [None] * m
        yield _batch(_NAMES, _KINDS, np.full(m, kind, np.int32), none, doc[s], tie[s], start[s].astype(np.int32), n[s].astype(np.int32), none if text is None else [x.tobytes() for x in text[s]])


def _sorted_runs(buckets: int):
    """The step at a part: its documents and its repeated anchors to front-coded blocks, and repeats within the part."""

    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        known = np.unique(wanted.column("h").to_numpy())
        often = np.unique(wanted.column("h").filter(wanted.column("hot")).to_numpy()).view(np.uint64)
        known = np.sort(known.view(np.uint64))
        out: list[pa.RecordBatch] = []
        made: list[tuple] = []
        docs = docs.sort_by([("doc", "ascending"), ("tie", "ascending")])
        for doc, tie, text in zip(docs.column("doc").to_pylist(), docs.column("tie").to_pylist(), docs.column("text"), strict=True):
            data = _bytes(text)
            if len(data) < LENGTH or not len(known):
                continue
            h, least = anchors(data)
            start, count, twice = window_runs(h, least)
            mine = least[start]
            use = known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine
            if not use.any():
                continue
            start, count, mine, twice = start[use], count[use], mine[use], twice[use]
            size = count + LENGTH - 1
            span = start[:, None] + np.arange(KEY - 9)
            body = np.where(np.arange(KEY - 9) < size[:, None], data[np.minimum(span, len(data) - 1)], 0).astype(np.uint8)
            made.append((np.concatenate([_mixed(mine).astype(">u8").view(np.uint8).reshape(-1, 8), size[:, None].astype(np.uint8), body], 1), np.full(len(start), doc), np.full(len(start), tie), start, count, twice, np.isin(mine, often)))
        if made:
            columns = [list(x) for x in zip(*made, strict=True)]
            made.clear()
            keys, doc, tie, start, count, twice, hot = (np.concatenate(columns.pop(0)) for _ in range(7))
            order = np.argsort(np.ascontiguousarray(keys).view(f"S{KEY}").ravel(), kind="stable")
            keys = keys[order]
            doc, tie, start, count, twice, hot = (x[order] for x in (doc, tie, start, count, twice, hot))
            same = np.zeros(len(keys), bool)
            for at in range(1, len(keys), 1 << 14):
                same[at : at + (1 << 14)] = (keys[at : at + (1 << 14)] == keys[at - 1 : at - 1 + len(keys[at : at + (1 << 14)])]).all(1)
            first = np.flatnonzero(~same)[np.cumsum(~same) - 1]
            # a fully repeated row stands at the same place and is no repeat
            gone = same & ((doc != doc[first]) | (tie != tie[first]) | (start != start[first]))
            if gone.any():
                d, t, s, n = (x[gone] for x in (doc, tie, start, count))
                o = np.lexsort((s, t, d))
                d, t, s, n = d[o], t[o], s[o], n[o]
                new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] != s[:-1] + n[:-1])]))
                out.extend(_rows(REPEAT, d[new], t[new], s[new], np.add.reduceat(n, new)))
            keep = ~same
            keys, doc, tie, start, count, twice, hot = (x[keep] for x in (keys, doc, tie, start, count, twice, hot))
            to = (np.ascontiguousarray(keys[:, :8]).view(">u8").ravel().astype(np.uint64) >> _U(32)) * _U(buckets) >> _U(32)
            if hot.any():
                to[hot] = (_mixed((keys[hot].astype(np.uint64) * _UP[:KEY]).sum(1, dtype=np.uint64)) >> _U(32)) * _U(buckets) >> _U(32)
            flag = count | (twice.astype(np.int64) << 7)
            to = to.astype(np.int64) + np.where(hot, buckets, 0)
            order = np.argsort(to, kind="stable")  # keys stay in order
            edge = np.append(np.flatnonzero(np.concatenate([[True], to[order][1:] != to[order][:-1]])), len(order))
            for x, y in zip(edge, edge[1:], strict=False):
                at = order[x:y]
                block = front_coded(keys[at], keys[at, 8].astype(np.int64) + 9, [doc[at].astype("<i8"), tie[at].astype("<i8"), start[at].astype("<i4"), flag[at].astype("u1")])
                out.append(_batch(_NAMES, _KINDS, [BLOCK], [int(to[at[0]])], [None], [None], [None], [None], [block]))
        return pa.Table.from_batches(out, schema=pa.schema(list(zip(_NAMES, _KINDS, strict=True))))

    return run


def _merged_range(buckets: int):
    """The step at a key range: merge its runs; repeats, and for hot anchors the windows of what is left."""

    def run(table: pa.Table) -> pa.Table:
        parts = [decoded(b.as_py()) for b in table.column("block")]
        hot = table.column("bucket")[0].as_py() >= buckets
        out: list[pa.RecordBatch] = []
        gone: list[tuple[int, int]] = []
        kept: list[tuple[int, int]] = []
        best, size = None, 0

        def place(x: tuple[int, int]) -> tuple:
            c = parts[x[0]][2]
            return c[0][x[1]], c[1][x[1]], c[2][x[1]]

        for key, shared, r, i in merged([p[:2] for p in parts]):
            if best is not None and shared == len(key) == size:
                a, b = place(best), place((r, i))
                if b < a:
                    gone.append(best)
                    best = (r, i)
                elif b > a:
                    gone.append((r, i))
            else:
                if best is not None:
                    kept.append(best)
                best, size = (r, i), len(key)
        if best is not None:
            kept.append(best)

        def columns(of: list[tuple[int, int]]) -> list[np.ndarray]:
            run_of, at = np.array(of, np.int64).reshape(-1, 2).T
            outs = []
            for c in range(4):
                offs = np.concatenate([[0], np.cumsum([len(p[2][c]) for p in parts])])
                outs.append(np.concatenate([p[2][c] for p in parts]).astype(np.int64)[offs[run_of] + at])
            return outs

        if gone:
            d, t, s, n = columns(gone)
            out.extend(_rows(REPEAT, d, t, s, n & 127))
        if kept:
            d, t, s, n = columns(kept)
            head = np.frombuffer(b"".join(parts[r][0][i][:8] for r, i in kept), ">u8")
            new = np.concatenate([[True], head[1:] != head[:-1]])
            group = np.diff(np.append(np.flatnonzero(new), len(head)))
            use = np.repeat(group > 1, group) | (n > 127) | hot
            at = np.flatnonzero(use)
            for cut in _chunks(head[at]):
                some = at[cut]
                keys = np.frombuffer(b"".join(parts[r][0][i].ljust(KEY, b"\0") for r, i in (kept[j] for j in some)), np.uint8).reshape(-1, KEY)
                d1, t1, s1, n1 = d[some], t[some], s[some], n[some] & 127
                if hot:
                    row = np.repeat(np.arange(len(keys)), n1)
                    offset = np.arange(len(row)) - np.repeat(np.cumsum(n1) - n1, n1)
                    for at in range(0, len(row), 1 << 16):
                        r, o = row[at : at + (1 << 16)], offset[at : at + (1 << 16)]
                        out.extend(_rows(WINDOW, d1[r], t1[r], s1[r] + o, np.ones(len(r), np.int64), keys[r[:, None], o[:, None] + np.arange(9, 9 + LENGTH)]))
                else:
                    row, offset = windows_repeated(keys, d1, t1, s1, n1)
                    if len(row):  # neighbours go back as one row
                        order = np.lexsort((offset, row))
                        row, offset = row[order], offset[order]
                        new = np.concatenate([[True], (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)])
                        runs = np.diff(np.append(np.flatnonzero(new), len(row)))
                        out.extend(_rows(REPEAT, d1[row[new]], t1[row[new]], s1[row[new]] + offset[new], runs))
        return pa.Table.from_batches(out, schema=pa.schema(list(zip(_NAMES, _KINDS, strict=True))))

    return run


def _chunks(head: np.ndarray, size: int = 4000) -> Iterator[slice]:
    """Slices of whole groups, of about ``size`` rows."""
    at = 0
    ends = np.append(np.flatnonzero(head[1:] != head[:-1]) + 1, len(head))
    while at < len(head):
        end = int(ends[min(np.searchsorted(ends, at + size), len(ends) - 1)])
        yield slice(at, end)
        at = end


def _cut(docs: pa.Table, repeats: pa.Table) -> pa.Table:
    """The last step at a part: its documents without what repeats."""
    d, t, s, n = (repeats.column(c).to_numpy() for c in ("doc", "tie", "start", "n"))
    order = np.lexsort((s, t, d))
    d, t, s, n = d[order], t[order], s[order], n[order]
    rows = []
    for doc_id, doc, tie, copies, text in zip(*(docs.column(c).to_pylist() for c in ("doc_id", "doc", "tie", "copies")), docs.column("text"), strict=True):
        data = _bytes(text)
        low, high = np.searchsorted(d, doc), np.searchsorted(d, doc, "right")
        low, high = low + np.searchsorted(t[low:high], tie), low + np.searchsorted(t[low:high], tie, "right")
        gone = np.zeros(len(data) + 1, np.int64)
        if high > low:
            np.add.at(gone, s[low:high], 1)
            np.add.at(gone, s[low:high] + n[low:high] + LENGTH - 1, -1)
            gone = np.cumsum(gone)
        out = gone[:-1] > 0
        spans = int((out & ~np.concatenate([[False], out[:-1]])).sum()) if len(out) else 0
        kept = data[~out].tobytes()
        rows.append((doc_id, len(data), int(out.sum()), spans, hashlib.sha256(kept).hexdigest(), copies))
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "copies"])


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("doc", "tie"), F.lit(parts)).cast("int").alias("part")


def repeated(docs: DataFrame, hot: int = HOT, part: int = PART) -> tuple[DataFrame, DataFrame]:
    """(documents by part, repeats): repeats has doc, tie, start, n: n windows from byte ``start`` on also start earlier."""
    spark = docs.sparkSession
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part))
    twice = not docs.groupBy(doc.alias("d")).count().filter("count > 1").isEmpty()
    tie = F.xxhash64("text") if twice else F.lit(0).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc.alias("doc"), tie.alias("tie"), "text", F.lit(1).cast("long").alias("copies"))
    if twice:  # rows that repeat id and text become one, so that no part gets them all
        rows = rows.groupBy("doc_id", "doc", "tie", F.octet_length("text").alias("_b")).agg(F.first("text").alias("text"), F.count("*").alias("copies")).drop("_b")
        rows = written(rows, "rows")
    rows = rows.select("*", _part(parts))
    wanted = written(_repeated_anchors(_anchor_rows(rows), parts, hot), "anchors")
    released(spark)
    often = wanted.filter("hot").select("h").distinct()
    # a hot hash is marked in every part that holds it: at most (all anchors / hot) hashes
    marked = wanted.filter("NOT hot").select("h", "part").join(often.withColumn("hot", F.lit(True)), "h", "left").select("h", "part", F.coalesce("hot", F.lit(False)).alias("hot"))
    buckets = max(1, -(-wanted.count() * 150 // RANGE))
    runs = rows.groupBy("part").cogroup(marked.groupBy("part")).applyInArrow(_sorted_runs(buckets), _OUT)
    runs = written(runs, "runs")
    has_hot = not often.isEmpty()
    del marked, often
    dropped(wanted)
    released(spark)
    ranged = runs.filter(F.col("kind") == BLOCK).select("bucket", "block").groupBy("bucket").applyInArrow(_merged_range(buckets), _OUT)
    ranged = written(ranged, "merged")
    released(spark)
    at = ["doc", "tie", "start", "n"]
    out = runs.filter(F.col("kind") == REPEAT).select(*at).unionByName(ranged.filter(F.col("kind") == REPEAT).select(*at))
    windows = ranged.filter(F.col("kind") == WINDOW).select(F.col("block").alias("window"), F.struct("doc", "tie", "start").alias("at"))
    if has_hot:
        first = windows.groupBy("window").agg(F.min("at").alias("first"), F.count("*").alias("rows")).filter("rows > 1").drop("rows")
        later = spread_join(windows, first, ["window"]).filter("at > first").select("at.*", F.lit(1).alias("n"))
        out = out.unionByName(later)
    return rows, out.select(*at, _part(parts))


def deduplicated(docs: DataFrame, hot: int = HOT, part: int = PART) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs."""
    rows, out = repeated(docs, hot, part)
    cut = rows.groupBy("part").cogroup(out.groupBy("part")).applyInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, copies long")
    return cut.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "_i")
