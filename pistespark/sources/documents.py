"""Reading one JSON document in parallel: the objects of its arrays, one row each, from files that Spark splits by bytes.

A document such as a feature collection is one value, so Spark's JSON reader gives a whole file to one task. Here a file is
read as text whose lines end at ``}``, which Spark splits like any other, and where an object ends is told by counting:

1. For each split: how many quotes it has, and its braces and brackets, once for a split that begins outside of a string and once
   for one that begins within. From these, in the order of the splits, follows with what each one begins.
2. Then the objects that end in each split are counted. What it has of objects that begin or end elsewhere is kept in a table.
3. Then each split gives the objects that lie in it, with their numbers; those that are cut are put together from that table.

So the files are read three times, and of their text only the objects that are cut by an edge of a split are shuffled. A task
holds one batch of rows and one object, the driver gets a row for each split and step, and numbers do not depend on how files
are split. Steps must see the same splits: where these change in between, as when executors come or go, there is an error. A
file that is compressed as a whole is one split.

What stands around the array (the document's other fields) is skipped. An array of a keyed document (a collection for
each layer) is read as well; its objects are numbered through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pistespark.shared import settled, written

_QUOTE, _BACKSLASH, _OPEN, _CLOSE, _ARRAY = b'"\\{}['
_MARKS = np.zeros(256, bool)
_MARKS[list(b'"{}[]')] = True
_BRACE, _BRACKET = np.zeros(256, np.int8), np.zeros(256, np.int8)
_BRACE[list(b"{}")] = _BRACKET[list(b"[]")] = 1, -1

_COUNTS = "file string, block long, quotes long, braces array<long>, brackets array<long>, around array<long>"
_EDGES = "file string, block long, lead long, later long, named boolean, head binary, ended boolean, tail binary"
_OBJECTS = "file string, ordinal long, value binary"


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, int, np.ndarray]]:
    """The bytes of a batch, split by split."""
    file, block, value = batch.columns
    n = len(batch)
    cuts = [0, n]
    if n and (file[0] != file[n - 1] or block[0] != block[n - 1]):
        other = [pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False) for c in (file, block)]
        cuts = [0, *(np.flatnonzero(other[0] | other[1]) + 1).tolist(), n]
    _, at, text = value.buffers()
    at = np.frombuffer(at, np.int64 if pa.types.is_large_binary(value.type) else np.int32)[value.offset : value.offset + n + 1]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield file[a].as_py(), block[a].as_py(), np.frombuffer(text, np.uint8)[at[a] : at[b]]


def _marks(data: np.ndarray, quotes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of braces and brackets, their bytes, and how many quotes (modulo 2) are before each and in all. quotes: those before ``data``,
    which ends at a brace and so never within an escape."""
    at = np.flatnonzero(_MARKS[data])
    kind = data[at]
    quote = kind == _QUOTE
    back = np.flatnonzero(data == _BACKSLASH)
    if len(back):  # every other backslash of a row of them escapes the byte behind it
        first = np.maximum.accumulate(np.where(np.diff(back, prepend=-2) != 1, back, 0))
        escaped = np.zeros(len(data) + 1, bool)
        escaped[back[(back - first) % 2 == 0] + 1] = True
        quote, seen = quote & ~escaped[at], kind == _QUOTE
    else:
        seen = quote
    before = (np.cumsum(quote) + quotes) & 1
    return at[~seen], kind[~seen], before[~seen], int(before[-1]) if len(before) else quotes


class _Counts:
    """Step 1. Of two numbers the first is for a split that begins outside of a string, the second for one that begins within."""

    def __init__(self, file: str, block: int) -> None:
        self.quotes, self.braces, self.brackets = 0, [0, 0], [0, 0]
        self.around: list[int | None] = [None, None]  # braces before the first bracket

    def feed(self, data: np.ndarray) -> None:
        _, kinds, before, self.quotes = _marks(data, self.quotes)
        for s in (0, 1):
            kind = kinds[before == s]
            if self.around[s] is None and (kind == _ARRAY).any():
                self.around[s] = self.braces[s] + int(_BRACE[kind[: np.argmax(kind == _ARRAY)]].sum())
            self.braces[s] += int(_BRACE[kind].sum())
            self.brackets[s] += int(_BRACKET[kind].sum())

    def end(self) -> dict:
        return {"quotes": self.quotes, "braces": self.braces, "brackets": self.brackets, "around": self.around}


class _Objects:
    """The objects of named arrays in a split. around: braces around an array; named: whether the array that the split begins in, if any, is."""

    def __init__(self, key: str, quotes: int, braces: int, brackets: int, around: int | None, named: bool) -> None:
        self.key, self.quotes, self.braces, self.brackets, self.around, self.named = key.encode(), quotes, braces, brackets, around, named
        self.held: list[bytes] | None = [] if named and around is not None and brackets > 0 and braces > around else None  # an object so far
        self.lead = self.later = 0  # objects that end in the array that the split begins in, and in others
        self.other = False  # whether another array has begun

    def _is_named(self, before: bytes) -> bool:
        text = before.rstrip(b" \t\r\n")
        return text.endswith(b":") and text[:-1].rstrip(b" \t\r\n").endswith(b'"' + self.key + b'"')

    def feed(self, data: np.ndarray) -> list[bytes]:
        """The objects that end in these bytes."""
        at, kind, before, quotes = _marks(data, self.quotes)
        outside = before == 0
        at, kind = at[outside], kind[outside]
        braces, brackets = self.braces + np.cumsum(_BRACE[kind]), self.brackets + np.cumsum(_BRACKET[kind])
        self.quotes = quotes
        if len(at):
            self.braces, self.brackets = int(braces[-1]), int(brackets[-1])
        if self.around is None:
            return []
        level = brackets == 1
        arrays = np.flatnonzero((kind == _ARRAY) & level)
        opens = at[arrays]
        # the name of an array stands behind the last brace before it
        names = [bool(braces[i] == self.around) and self._is_named(data[(at[i - 1] + 1 if i else 0) : at[i]].tobytes()) for i in arrays]
        flags = np.array([self.named, *names])
        starts, ends = at[(kind == _OPEN) & level & (braces == self.around + 1)], at[(kind == _CLOSE) & level & (braces == self.around)]
        starts, ends = (p[flags[np.searchsorted(opens, p)]] for p in (starts, ends))
        lead = 0 if self.other else int(np.searchsorted(ends, opens[0])) if len(opens) else len(ends)
        self.lead, self.later = self.lead + lead, self.later + len(ends) - lead
        self.other, self.named = self.other or len(opens) > 0, bool(flags[-1])
        out = []
        text, done = data.tobytes(), 0
        first = np.searchsorted(starts, np.concatenate([[0], ends])).tolist()  # the first start behind each end
        starts = starts.tolist()
        for i, end in enumerate(ends.tolist()):
            if self.held is not None:
                out.append(b"".join([*self.held, text[: end + 1]]))
                self.held = None
            else:
                begin = starts[first[i]] if first[i] < len(starts) else done
                out.append(text[min(begin, end) : end + 1])
            done = end + 1
        if self.held is not None:
            self.held.append(text)
        elif first[-1] < len(starts):
            self.held = [text[starts[first[-1]] :]]
        return out


class _Edges:
    """Step 2, as if the array that a split begins in were named, which is not known before all splits are seen."""

    def __init__(self, scan: _Objects) -> None:
        self.scan, self.begun, self.head = scan, scan.held is not None, None

    def feed(self, data: np.ndarray) -> None:
        found = self.scan.feed(data)
        if self.begun and self.head is None and found:
            self.head = found[0]

    def end(self) -> dict:
        s, ended = self.scan, self.head is not None
        held = b"".join(s.held) if s.held is not None else None
        through = self.begun and not ended
        return {"lead": s.lead, "later": s.later, "named": s.named if s.other else None, "head": held if through else self.head, "ended": ended, "tail": None if through else held}


class _Numbered:
    """Step 3. An object that begins in an earlier split is left out, but counts."""

    def __init__(self, scan: _Objects, number: int, count: int) -> None:
        self.scan, self.number, self.count, self.skip = scan, number, count, scan.held is not None

    def feed(self, data: np.ndarray) -> dict | None:
        found = self.scan.feed(data)
        if not found:
            return None
        numbers = range(self.number, self.number + len(found))
        self.number += len(found)
        n, self.skip = int(self.skip), False
        return {"ordinal": list(numbers)[n:], "value": found[n:]}

    def end(self) -> None:
        if self.scan.lead + self.scan.later != self.count:
            raise ValueError("the files or their splits have changed since they were counted")


def _by_split(begin: Callable, schema: pa.Schema, rows: bool = False) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What ``begin(file, block)`` gives for each split, fed with its bytes: a row at its end or, with ``rows``, columns while it is fed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None

        def ended() -> Iterator[pa.RecordBatch]:
            row = state.end() if state is not None else None
            if row is not None:
                yield pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1]} | row], schema)

        for batch in batches:
            for file, block, data in _stretches(batch):
                if (file, block) != key:
                    yield from ended()
                    key, state = (file, block), begin(file, block)
                got = state.feed(data)
                if rows and got and got["value"]:
                    yield pa.RecordBatch.from_pydict({"file": [file] * len(got["value"])} | got, schema)
        yield from ended()

    return run


def _mapped(raw: DataFrame, begin: Callable, schema: str, rows: bool = False) -> DataFrame:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return raw.mapInArrow(_by_split(begin, pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]), rows), schema)


def _begins(counts: list[Row]) -> dict[tuple[str, int], tuple]:
    """(quotes modulo 2, braces, brackets) before each split and the braces around its file's arrays, if it has any."""
    out: dict[tuple[str, int], tuple] = {}
    for file, splits in groupby(sorted(counts, key=lambda r: (r["file"], r["block"])), lambda r: r["file"]):
        quotes = braces = brackets = 0
        around, own = None, []
        for r in splits:
            own.append((r["block"], quotes, braces, brackets))
            if around is None and r["around"][quotes] is not None:
                around = braces + r["around"][quotes]
            braces, brackets, quotes = braces + r["braces"][quotes], brackets + r["brackets"][quotes], quotes ^ r["quotes"]
        out |= {(file, block): (*state, around) for block, *state in own}
    return out


def _found(known: dict, file: str, block: int) -> tuple:
    if (file, block) not in known:
        raise ValueError("the files or their splits have changed since they were counted")
    return known[file, block]


def objects(spark: SparkSession, path: str | list[str], key: str) -> DataFrame:
    """file, ordinal, value: the text of each object in the arrays named ``key`` of the documents under a path."""
    raw = spark.read.option("lineSep", "}").text(path)
    # the brace that ends a piece belongs to it
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.concat("value", F.lit("}")).cast("binary").alias("value"))
    begins = _begins(_mapped(raw, _Counts, _COUNTS).collect())
    edges = written(_mapped(raw, lambda file, block: _Edges(_Objects(key, *_found(begins, file, block), True)), _EDGES), "edges")
    # a row for each split: whether the array that it begins in is named, its objects, and those before it
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = edges.select("file", "block", "lead", "later", F.coalesce(F.last("named", ignorenulls=True).over(earlier), F.lit(False)).alias("within"))
    splits = splits.select("file", "block", "within", (F.when(F.col("within"), F.col("lead")).otherwise(0) + F.col("later")).alias("n"))
    splits = settled(splits.withColumn("number", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "splits")
    known = {(r["file"], r["block"]): (r["within"], r["number"], r["n"]) for r in splits.collect()}

    def begin(file: str, block: int) -> _Numbered:
        within, number, n = _found(known, file, block)
        return _Numbered(_Objects(key, *begins[file, block], within), number, n)

    whole = _mapped(raw, begin, _OBJECTS, rows=True)
    part = lambda ordinal, value, ended: F.struct(ordinal.alias("ordinal"), value.cast("string").alias("value"), ended.alias("ended"))
    head: Column = F.when(F.col("within"), part(F.col("number"), F.col("head"), F.col("ended")))
    tail: Column = F.when(F.col("within") | F.col("named").isNotNull(), part(F.col("number") + F.col("n"), F.col("tail"), F.lit(False)))
    cut = edges.join(splits, ["file", "block"]).select("file", "block", F.explode(F.array(head, tail)).alias("p")).filter("p.value IS NOT NULL")
    cut = cut.groupBy("file", F.col("p.ordinal").alias("ordinal")).agg(F.array_sort(F.collect_list(F.struct("block", "p.value"))).alias("parts"), F.max("p.ended").alias("ended")).filter("ended")
    return whole.withColumn("value", F.col("value").cast("string")).unionByName(cut.select("file", "ordinal", F.array_join(F.transform("parts", lambda x: x["value"]), "").alias("value")))
