"""What several text operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.shared import fresh, shared_dir, table, written  # noqa: F401  (re-exported)

#: A word is a run of characters other than ASCII white space. ``bytes.split()`` cuts at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACES = [bytes([c]) for c in (0x20, *range(0x09, 0x0E))]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, is 2. A null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod == 2


def row_hash() -> Column:
    """A hash of a row's id and text: rows that repeat both have the same."""
    return F.xxhash64("doc_id", "text")


def thinned(df: DataFrame, keep: Column, hash_: Column) -> DataFrame:
    """Rows whose hash lies in a share ``keep`` of all hashes: a sample that any task can take alone and reruns repeat."""
    return df.filter(F.pmod(hash_, F.lit(1 << 30)) < keep * (1 << 30))


def plain(df: DataFrame) -> list[str]:
    """The columns that have an order, for picking one of several rows."""
    return [c for c, t in df.dtypes if "map<" not in t and t not in ("variant", "void")]


def one_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each group of equal keys, with all columns: the least. Tasks pick theirs before the shuffle."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    name = fresh(df.columns, "_row")[0]
    low = F.min_by(row, F.struct(*[F.col(f"`{c}`") for c in plain(df)])).alias(name)
    out = df.groupBy(*[F.col(f"`{k}`").alias(f"{name}_{i}") for i, k in enumerate(keys)]).agg(low)
    return out.select(*[F.col(name).getField(c).alias(c) for c in df.columns])


def salts(rows: int) -> int:
    """How many salts a table of ``rows`` rows is dealt by: the square root, so that a salt holds as many rows as there are salts."""
    return max(1, math.isqrt(rows))


def ranked(df: DataFrame, keys: list[str], order: list[str], salt: str, value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one of the same ``keys``.

    A running sum that no key, however large, brings into one task: rows are summed within (keys, salt),
    and the few salt totals of a key are summed in turn. Also adds ``_row``, the place within (keys, salt).
    """
    from pyspark.sql import Window

    near = Window.partitionBy(*keys, salt).orderBy(*order)
    far = Window.partitionBy(*keys).orderBy(salt)
    before = Window.unboundedPreceding
    inner = df.withColumn("_v", value).withColumn("_in", F.sum("_v").over(near.rowsBetween(before, Window.currentRow)) - F.col("_v"))
    inner = inner.withColumn("_row", F.row_number().over(near))
    totals = df.withColumn("_v", value).groupBy(*keys, salt).agg(F.sum("_v").alias("_t"))
    totals = totals.withColumn("_off", F.sum("_t").over(far.rowsBetween(before, Window.currentRow)) - F.col("_t")).drop("_t")
    return inner.join(totals, [*keys, salt]).withColumn(out, (F.col("_off") + F.col("_in")).cast("long")).drop("_v", "_in", "_off")


def slices(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text's bytes in slices of about ``size`` that end at ASCII white space: no word is cut, however long it is."""
    at = 0
    while len(data) - at > size:
        end = max(data.rfind(s, at, at + size) for s in SPACES)
        if end < at:  # one word from here on: up to its end
            end = min((e for s in SPACES if (e := data.find(s, at + size)) >= 0), default=len(data) - 1)
        yield data[at : end + 1]
        at = end + 1
    yield data[at:]
