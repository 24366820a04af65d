"""Words of a text as numbers: where they lie in its bytes, and 64-bit hashes of them and of runs of them, in numpy.

A text goes through in stretches of at most STRETCH bytes that end between words, so memory stays at some tens of
bytes for each byte of a stretch however long the text is; a word of STRETCH bytes or more is hashed by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

STRETCH = 1 << 18
_U = np.uint64
_MIX = _U(0xD6E8FEB86659FD93)
#: Two odd bases, so that two hashes of one word are independent.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(STRETCH + 1, _U(b), np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


_POWERS = [_powers(b) for b in BASES]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _MIX
    return x ^ (x >> _U(32))


def table(chars: bytes) -> np.ndarray:
    """Which of the 256 bytes are among ``chars``."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: What lies between words: ASCII white space.
SPACES = table(b"\x20\x09\x0a\x0b\x0c\x0d")


def raw(text: pa.Scalar) -> bytes:
    """UTF-8 of a text; nothing for a null."""
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def stretches(stop: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to) of stretches that end after a stop; longer than STRETCH where a word is."""
    at, n = 0, len(stop)
    while n - at > STRETCH:
        inside = np.flatnonzero(stop[at : at + STRETCH])
        if len(inside):
            end = at + int(inside[-1]) + 1
        else:
            after = stop[at + STRETCH :]
            end = at + STRETCH + int(after.argmax()) + 1 if after.any() else n
        yield at, end
        at = end
    yield at, n


def spans(stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end, a word being a run without stops."""
    edge = np.diff(np.concatenate([[0], (~stop).view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hashed(data: np.ndarray, stop: np.ndarray, n_hashes: int = 1) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(starts, ends, hashes) of all words of a text; each of the hashes has an entry per word."""
    starts, ends, found = [], [], []
    for at, to in stretches(stop):
        start, end = spans(stop[at:to])
        size = end - start
        many = []
        for k in range(n_hashes):
            if to - at > STRETCH:  # one word
                h = np.zeros(len(start), np.uint64)
            else:
                up, down = _POWERS[k]
                total = np.zeros(to - at + 1, np.uint64)
                np.cumsum((data[at:to] + _U(1)) * up[: to - at], dtype=np.uint64, out=total[1:])
                h = mixed((total[end] - total[start]) * down[start] + size.astype(np.uint64) * _U(BASES[1 - k]))
            for i in np.flatnonzero(size >= STRETCH):
                h[i] = xxhash.xxh64_intdigest(data[at + start[i] : at + end[i]].tobytes(), seed=k)
            many.append(h)
        starts.append(start + at)
        ends.append(end + at)
        found.append(many)
    return np.concatenate(starts), np.concatenate(ends), [np.concatenate([f[k] for f in found]) for k in range(n_hashes)]


def of_runs(h: np.ndarray, at: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """A hash of the ``length`` words from each place of ``at`` on, from the words' own hashes."""
    out = np.zeros(len(at), np.uint64)
    for i in range(length):
        out = out * _U(base) + h[at + i]
    return mixed(out)
