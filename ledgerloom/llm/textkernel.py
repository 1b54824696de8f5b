"""Words and shingles of whole texts as 64-bit hashes, worked out over Arrow buffers inside a task."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=U) * U(2) + U(1)
_STEP = int(_RNG.integers(1, 2**61)) * 8 + 5
_BACK = pow(_STEP, -1, 2**64)
_PLACE = _RNG.integers(1, 2**63, 16, dtype=U) * U(2) + U(1)
#: [\x20\x09-\x0D]
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: bytes looked at in one go; a single text may be longer and is then cut at white space
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = x + U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


class _Powers:
    up = np.ones(1, U)
    down = np.ones(1, U)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n + 1:
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.concatenate([np.ones(1, U), np.full(n, U(_STEP))]), dtype=U)
                cls.down = np.cumprod(np.concatenate([np.ones(1, U), np.full(n, U(_BACK))]), dtype=U)
        return cls.up[: n + 1], cls.down[: n + 1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each span of bytes, by one running sum over the buffer."""
    if not len(starts):
        return np.zeros(0, U)
    n = len(data)
    up, down = _Powers.to(n)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, U)
        np.cumsum(_BYTE[data] * up[:n], out=run[1:])
        return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of one text: hash, start and end byte."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a column and n + 1 offsets; null is empty."""
    column = column.fill_null("").cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column.fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def _pieces(raw: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the buffer into about CHUNK bytes, between texts or at white space."""
    at, end = 0, len(raw)
    while at < end:
        to = min(end, at + CHUNK)
        if to < end:
            k = int(np.searchsorted(offs, to, "right")) - 1
            if offs[k] > at:
                to = int(offs[k])
            else:
                while to < end and not WHITE[raw[to]] and to < offs[k + 1]:
                    to += 1
        yield at, to
        at = to


def words_of(raw: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word [^\\x20\\x09-\\x0D]+, and for each text the index of its first word (n + 1 values)."""
    hashes, starts, ends = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    border = offs[(offs > 0) & (offs < len(raw))]
    for a, z in _pieces(raw, offs):
        data = raw[a:z]
        solid = ~WHITE[data]
        first, last = solid.copy(), solid.copy()
        inner = border[(border > a) & (border < z)] - a
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        first[inner] = solid[inner]
        last[inner - 1] = solid[inner - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        hashes.append(span_hashes(_LOWER[data] if lower else data, s, e))
        starts.append(s + a)
        ends.append(e + a)
    s = np.concatenate(starts)
    return np.concatenate(hashes), s, np.concatenate(ends), np.searchsorted(s, offs, "left")


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each window of that many words; fewer words make one window, none make none."""
    n = len(words)
    if not n:
        return words
    k = min(size, n)
    with np.errstate(over="ignore"):
        total = np.full(n - k + 1, U(k))
        for i in range(k):
            total += words[i : n - k + 1 + i] * _PLACE[i]
    return mix(total)


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows with about `limit` bytes of text, one row at least, so that a batch's arrays stay small."""
    _, offs = text_bytes(column)
    at, n = 0, len(column)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each text its set of shingles over words in a-z for A-Z, as sorted distinct hashes."""
    for a, z in slices(column):
        raw, offs = text_bytes(column.slice(a, z - a))
        hashes, _, _, at = words_of(raw, offs, lower=True)
        for i in range(len(offs) - 1):
            yield np.unique(windows(hashes[at[i] : at[i + 1]], size))
