"""Vectorised work on the UTF-8 bytes of Arrow text columns, in chunks of about a megabyte."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U = np.uint64
#: An odd multiplier and its inverse modulo 2^64, for hashes of byte ranges.
P = 0x9E3779B97F4A7C15
P_INV = pow(P, -1, 1 << 64)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    o = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), o


def chunks(offsets: np.ndarray, limit: int = CHUNK):
    """Row ranges of at most `limit` bytes, of one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def lines(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line (split at newline bytes); offsets count from the start of buf."""
    nl = np.flatnonzero(buf == 10)
    per = np.searchsorted(nl, offsets[1:]) - np.searchsorted(nl, offsets[:-1]) + 1
    rows = np.repeat(np.arange(len(offsets) - 1), per)
    starts = np.sort(np.concatenate([offsets[:-1], nl + 1]), kind="stable")
    ends = np.sort(np.concatenate([nl, offsets[1:]]), kind="stable")
    return starts, ends, rows


@lru_cache(2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def up(p):
        out = np.full(n, p, U)
        out[0] = 1
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(out)

    return up(P), up(P_INV)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
        return h ^ (h >> U(31))


def range_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, equal for equal contents wherever they stand."""
    size = 1 << max(21, int(len(buf) + 1).bit_length())
    up, down = powers(size)
    with np.errstate(over="ignore"):
        total = np.zeros(len(buf) + 1, U)
        np.cumsum((buf.astype(U) + U(1)) * up[: len(buf)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes other than ASCII white space, not crossing rows."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = ~SPACE[buf]
    edge = inside[1:] != inside[:-1]
    cut = np.unique(offsets[1:-1])
    cut = cut[inside[cut] & inside[cut + 1]] if len(cut) else cut  # a row ends and the next begins without white space
    where = np.flatnonzero(edge)
    starts, ends = where[0::2], where[1::2]
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends


def class_counts(buf: np.ndarray, classes: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """For each class (256 booleans) the number of its bytes in each range. Three classes share a running sum where no range is
    longer than a field."""
    each = 3 if len(starts) == 0 or int((ends - starts).max()) < 1 << 21 else 1
    out = []
    for k in range(0, len(classes), each):
        table = sum((c.astype(U) << U(21 * i) for i, c in enumerate(classes[k : k + each])), np.zeros(256, U))
        total = np.zeros(len(buf) + 1, U)
        np.cumsum(table[buf], out=total[1:])
        got = total[ends] - total[starts]
        out += [((got >> U(21 * i)) & U((1 << 21) - 1 if each == 3 else (1 << 63) - 1)).astype(np.int64) for i in range(len(classes[k : k + each]))]
    return out
