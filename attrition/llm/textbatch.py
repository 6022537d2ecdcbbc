"""Vectorised text helpers for Arrow batches: words, word hashes and shingles.

Texts are handled as UTF-8 bytes.  A word is a maximal run of bytes outside
``0x20, 0x09-0x0D`` (the same as ``[^\\x20\\x09-\\x0D]+`` on code points, since
UTF-8 never uses those bytes inside a longer sequence).  Null texts count as
empty ones.  Work is cut into chunks of about ``CHUNK`` bytes (whole documents)
so that the temporary arrays of a task stay small whatever the batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(32))
        h = h * _MIX
        h = h ^ (h >> np.uint64(32))
        h = h * _MIX
        return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_POW: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        size = max(n, CHUNK + 1)
        _POW["p"], _POW["i"] = _powers(_P, size), _powers(_P_INV, size)
    return _POW["p"], _POW["i"]


@dataclass
class Texts:
    """A chunk of documents: ``data[starts[i]:ends[i]]`` is document ``first + i`` of its batch."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.starts)

    def lower(self) -> Texts:
        return Texts(LOWER[self.data], self.starts, self.ends, self.first)

    def doc(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[Texts]:
    """Cut an Arrow string (or binary) column into chunks of whole documents."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = texts.cast(pa.large_binary())
    n = len(arr)
    if not n:
        return
    _, off_buf, data_buf = arr.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64, count=arr.offset + n + 1)[arr.offset :].copy()
    if arr.null_count:  # a null slot may still span bytes
        null = np.asarray(arr.is_null())
        length = np.diff(off)
        length[null] = 0
        kept = [off[i : i + 2] for i in np.flatnonzero(~null)]
        raw = memoryview(data_buf) if data_buf is not None else memoryview(b"")
        data = np.frombuffer(b"".join(bytes(raw[a:b]) for a, b in kept), dtype=np.uint8)
        off = np.concatenate([[0], np.cumsum(length)])
    else:
        data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        j = min(j, i + 65536, n)
        base = off[i]
        yield Texts(data[base : off[j]], off[i:j] - base, off[i + 1 : j + 1] - base, i)
        i = j
    release_memory()


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release_memory() -> None:
    """Hand freed memory back after a batch: a worker that waits should not hold what its last task used."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def words(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the words before each document (len + 1)."""
    ns = ~SPACES[t.data]
    full = t.ends > t.starts
    prev = np.empty(len(ns), dtype=bool)
    prev[1:] = ns[:-1]
    prev[t.starts[full]] = False
    ws = np.flatnonzero(ns & ~prev)
    prev[:-1] = ns[1:]
    prev[t.ends[full] - 1] = False
    we = np.flatnonzero(ns & ~prev) + 1
    bounds = np.concatenate([np.searchsorted(ws, t.starts), [len(ws)]])
    return ws, we, bounds


def hash_prefix(data: np.ndarray) -> np.ndarray:
    """Running polynomial of the bytes (length + 1), from which any span's hash follows."""
    n = len(data)
    p, _ = _power_tables(n + 1)
    acc = np.empty(n + 1, dtype=np.uint64)
    acc[0] = 0
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE_CODE[data] * p[:n], out=acc[1:])
    return acc


def span_hashes(prefix: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes ``s..e`` of every span (polynomial over the bytes, then mixed)."""
    _, inv = _power_tables(len(prefix))
    with np.errstate(over="ignore"):
        return mix64((prefix[e] - prefix[s]) * inv[s] + (e - s).astype(np.uint64) * _STEP)


def doc_of(bounds: np.ndarray) -> np.ndarray:
    """Document index of every word, from the bounds of :func:`words`."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(h: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles inside each document, and their document index.

    A document with 1..n-1 words has one shingle, its whole word sequence; one
    without words has none.  The hash covers the number of words in it.
    """
    doc = doc_of(bounds)
    count = np.diff(bounds)
    with np.errstate(over="ignore"):
        m = len(h) - n + 1
        if m > 0:
            acc = h[:m].copy()
            for k in range(1, n):
                acc = acc * _STEP + h[k : k + m]
            inside = doc[:m] == doc[n - 1 :]
            out, where = mix64(acc[inside] + np.uint64(n)), doc[:m][inside]
        else:
            out, where = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            extra = np.zeros(len(short), dtype=np.uint64)
            for k in range(n - 1):
                has = count[short] > k
                idx = bounds[:-1][short[has]] + k
                extra[has] = extra[has] * _STEP + h[idx]
            extra = mix64(extra + count[short].astype(np.uint64))
            out, where = np.concatenate([out, extra]), np.concatenate([where, short])
            order = np.argsort(where, kind="stable")
            out, where = out[order], where[order]
    return out, where


def crc_mod(ids: pa.Array, m: int) -> np.ndarray:
    """``crc32(id as text) mod m`` for an integer column (null ids: -1)."""
    import zlib

    return np.array([-1 if v is None else zlib.crc32(str(v).encode()) % m for v in ids.to_pylist()], dtype=np.int64)


def per_doc(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each range ``starts..ends`` (empty ranges: 0)."""
    total = np.zeros(len(flags) + 1, dtype=np.float64 if flags.dtype.kind == "f" else np.int64)
    np.cumsum(flags, out=total[1:])
    return total[np.maximum(ends, starts)] - total[starts]


def seen_before(key: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier in the array."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    out = np.zeros(len(key), dtype=bool)
    out[order[1:]] = k[1:] == k[:-1]
    return out


def repeated(key: np.ndarray) -> np.ndarray:
    """True where an equal key stands anywhere else in the array."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    out = np.zeros(len(key), dtype=bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out
