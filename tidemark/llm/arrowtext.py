"""Byte-level text helpers shared by the Arrow-batched operators.

A task receives Arrow batches from Spark and works on them in chunks of whole texts (about
``CHUNK_BYTES`` each, one longer text is a chunk of its own), so memory does not grow with the
partition.  Words are located and hashed with numpy on the UTF-8 bytes: every separator used by the
operators is ASCII, so byte positions and code-point positions split a text at the same places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK_BYTES = 4 << 20

U64 = np.uint64
_MASK = (1 << 64) - 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _splitmix(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random odd 64-bit numbers (splitmix64)."""
    out, x = [], seed
    for _ in range(n):
        x = (x + 0x9E3779B97F4A7C15) & _MASK
        z = x
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _MASK
        out.append((z ^ (z >> 31)) | 1)
    return np.array(out, dtype=U64)


BYTE_CODE = _splitmix(256, 11)
POSITION_CODE = _splitmix(64, 23)
_BASE = int(_splitmix(1, 37)[0])
_powers = np.ones(1, dtype=U64)
_inverse = np.ones(1, dtype=U64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; kept per worker, grown by doubling."""
    global _powers, _inverse
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        with np.errstate(over="ignore"):
            steps = np.full(size, _BASE, dtype=U64)
            steps[0] = 1
            _powers = np.cumprod(steps, dtype=U64)
            steps[1:] = pow(_BASE, -1, 1 << 64)
            _inverse = np.cumprod(steps, dtype=U64)
    return _powers, _inverse


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur3 fmix64)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def byte_class(pattern_bytes: bytes) -> np.ndarray:
    """Boolean table over byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(pattern_bytes)] = True
    return table


# FIXED VALUES of the word rules: white space, and characters outside [0-9a-z] below 0x80.
WHITE_SPACE = byte_class(b" \t\n\x0b\x0c\r")
NOT_ALNUM = byte_class(bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122)))


@dataclass
class Chunk:
    """Lower-cased bytes of consecutive texts: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    valid: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, lower: bool = True, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts of an Arrow string column, about ``limit`` bytes at a time; null texts are empty."""
    column = column.cast(pa.large_string())
    valid = np.asarray(column.is_valid())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        piece = data[offsets[lo]:offsets[hi]]
        yield Chunk(lo, LOWER[piece] if lower else piece, offsets[lo:hi + 1] - offsets[lo], valid[lo:hi])
        lo = hi


@dataclass
class Words:
    """Byte spans of the words of a chunk; text i holds words ``first[i]:first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(chunk: Chunk, separator: np.ndarray) -> Words:
    """Maximal runs of non-separator bytes, never across two texts."""
    sep = separator[chunk.data]
    n = len(sep)
    edges = chunk.offsets
    before = np.ones(n, dtype=bool)
    before[1:] = sep[:-1]
    inner = edges[(edges > 0) & (edges < n)]
    before[inner] = True
    after = np.ones(n, dtype=bool)
    after[:-1] = sep[1:]
    after[inner - 1] = True
    starts = np.flatnonzero(before & ~sep)
    ends = np.flatnonzero(after & ~sep) + 1
    return Words(starts, ends, np.searchsorted(starts, edges))


class SpanHasher:
    """64-bit hashes of byte spans of a chunk: differences of one running polynomial sum."""

    def __init__(self, chunk: Chunk):
        n = len(chunk.data)
        powers, self._inverse = _power_tables(n + 1)
        self._total = np.zeros(n + 1, dtype=U64)
        with np.errstate(over="ignore"):
            np.cumsum(BYTE_CODE[chunk.data] * powers[:n], dtype=U64, out=self._total[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._total[ends] - self._total[starts]) * self._inverse[starts] + (ends - starts).astype(U64))


def span_hashes(chunk: Chunk, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHasher(chunk)(starts, ends)


def hash_words(tokens: list[bytes]) -> np.ndarray:
    """``span_hashes`` of separate words (patterns, word lists)."""
    data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in tokens], dtype=np.int64) if tokens else np.zeros(0, np.int64)
    starts = ends - np.array([len(t) for t in tokens], dtype=np.int64)
    return span_hashes(Chunk(0, data, np.array([0, len(data)]), np.ones(1, bool)), starts, ends)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows and the window range of each text.

    A text of fewer than k words but at least one has its whole sequence as the only window."""
    counts = np.diff(first)
    n_windows = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(n_windows)))
    total = int(bounds[-1])
    text = np.repeat(np.arange(len(counts)), n_windows)
    at = np.arange(total) - bounds[text] + first[text]
    length = np.minimum(counts, k)[text]
    with np.errstate(over="ignore"):
        out = length.astype(U64) * POSITION_CODE[63]
        padded = np.concatenate((hashes, np.zeros(k, dtype=U64)))
        for j in range(k):
            out += np.where(j < length, padded[at + j], U64(0)) * POSITION_CODE[j]
        return mix(out), bounds


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: T.StructType) -> DataFrame:
    """``mapInArrow`` of a function from batch to batch."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)
