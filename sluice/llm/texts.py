"""Column and byte helpers that several operators share."""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space bytes.
WORD = "[^ \\t-\\r]+"


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python in batches of at most 4 MB (or one longer row), so that batches of
    whole texts stay small on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` alone would also fold other letters."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = 1 << max(18, int(n).bit_length())
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.ones(n, np.uint64)
            table[1:] = np.uint64(base)
            tables.append(np.multiply.accumulate(table))
        _POWERS[:] = tables
    return _POWERS[0][:n], _POWERS[1][:n]


class SpanHash:
    """64-bit hashes of byte ranges of one buffer, each in constant time."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        # Bytes are spread first, so that neighbouring letters do not cancel.
        np.cumsum(_BYTES[data] * up[:len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def _groups(texts, size: int):
    """(first index, UTF-8 bytes of each) for runs of texts of about ``size`` bytes; null is empty."""
    group: list[bytes] = []
    first = length = 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if group and length + len(data) > size:
            yield first, group
            first, group, length = i, [], 0
        group.append(data)
        length += len(data)
    if group:
        yield first, group


#: Bytes after A-Z became a-z.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
#: What a word is made of: anything but ASCII white space; letters, digits and all beyond ASCII.
NOT_SPACE = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LETTERS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def words(texts, inside: np.ndarray, prefixes: tuple[int, ...] = (), size: int = 1 << 18):
    """Hashes of the lower-cased words of texts, in groups of texts: (first index, words of each
    text, hashes of the words, hashes of their first n bytes for each of ``prefixes``).  A text
    longer than ``size`` is a group by itself and is hashed in parts."""
    for first, group in _groups(texts, size):
        data = _LOWERED[np.frombuffer(b" ".join(group) + b" ", np.uint8)]
        starts, ends = spans(inside[data])
        bounds = np.cumsum([0] + [len(g) + 1 for g in group])
        counts = np.diff(np.searchsorted(starts, bounds))
        hashes: list[list[np.ndarray]] = [[] for _ in range(1 + len(prefixes))]
        at = 0
        while at < len(starts):
            low = starts[at]
            end = max(at + 1, int(np.searchsorted(ends, low + size)))
            a, b = starts[at:end] - low, ends[at:end] - low
            part = SpanHash(data[low:ends[end - 1]])
            hashes[0].append(part.of(a, b))
            for out, n in zip(hashes[1:], prefixes):
                out.append(part.of(a, np.minimum(b, a + n)))
            at = end
        whole = [np.concatenate(h) if h else np.zeros(0, np.uint64) for h in hashes]
        yield first, counts, whole[0], whole[1:]
