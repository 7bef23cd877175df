"""Hashes of words and of runs of words, in numpy over many texts at once.

A word is a run of ASCII word characters, or any other character beyond ASCII alone.  Equal runs have equal hashes (in any
case of A-Z where ``fold`` is set); different runs may share one, so whoever looks runs up compares the texts afterwards."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes hashed at once; a longer text is cut where no word goes on.
PIECE = 1 << 19
_CUT = re.compile(rb"[^A-Za-z0-9_\x80-\xBF]")
_KIND = np.zeros(256, "uint8")
_KIND[[i for i in range(128) if chr(i).isalnum() or chr(i) == "_"]] = 1
_KIND[0x80:0xC0], _KIND[0xC0:] = 3, 2
_draw = np.random.default_rng(20_261_201)
_PLAIN = _draw.integers(1, 2**63, 256, "uint64")
_FOLDED = _PLAIN.copy()
_FOLDED[ord("A"):ord("Z") + 1] = _PLAIN[ord("a"):ord("z") + 1]
_STEP, *_PLACE = _draw.integers(1, 2**63, 12, "uint64") | np.uint64(1)
_SHIFT = np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _PLACE[-1]
    return x ^ (x >> _SHIFT)


def _piece(data: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = _KIND[data]
    before = np.concatenate((_KIND[:1], kind[:-1]))
    inside = np.flatnonzero(kind)
    first = ((kind == 1) & (before != 1)) | (kind == 2)
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, "uint64"), starts
    heads = np.flatnonzero(first[inside])
    place = np.arange(len(inside)) - np.repeat(heads, np.diff(heads, append=len(inside)))
    powers = np.cumprod(np.full(int(place.max()) + 1, _STEP))
    return _mixed(np.add.reduceat(values[data[inside]] * powers[place], heads)), starts


def joined(texts: Sequence[bytes]) -> tuple[bytes, np.ndarray]:
    """(all texts with a line end after each, where each ends)."""
    return b"".join(t + b"\n" for t in texts), np.cumsum([len(t) + 1 for t in texts]) - 1


def word_hashes(data: bytes, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word."""
    values = _FOLDED if fold else _PLAIN
    hashes, starts, at = [np.empty(0, "uint64")], [np.empty(0, "int64")], 0
    while at < len(data):
        cut = _CUT.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        h, s = _piece(np.frombuffer(data, "uint8", end - at, at), values)
        hashes.append(h)
        starts.append(s + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on (at most eight)."""
    size = max(0, len(words) - n + 1)
    out = np.full(size, n, "uint64")
    for i in range(n):
        out += words[i:i + size] * _PLACE[i]
    return _mixed(out)


def runs(data: bytes, ends: np.ndarray, sizes: Sequence[int], fold: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per size: (hash, start, number of the text) of every run within one text."""
    words, starts = word_hashes(data, fold)
    owner = np.searchsorted(ends, starts)
    for n in sizes:
        size = max(0, len(words) - n + 1)
        whole = owner[:size] == owner[n - 1:]
        yield run_hashes(words, n)[whole], starts[:size][whole], owner[:size][whole]


def openings(texts: Sequence[bytes], most: int, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: its number of words, at most ``most``, the hash of so many first words, and the bytes before them."""
    data, ends = joined(texts)
    words, starts = word_hashes(data, fold)
    owner = np.searchsorted(ends, starts)
    first = np.searchsorted(owner, np.arange(len(texts)))
    sizes = np.minimum(np.bincount(owner, minlength=len(texts)), most)
    hashes, lead = np.zeros(len(texts), "uint64"), np.zeros(len(texts), "int64")
    for n in range(1, most + 1):
        hashes[sizes == n] = run_hashes(words, n)[first[sizes == n]]
    some = sizes > 0
    lead[some] = (starts[first[some]] - np.concatenate(([0], ends[:-1] + 1))[some]) if some.any() else 0
    return sizes, hashes, lead
