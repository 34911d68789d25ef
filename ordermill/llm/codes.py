"""Texts as numpy arrays of folded code points, and their words as 64-bit numbers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

CHUNK = 1 << 16
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def fold_table(digits: bool) -> np.ndarray:
    """Lower-case code point of every letter (and digit, if `digits`), 0 of everything else."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha() or digits and char.isalnum():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def folded(text: str, digits: bool) -> Iterator[np.ndarray]:
    """Folded code points, `CHUNK` of them at a time."""
    table = fold_table(digits)
    for at in range(0, len(text), CHUNK):
        yield table[np.frombuffer(text[at : at + CHUNK].encode("utf-32-le"), "<u4")]


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and their inverses."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for number in (_BASE, inverse):
        factors = np.full(size, number, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors))
    return tuple(out)


def _hashes(codes: np.ndarray, prefix: int = 0) -> np.ndarray:
    """One number per run of non-zero codes; equal runs have equal numbers.

    With `prefix`, of that many codes of each longer run only.
    """
    if not len(codes):
        return np.zeros(0, np.uint64)
    inside = codes > 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if prefix:
        long = ends - starts > prefix
        starts = starts[long]
        ends = starts + prefix
    size = 2 * CHUNK
    while size < len(codes):
        size *= 2
    up, down = _powers(size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[: len(codes)])])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= (h >> np.uint64(32)) ^ np.uint64(prefix)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(text: str, prefixes: tuple[int, ...] = ()) -> np.ndarray:
    """The words of a text (runs of letters and digits, folded) in order, as 64-bit hashes.

    Prefixes of the given lengths of longer words come as further hashes, in no order.
    """
    rest = np.zeros(0, np.uint32)
    out = []
    for codes in folded(text, True):
        codes = np.concatenate([rest, codes])
        gaps = np.flatnonzero(codes == 0)
        cut = gaps[-1] if len(gaps) else 0
        out += [_hashes(codes[:cut], size) for size in (0, *prefixes)]
        rest = codes[cut:]
    out += [_hashes(rest, size) for size in (0, *prefixes)]
    return np.concatenate(out)
