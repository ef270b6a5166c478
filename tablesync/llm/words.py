"""Hashes of words and of runs of words, for whole chunks of text at a time, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from tablesync.llm.common import BLANKS, mix64

CHUNK_BYTES = 2_000_000
_ODD = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=2)
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
    blank = np.zeros(256, bool)
    blank[list(BLANKS)] = True
    values[blank] = 0
    factor, inverse = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
    powers, inverses = np.full(size + 1, factor, np.uint64), np.full(size + 1, inverse, np.uint64)
    powers[0] = inverses[0] = 1
    return values, blank, np.multiply.accumulate(powers), np.multiply.accumulate(inverses)


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """For each text, a 64-bit hash of each of its words, in order."""
    joined = b"\n".join(texts)
    size = 1 << max(22, (len(joined) + 1).bit_length())
    values, blank, powers, inverses = _tables(size)
    octets = np.frombuffer(joined, np.uint8)
    gap = blank[octets]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values[octets] * powers[: len(octets)], dtype=np.uint64)])
    hashes = mix64((sums[ends] - sums[begins]) * inverses[begins] + (ends - begins).astype(np.uint64))
    stops = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.searchsorted(begins, stops)
    return np.split(hashes, cuts[:-1]) if len(texts) else []


def run_hashes(words: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """A hash of each run of ``length`` words; empty if there are fewer words."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    factor = np.uint64((seed * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB) & ((1 << 64) - 1) | 1)
    power, span = words, 1
    total, done, shift = None, 0, length
    scale = int(factor)
    while True:
        if shift & 1:
            part = power[done : done + len(words) - length + 1] if total is not None else power[: len(words) - length + 1]
            total = part.copy() if total is None else total * np.uint64(scale) + part
            done += span
        shift >>= 1
        if not shift:
            return mix64(total)
        power = power[:-span] * np.uint64(scale) + power[span:]
        scale = scale * scale & ((1 << 64) - 1)
        span *= 2


def sliding(values: np.ndarray, length: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``length`` values."""
    span, found = 1, values
    while span * 2 <= length:
        found = pick(found[:-span], found[span:])
        span *= 2
    rest = length - span
    return pick(found[: len(found) - rest], found[rest:]) if rest else found


def winnowed(hashes: np.ndarray, length: int) -> np.ndarray:
    """Places of hashes that are the least in some run of ``length`` of them (of all, if fewer)."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    length = min(length, len(hashes))
    least = sliding(hashes, length, np.minimum)
    pad = np.zeros(length - 1, np.uint64)
    around = sliding(np.concatenate([pad, least, pad]), length, np.maximum)
    return np.flatnonzero(around == hashes)
