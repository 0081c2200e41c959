"""Hashes of byte strings from prefix sums modulo 2**64: the hash of buf[i:j] is the same wherever the bytes stand."""

from __future__ import annotations

import functools

import numpy as np

from .textarrays import mix

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@functools.lru_cache(maxsize=8)
def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            take = min(done, n - done)
            out[done:done + take] = out[:take] * np.uint64(pow(base, done, 1 << 64))
            done += take
    return out


class Rolling:
    """Prefix sums over ``buf`` (at most ``room`` bytes) for one of the two bases."""

    def __init__(self, buf: np.ndarray, room: int, which: int = 0):
        base = BASES[which]
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * powers(base, room)[:len(buf)], out=self.sums[1:])
        self.back = powers(pow(base, -1, 1 << 64), room)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, k: int) -> np.ndarray:
        """Hash of every k bytes in a row."""
        with np.errstate(over="ignore"):
            return mix((self.sums[k:] - self.sums[:-k]) * self.back[:len(self.sums) - k])


def sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over every ``width`` neighbours, by doubling."""
    span = 1
    while span < width:
        step = min(span, width - span)
        x = best(x[:-step], x[step:])
        span += step
    return x
