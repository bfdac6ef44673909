"""Spark's random number generator (``XORShiftRandom``), many numbers at a time.

A step of the generator is linear over bits, so a table for each byte of the state gives the
state any number of steps ahead, and states are made in doubling blocks.
"""

from __future__ import annotations

import numpy as np

MASK = (1 << 32) - 1
# Seed of Scala's hash of arrays, which the generator mixes seeds with.
ARRAY_SEED = 0x3C074A61


def _rotated(x: int, by: int) -> int:
    return (x << by | x >> 32 - by) & MASK


def _hash(data: bytes, seed: int) -> int:
    """MurmurHash3 of whole words of 32 bits."""
    h = seed
    for i in range(0, len(data), 4):
        k = _rotated(int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & MASK, 15) * 0x1B873593 & MASK
        h = (_rotated(h ^ k, 13) * 5 + 0xE6546B64) & MASK
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & MASK
    h = (h ^ h >> 13) * 0xC2B2AE35 & MASK
    return h ^ h >> 16


def _step(states: np.ndarray) -> np.ndarray:
    states = states ^ (states << np.uint64(21))
    states = states ^ (states >> np.uint64(35))
    return states ^ (states << np.uint64(4))


def _tables(images: np.ndarray) -> np.ndarray:
    """What each value of each byte of a state becomes, from what each bit becomes."""
    out = np.zeros((8, 256), np.uint64)
    for bit in range(8):
        out ^= np.where(np.arange(256) >> bit & 1, images[bit::8, None], np.uint64(0))
    return out


def _ahead(tables: np.ndarray, states: np.ndarray) -> np.ndarray:
    out = tables[0][states & np.uint64(255)]
    for byte in range(1, 8):
        out ^= tables[byte][states >> np.uint64(8 * byte) & np.uint64(255)]
    return out


class XorShift:
    """The numbers of a generator with this seed, in order."""

    def __init__(self, seed: int):
        data = (seed & (1 << 64) - 1).to_bytes(8, "big")
        low = _hash(data, ARRAY_SEED)
        self.state = np.array([_hash(data, low) << 32 | low], np.uint64)

    def states(self, n: int) -> np.ndarray:
        out = np.empty(n, np.uint64)
        if n:
            out[:1] = _step(self.state)
            images, done = _step(np.uint64(1) << np.arange(64, dtype=np.uint64)), 1
            while done < n:
                tables, more = _tables(images), min(done, n - done)
                out[done : done + more] = _ahead(tables, out[:more])
                images, done = _ahead(tables, images), done + more
            self.state = out[-1:].copy()
        return out

    def int32(self) -> int:
        """``nextInt``."""
        x = int(self.states(1)[0]) & MASK
        return x - (1 << 32) if x >> 31 else x

    def random(self, n: int) -> np.ndarray:
        """``n`` times ``nextDouble``."""
        states = self.states(2 * n)
        high, low = states[::2] & np.uint64((1 << 26) - 1), states[1::2] & np.uint64((1 << 27) - 1)
        return ((high << np.uint64(27)) + low) * 2.0**-53
