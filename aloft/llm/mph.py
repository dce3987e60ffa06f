"""A minimal perfect hash of 128-bit keys: cascaded bit arrays with ranks, and a stored fingerprint per key.

Level by level the keys left are hashed into a bit array of ``GAMMA`` bits a key; a key alone on its place
sets the bit, the others go to the next level.  The number of set bits before a key's
bit is its slot, so n keys get the slots 0..n-1, at about 4 bits a key.  A slot's 32-bit
fingerprint tells a stored key from another one (a foreign key passes by chance once in 2**32).
All of it is plain arrays, made and asked for many keys at once.
"""

from __future__ import annotations

import numpy as np

from aloft.llm.common import U64, mix

GAMMA = 2
MAX_LEVELS = 200


def split_keys(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """16-byte keys as two columns of 64-bit numbers."""
    pairs = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
    return np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(low ^ mix(high + U64(2 * level + 1))) % U64(size)).astype(np.int64)


def fingerprint(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (mix(high ^ mix(low ^ U64(0xA5A5A5A5A5A5A5A5))) >> U64(32)).astype("<u4")


def build(high: np.ndarray, low: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of the hash of different keys: ``sizes`` of the levels, ``words`` of their bits, ``ranks`` before each word."""
    sizes, words, level = [], [], 0
    while len(high):
        if level == MAX_LEVELS:
            raise ValueError("keys are not different")
        size = -(-GAMMA * len(high) // 64) * 64
        at = _place(high, low, level, size)
        alone = np.bincount(at, minlength=size) == 1
        bits = np.packbits(alone, bitorder="little").view("<u8")
        sizes.append(size)
        words.append(bits)
        left = ~alone[at]
        high, low, level = high[left], low[left], level + 1
    flat = np.concatenate(words) if words else np.zeros(0, "<u8")
    ones = np.bitwise_count(flat).astype(np.int64)
    return {"sizes": np.array(sizes, "<u8"), "words": flat, "ranks": (np.cumsum(ones) - ones).astype("<u8")}


def slots(table: dict[str, np.ndarray], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The slot of each key; -1 for keys that are certainly not in the table."""
    out = np.full(len(high), -1, dtype=np.int64)
    left, base = np.arange(len(high)), 0
    for level, size in enumerate(table["sizes"].tolist()):
        if not len(left):
            break
        at = _place(high[left], low[left], level, size)
        word, bit = table["words"][base + (at >> 6)], (at & 63).astype(np.uint64)
        hit = (word >> bit) & U64(1) == 1
        below = np.bitwise_count(word & ((U64(1) << bit) - U64(1))).astype(np.int64)
        out[left[hit]] = (table["ranks"][base + (at >> 6)].astype(np.int64) + below)[hit]
        left, base = left[~hit], base + size // 64
    return out
