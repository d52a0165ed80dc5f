"""SHA-256 over many messages at once (numpy), with its state in the open.

A digest written as hexadecimal text has 64 bytes: one block of SHA-256.  The state after some digests
of a longer message is therefore 32 bytes that can be stored and taken up again.
"""

from __future__ import annotations

import math

import numpy as np

#: Messages that are worked on together (their words stay in the processor's cache).
CHUNK = 4096


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(x: int) -> int:
    r = round(x ** (1 / 3))
    while r ** 3 > x:
        r -= 1
    while (r + 1) ** 3 <= x:
        r += 1
    return r


# First 32 bits of the fractional parts of square and cube roots of the primes.
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], dtype=np.uint32)
_ROUND = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]
_HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), dtype=np.uint8).reshape(256, 2)


def _turn(x: np.ndarray, k: int) -> np.ndarray:
    return (x >> np.uint32(k)) | (x << np.uint32(32 - k))


def _one(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        if t >= 16:
            x, y = w[t - 15], w[t - 2]
            w.append(w[t - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[t - 7]
                     + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        up = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[t] + w[t]
        mid = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = up + mid, a, b, c, d + up, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n x 8) after one more block (n x 16 words) each."""
    out = np.empty_like(states)
    for i in range(0, len(states), CHUNK):
        part = _one(np.ascontiguousarray(states[i:i + CHUNK].T),
                    np.ascontiguousarray(blocks[i:i + CHUNK].T))
        out[i:i + CHUNK] = part.T
    return out


def finish(states: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests (n x 32 bytes) of messages of so many whole blocks."""
    last = np.zeros((len(states), 16), dtype=np.uint32)
    last[:, 0] = 0x80000000
    bits = n_blocks.astype(np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return to_bytes(absorb(states, last))


def to_bytes(states: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(states.astype(">u4")).view(np.uint8).reshape(len(states), 32)


def from_bytes(raw: np.ndarray) -> np.ndarray:
    """States (n x 8) from their bytes (n x 32)."""
    return np.ascontiguousarray(raw).view(">u4").astype(np.uint32).reshape(len(raw), 8)


def hex_text(digests: np.ndarray) -> np.ndarray:
    """Lower-case hexadecimal text (n x 64 bytes) of digests (n x 32 bytes)."""
    return _HEX[digests].reshape(len(digests), 64)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """That text as one block each (n x 16 words)."""
    return hex_text(digests).view(">u4").astype(np.uint32)
