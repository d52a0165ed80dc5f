"""Canonical length-limited Huffman codes over token ids, in numpy.

Lengths come from the package-merge method; codes are canonical (by length, then id).  A block of
ids is packed big-endian into 32-bit words with a bit offset kept every ``STEP`` ids, so a reader
decodes all stretches of a block side by side with one table look-up per id.
"""

from __future__ import annotations

import numpy as np

STEP = 128
U = np.uint64


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Code length of each id (0 where its count is 0), at most ``limit`` bits, of least total."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} ids need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, merged = [], leaves
    levels.append(np.ones(n, dtype=bool))
    for _ in range(limit - 1):
        packages = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        merged = both[at]
        levels.append(at < n)
    take, got = 2 * n - 2, np.zeros(n, dtype=np.uint8)
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        got[:own] += 1
        take = 2 * (take - own)
    lengths[order] = got
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id, in the low bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if not len(order):
        return np.zeros(len(lengths), dtype=np.uint64)
    ls = lengths[order].astype(np.int64)
    top = int(ls[-1])
    space = np.left_shift(np.int64(1), top - ls)
    starts = np.concatenate([[0], np.cumsum(space)[:-1]])
    codes = np.zeros(len(lengths), dtype=np.uint64)
    codes[order] = (starts >> (top - ls)).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Table width in bits, and the id and code length for each value of so many bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if not len(order):
        return 1, np.zeros(2, np.uint32), np.ones(2, np.uint8)
    ls = lengths[order].astype(np.int64)
    top = int(ls[-1])
    span = np.left_shift(np.int64(1), top - ls)
    ids = np.zeros(1 << top, dtype=np.uint32)
    lens = np.ones(1 << top, dtype=np.uint8)
    filled = int(span.sum())
    ids[:filled] = np.repeat(order, span)
    lens[:filled] = np.repeat(ls, span)
    return top, ids, lens


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """Packed bits and the bit offset of every ``STEP``-th id (both little-endian uint32)."""
    lens = lengths[ids].astype(np.int64)
    ends = np.cumsum(lens)
    offs = ends - lens
    bits = int(ends[-1]) if len(ends) else 0
    out = np.zeros((bits + 31) // 32 + 2, dtype=np.uint32)
    if len(ids):
        word = offs >> 5
        value = codes[ids] << (64 - lens - (offs & 31)).astype(np.uint64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        value = np.bitwise_or.reduceat(value, first)
        at = word[first]
        out[at] |= (value >> U(32)).astype(np.uint32)
        out[at + 1] |= (value & U(0xFFFFFFFF)).astype(np.uint32)
    return out.astype("<u4").tobytes(), offs[::STEP].astype("<u4").tobytes()


def unpack(blocks: list[tuple[bytes, bytes, int]], table) -> np.ndarray:
    """Ids of blocks ``(bits, offsets, number of ids)``, joined."""
    top, sym, size = table
    words, lanes, left, base = [], [], [], 0
    for bits, offsets, n in blocks:
        if not n:
            continue
        w, o = np.frombuffer(bits, "<u4"), np.frombuffer(offsets, "<u4").astype(np.int64)
        words.append(w)
        lanes.append(o + base * 32)
        left.append(np.minimum(n - STEP * np.arange(len(o)), STEP))
        base += len(w)
    if not words:
        return np.zeros(0, dtype=np.uint32)
    word = np.concatenate(words).astype(np.uint64)
    pos, left = np.concatenate(lanes), np.concatenate(left)
    begin = np.cumsum(left) - left
    out = np.empty(int(left.sum()), dtype=np.uint32)
    shift = U(64 - top)
    order = np.argsort(-left, kind="stable")  # full stretches first: a step handles a prefix
    pos, begin, left = pos[order], begin[order], left[order]
    for k in range(int(left[0])):
        live = int(np.searchsorted(-left, -k, "left"))
        p = pos[:live]
        at = p >> 5
        low = (p & 31).astype(np.uint64)
        window = (((word[at] << U(32)) | word[at + 1]) << low) >> shift
        out[begin[:live] + k] = sym[window]
        pos[:live] = p + size[window]
    return out
