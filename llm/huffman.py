"""Canonical length-limited Huffman codes over token ids, vectorised for one block at a time."""

from __future__ import annotations

import numpy as np

#: Bits of the longest code; more only if there are more than 2**LIMIT ids in use.
LIMIT = 16
#: Ids between two bit-offset checkpoints of a block.
STRIDE = 256


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each id's code (0: not in use), of least total length with none above `limit`: package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    by = used[np.argsort(counts[used], kind="stable")]
    weights = counts[by].astype(np.float64)
    rows, flags = weights, [np.ones(len(by), dtype=bool)]
    for _ in range(limit - 1):
        packages = rows[: len(rows) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((weights, packages))
        order = np.argsort(both, kind="stable")
        rows = both[order]
        flags.append(order < len(by))
    take = 2 * len(by) - 2
    for leaf in reversed(flags):
        leaves = int(leaf[:take].sum())
        lengths[by[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: by length, then id."""
    out = np.zeros(len(lengths), dtype=np.uint32)
    used = np.flatnonzero(lengths)
    by = used[np.argsort(lengths[used], kind="stable")]
    if len(by):
        bits = lengths[by].astype(np.int64)
        top = int(bits.max())
        # left-aligned, each code begins where the one before it ends
        starts = np.concatenate(([0], np.cumsum(np.int64(1) << (top - bits))[:-1]))
        out[by] = (starts >> (top - bits)).astype(np.uint32)
    return out


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, bits) for every run of `top` bits, and `top`."""
    used = np.flatnonzero(lengths)
    by = used[np.argsort(lengths[used], kind="stable")]
    if not len(by):
        return np.zeros(1, np.uint32), np.zeros(1, np.uint8), 0
    bits = lengths[by].astype(np.int64)
    top = int(bits.max())
    span = np.int64(1) << (top - bits)
    ids, size = np.repeat(by, span).astype(np.uint32), np.repeat(bits, span).astype(np.uint8)
    missing = (1 << top) - len(ids)  # one id alone leaves half the table
    return np.concatenate((ids, np.zeros(missing, np.uint32))), np.concatenate((size, np.ones(missing, np.uint8))), top


def encode(ids: np.ndarray, lengths: np.ndarray, code: np.ndarray) -> tuple[bytes, bytes]:
    """(bits, checkpoints): ids one after the other, highest bit first, and the bit offset of each STRIDE-th id."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    word = starts >> 5
    # a code of at most 32 bits, placed in the 64 bits that begin at its word
    value = code[ids].astype(np.uint64) << (np.int64(64) - (starts & 31) - size).astype(np.uint64)
    out = np.zeros(int((ends[-1] + 31) >> 5) + 1 if len(ids) else 0, dtype=np.uint32)
    if len(ids):
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        at = word[first]
        out[at] += np.add.reduceat(value >> np.uint64(32), first).astype(np.uint32)
        out[at + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first).astype(np.uint32)
    return out.astype(">u4").tobytes(), starts[::STRIDE].astype("<u8").tobytes()


def decode(raw: bytes, checkpoints: bytes, n: int, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The `n` ids of a block; all runs between checkpoints are decoded side by side."""
    ids, bits, top = table
    data = np.frombuffer(raw, dtype=">u4").astype(np.uint64)
    data = np.concatenate((data, np.zeros(2, np.uint64)))
    pairs = (data[:-1] << np.uint64(32)) | data[1:]
    at = np.frombuffer(checkpoints, dtype="<u8").astype(np.int64)
    out = np.zeros((STRIDE, len(at)), dtype=np.uint32)
    drop, last = np.uint64(64 - top), len(pairs) - 1
    for k in range(min(STRIDE, n)):
        peek = ((pairs[np.minimum(at >> 5, last)] << (at & 31).astype(np.uint64)) >> drop).astype(np.int64)
        out[k] = ids[peek]
        at = at + bits[peek]
    return out.T.reshape(-1)[:n]
