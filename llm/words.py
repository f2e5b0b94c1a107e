"""Vectorised word hashing inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at once; bounds the temporary arrays, not the text.
SLICE = 2 << 20

_U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def powers(n: int, base: int = _MULTIPLIER) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    out = np.full(max(n, 1), base & (2**64 - 1), dtype=_U64)
    out[0] = 1
    return np.cumprod(out, dtype=_U64)[:n]


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of whole texts of about SLICE bytes; nulls become empty texts."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + SLICE)))
        yield first, texts.slice(first, last - first)
        first = last


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words of each text: their number per text, and all of them in order."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    per = np.diff(np.asarray(lists.offsets)).astype(np.int64)
    if not pc.all(full).as_py() and len(words):
        flags = full.to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(per)), per)
        per = np.bincount(row[flags], minlength=len(per)).astype(np.int64)
        words = words.filter(full)
    return per, words


def hash_words(words: pa.Array, seed: int, lower: bool = False) -> np.ndarray:
    """64-bit hashes of words; `lower` takes A-Z as a-z."""
    out = np.empty(len(words), dtype=_U64)
    letters = np.random.default_rng(seed).integers(0, 2**63, 256, dtype=np.int64).astype(_U64) * _U64(2) + _U64(1)
    if lower:
        letters = letters[_LOWER]
    kind = np.int64 if pa.types.is_large_string(words.type) or pa.types.is_large_binary(words.type) else np.int32
    _, offsets, data = words.buffers()
    if not len(words):
        return out
    offsets = np.frombuffer(offsets, dtype=kind)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8)
    step = 1 << 17
    for i in range(0, len(words), step):
        o = offsets[i : i + step + 1]
        bytes_ = letters[data[o[0] : o[-1]]]
        starts = o[:-1] - o[0]
        place = np.arange(len(bytes_)) - np.repeat(starts, np.diff(o))
        bytes_ *= powers(int(place.max()) + 1 if len(place) else 1, 0x2545F4914F6CDD1D | 1)[place]
        out[i : i + step] = np.add.reduceat(bytes_, starts)
    return mix(out)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of `length` consecutive words, by first word; runs may cross texts."""
    n = len(hashes)
    if n < length:
        return np.empty(0, dtype=_U64)
    total = np.zeros(n + 1, dtype=_U64)
    np.cumsum(hashes * powers(n), out=total[1:])
    inverse = pow(_MULTIPLIER, -1, 2**64)
    return mix((total[length:] - total[:-length]) * powers(n - length + 1, inverse))


def places(per: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its text, its place in the text, and the number of words from it to the text's end."""
    row = np.repeat(np.arange(len(per)), per)
    first = np.concatenate(([0], np.cumsum(per)[:-1])) if len(per) else np.zeros(0, np.int64)
    place = np.arange(len(row)) - first[row]
    return row, place, per[row] - place


def give_back() -> None:
    """Return what a worker holds of freed memory to the machine; workers outlive the stage that needed it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def stretches(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of stretches one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)


class Remembered:
    """Strings whose ids a worker has found, and the ids, as arrays of at most `limit` bytes."""

    def __init__(self, kind: pa.DataType, ids: type) -> None:
        self.known = (pa.array([], kind), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=ids))

    def look_up(self, found: pa.Array, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], limit: int) -> tuple[np.ndarray, ...]:
        """(number of ids, place of the first) of each of the distinct strings `found`, and ids for the places.

        `encode` gives the number of ids of each of the strings that are new, and all their ids.
        """
        strings, sizes, flat = self.known
        at = pc.fill_null(pc.index_in(found, value_set=strings), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = found.take(pa.array(new))
            at[new] = len(strings) + np.arange(len(new))
            more = encode(fresh)
            strings, sizes, flat = pa.concat_arrays([strings, fresh]), np.concatenate((sizes, more[0])), np.concatenate((flat, more[1]))
        begins = np.cumsum(sizes) - sizes
        kept = strings, sizes, flat
        if self._bytes(kept) > limit:  # only the strings at hand stay, if there is room for them
            kept = found, sizes[at], flat[stretches(begins[at], sizes[at])]
        self.known = kept if self._bytes(kept) <= limit else tuple(x[:0] for x in kept)
        return sizes[at], begins[at], flat

    @staticmethod
    def _bytes(kept: tuple) -> int:
        return sum(x.nbytes for x in kept)
