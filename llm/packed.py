"""Packed exchange of keyed positions: which keys occur elsewhere, or earlier?

A task packs the keyed positions of its batch into one row per bucket (ids, positions and keys as byte strings), so
that a shuffle carries some ten bytes a position. What a batch can decide alone goes out decided, and of each key only
one position asks: however often a key occurs, a bucket gets at most one of it from a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PACKED = "bucket int, decided boolean, ids binary, counts binary, places binary, keys binary"
ANSWER = "home int, ids binary, counts binary, places binary"


def planes(x: np.ndarray) -> bytes:
    """The bytes of `x`, lowest bytes of all values first: small values then compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def unplanes(raw: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(raw, dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(size, len(flat) // size).T).view(dtype).reshape(-1)


def _decided(
    among: np.ndarray, ids: np.ndarray, place: np.ndarray, keys: np.ndarray, earliest: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Of the positions `among`: the first one of each key, and those decided by the others."""
    by = among[np.lexsort((place[among], ids[among], *keys[among].T))]
    same = np.zeros(len(by) + 1, dtype=bool)
    same[1:-1] = (keys[by[1:]] == keys[by[:-1]]).all(axis=1)
    first, decided = np.zeros(len(ids), dtype=bool), np.zeros(len(ids), dtype=bool)
    first[by[~same[:-1]]] = True
    if earliest:
        head = by[np.maximum.accumulate(np.where(same[:-1], 0, np.arange(len(by))))]
        decided[by] = (ids[by] != ids[head]) | (place[by] != place[head])
    else:
        decided[by] = same[:-1] | same[1:]
    return first, decided


def _packed_ids(ids: np.ndarray, place: np.ndarray) -> dict[str, bytes]:
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return {
        "ids": planes(ids[first]),
        "counts": planes(np.diff(np.append(first, len(ids))).astype(np.int32)),
        "places": planes(np.diff(place, prepend=0).astype(np.int32)),
    }


def _unpacked_ids(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.repeat(unplanes(row["ids"], np.int64), unplanes(row["counts"], np.int32))
    return ids, np.cumsum(unplanes(row["places"], np.int32).astype(np.int64))


def pack(ids: np.ndarray, place: np.ndarray, keys: np.ndarray, n: int, earliest: bool) -> Iterator[pa.RecordBatch]:
    """Rows for the exchange. ids: of each position, with place ascending in a run of one id. keys: (positions, words).

    earliest: decided are positions whose key is at a smaller (id, place) too; else those whose key is elsewhere too.
    """
    if not len(ids):
        return
    ask, decided = _decided(np.arange(len(ids)), ids, place, keys, earliest)
    for kind in (True, False):
        take = np.flatnonzero(decided if kind else ask)
        if not len(take):
            continue
        home = (ids[take].astype(np.uint64) if kind else keys[take, 0]) % np.uint64(n)
        take = take[np.argsort(home, kind="stable")]
        home = np.sort(home, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1], [True])))
        rows: dict[str, list] = {k: [] for k in ("bucket", "decided", "ids", "counts", "places", "keys")}
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = take[a:b]
            rows["bucket"].append(int(home[a]))
            rows["decided"].append(kind)
            for k, v in _packed_ids(ids[own], place[own]).items():
                rows[k].append(v)
            rows["keys"].append(b"" if kind else np.ascontiguousarray(keys[own]).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["bucket"], pa.int32()), pa.array(rows["decided"]), *(pa.array(rows[k], pa.binary()) for k in ("ids", "counts", "places", "keys"))],
            names=list(rows),
        )


def unpack(group: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(decided, ids, places, keys) of the rows of a bucket; decided ones have keys of zero."""
    parts = []
    for row in group.to_pylist():
        ids, place = _unpacked_ids(row)
        keys = np.zeros((len(ids), words), np.uint64) if row["decided"] else np.frombuffer(row["keys"], np.uint64).reshape(-1, words)
        parts.append((np.full(len(ids), row["decided"]), ids, place, keys))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def decide(group: pa.Table, words: int, earliest: bool, n: int) -> pa.Table:
    """Rows of ANSWER for the positions of a bucket that are decided, or that the bucket's other rows decide."""
    decided, ids, place, keys = unpack(group, words)
    decided |= _decided(np.flatnonzero(~decided), ids, place, keys, earliest)[1]
    take = np.flatnonzero(decided)
    home = ids[take].astype(np.uint64) % np.uint64(n)
    by = np.lexsort((place[take], ids[take], home))
    take, home = take[by], home[by]
    cuts = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1], [True]))) if len(take) else np.zeros(1, int)
    rows = [_packed_ids(ids[take[a:b]], place[take[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table(
        {"home": pa.array(home[cuts[:-1]].astype(np.int32)), **{k: pa.array([r[k] for r in rows], pa.binary()) for k in ("ids", "counts", "places")}}
    )


def merge(group: pa.Table) -> pa.Table:
    """(id, places) of the answers that come home: one row an id."""
    parts = [_unpacked_ids(row) for row in group.to_pylist()]
    ids, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.lexsort((place, ids))
    ids, place = ids[by], place[by]
    cuts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True])))
    lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(place.astype(np.int32)))
    return pa.table({"id": pa.array(ids[cuts[:-1]], pa.int64()), "places": lists})
