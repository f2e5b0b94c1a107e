"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

The CGK walk reads a word string with a pointer that stays or moves on at every step, as a random bit of the word says;
the words it reads are the embedding, in which a small edit distance becomes a small Hamming distance. A table of the
LSH samples a few coordinates of the walk that starts at some share of an item; windows of a document, at every word,
that agree in the sampled coordinates are candidates. Each candidate is verified by the exact edit distance, in words,
of the whole item to the best window of the document around it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import words
from llm.spark import table

#: Share of an item's words that may differ.
MAX_EDITS = 0.25
#: Items of fewer words are too short to tell a leak from chance; they match nothing.
MIN_WORDS = 5
#: Repetitions of the sampling: at a quarter of edited words, recall is above 0.95 (tests/llm/test_decontamination.py).
TABLES = 24
#: Items of a pass over the documents; more items take more passes.
ITEM_BLOCK = 20_000
_SEED = 31

#: ASCII punctuation separates words, A-Z is read as a-z.
_READS = np.arange(256, dtype=np.uint8)
_READS[[i for i in range(128) if not chr(i).isalnum()]] = 32
_READS[65:91] += 32


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and the hash of every word."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    if texts.offset:
        texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    data = _READS[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    plain = pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(data))
    per, flat = words.split_words(plain)
    return per, words.hash_words(flat, _SEED)


@dataclass
class _Table:
    samples: tuple[int, ...]  # steps of the walk that are compared
    levels: list[np.ndarray]  # by number of samples: sorted keys of the items that have so many
    ends: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # keys of items that have no more samples; item; start


@dataclass
class Items:
    ids: list[int]
    tokens: list[np.ndarray]
    sets: list[np.ndarray]  # the distinct ones, sorted
    tables: list[_Table]
    masks: np.ndarray  # by sample and low bits of a hash: the tables (as bits) in which an item has such a word there


_BITS = np.uint64((1 << 18) - 1)
#: Coordinates that a table samples.
_SAMPLES = 4


def _bit(hashes: np.ndarray, step: int, t: int) -> np.ndarray:
    return ((hashes >> np.uint64((step * 7 + t * 13 + 5) % 64)) & np.uint64(1)).astype(np.int64)


def _join(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return words.mix(keys * np.uint64(0x9E3779B97F4A7C15) + hashes)


def prepare(ids: list[int], texts: list[str | None], tables: int = TABLES) -> Items:
    per, hashes = word_hashes(pa.array(texts, pa.string()))
    tokens = np.split(hashes, np.cumsum(per)[:-1]) if len(per) else []
    if tables > 32:
        raise ValueError("A mask holds 32 tables.")
    masks = np.zeros((_SAMPLES, int(_BITS) + 1), dtype=np.uint32)
    out = Items(ids, tokens, [np.unique(x) for x in tokens], [], masks)
    for t in range(tables):
        second = 2 + t * 5 % 7
        third = second + 2 + t * 7 % 5
        samples = (0, second, third, third + 2 + t * 3 % 7)
        keys: list[list] = [[] for _ in samples]
        ends: list[list] = [[] for _ in samples]
        for k, own in enumerate(tokens):
            if len(own) < MIN_WORDS:
                continue
            start = len(own) * (t % 8) // 16
            at, key, level = start, np.zeros(1, np.uint64), 0
            for step in range(samples[-1] + 1):
                if at >= len(own):
                    break
                if step == samples[level]:
                    key = _join(key, own[at : at + 1])
                    keys[level].append(key[0])
                    masks[level, int(own[at] & _BITS)] |= np.uint32(1 << t)
                    level += 1
                at += int(_bit(own[at : at + 1], step, t)[0])
            ends[level - 1].append((keys[level - 1][-1], k, start))
        rows = []
        for found in ends:
            found.sort(key=lambda x: x[0])
            rows.append(tuple(np.array([x[i] for x in found], dtype=(np.uint64, np.int64, np.int64)[i]) for i in range(3)))
        out.tables.append(_Table(samples, [np.unique(np.array(x, dtype=np.uint64)) for x in keys], rows))
    return out


def _in(sorted_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(keys), dtype=bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)] == keys


def candidates(items: Items, hashes: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """(item, word where the item would begin) of windows that agree with an item in some table. stop: end of each word's text."""
    found = []
    low = (hashes & _BITS).astype(np.int64)
    first = items.masks[0][low]
    for t, table_ in enumerate(items.tables):
        start = np.flatnonzero(first & np.uint32(1 << t))
        at, key, level = start, np.zeros(len(start), np.uint64), 0
        for step in range(table_.samples[-1] + 1):
            if not len(at):
                break
            if step == table_.samples[level]:
                maybe = (items.masks[level][low[at]] & np.uint32(1 << t)) > 0
                at, start, key = at[maybe], start[maybe], key[maybe]
                key = _join(key, hashes[at])
                keys, which, offset = table_.ends[level]
                lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                for extra in range(int((hi - lo).max(initial=0))):  # items with one key follow each other
                    hit = np.flatnonzero(lo + extra < hi)
                    found.append(np.stack([which[lo[hit] + extra], start[hit] - offset[lo[hit] + extra], start[hit]], axis=1))
                keep = _in(table_.levels[level], key)
                at, start, key = at[keep], start[keep], key[keep]
                level += 1
                if level == len(table_.samples):
                    break
            at = at + _bit(hashes[at], step, t)
            inside = at < stop[start]
            at, start, key = at[inside], start[inside], key[inside]
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def best_window(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edit distance, start, end) of the window of `text` closest to `item`; the first of equal ends."""
    m = len(text)
    row, begin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    ramp = np.arange(m + 1)
    for i, word in enumerate(item, 1):
        # along a text the cost grows by one a word: a running minimum of (cost - place) gives the insertions
        swap = row[:-1] + (text != word)
        drop = row[1:] + 1
        new = np.concatenate(([i], np.minimum(swap, drop)))
        origin = np.concatenate(([0], np.where(swap <= drop, begin[:-1], begin[1:])))
        low = new - ramp
        lead = np.minimum.accumulate(low)
        from_ = np.maximum.accumulate(np.where(low == lead, ramp, 0))
        row, begin = lead + ramp, origin[from_]
    end = int(row.argmin())
    return int(row[end]), int(begin[end]), end


def leaks(items: Items, texts: pa.Array, max_edits: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, distance, first word, words) of the closest window of each text to each item it holds."""
    for first, part in words.slices(texts):
        per, hashes = word_hashes(part)
        ends = np.cumsum(per)
        row = np.repeat(np.arange(len(per)), per)
        if not len(hashes):
            continue
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for item, begin, seen in candidates(items, hashes, ends[row]).tolist():
            own = items.tokens[item]
            k = int(max_edits * len(own))
            text = int(row[seen])
            reached = done.get((text, item))
            if reached is not None and reached >= begin:  # begin is negative where the first text lacks an item's first words
                continue  # the window verified last reaches as far
            low = max(begin - k, int(ends[text] - per[text]))
            high = min(begin + len(own) + 2 * k + 1, int(ends[text]))
            done[text, item] = begin + k // 2
            if _in(items.sets[item], hashes[low:high]).sum() < len(own) - k:
                continue  # each word of an item that a window keeps is a word of the item there
            distance, a, b = best_window(own, hashes[low:high])
            now = (distance, low + a - int(ends[text] - per[text]), b - a)
            if distance <= k and now < best.get((text, item), (distance + 1,)):
                best[text, item] = now
        for (text, item), found in sorted(best.items()):
            yield first + text, item, *found


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    rows = benchmark.select("item_id", "text").where(F.col("item_id").isNotNull())
    ids, texts = [], []
    for r in rows.toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        if len(ids) == ITEM_BLOCK:
            yield prepare(ids, texts)
            ids, texts = [], []
    if ids:
        yield prepare(ids, texts)


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """(doc_id, item_id, distance, start, n_words, item_words): what docs(doc_id, text) hold of benchmark(item_id, text).

    One row for each document and item whose best window is within max_edits * words of the item, by edit distance in
    words; words are runs of anything but ASCII white space and punctuation, with A-Z as a-z. Of windows at one distance
    the first is given. Null and empty texts hold nothing; items of fewer than MIN_WORDS words, or with a null item_id,
    match nothing; rows that repeat give rows that repeat; other columns are left aside. Items are taken in blocks of
    ITEM_BLOCK, each a pass over the documents.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance int, start int, n_words int, item_words int"

    def run(shared):
        def of(batches):
            items = shared.value
            for batch in batches:
                rows = list(leaks(items, batch["text"], max_edits))
                if rows:
                    row, item, distance, start, n = (list(x) for x in zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["doc_id"].take(pa.array(row)), pa.array([items.ids[i] for i in item], pa.int64()),
                            *(pa.array(x, pa.int32()) for x in (distance, start, n, [len(items.tokens[i]) for i in item])),
                        ],
                        names=["doc_id", "item_id", "distance", "start", "n_words", "item_words"],
                    )

        return docs.select("doc_id", "text").mapInArrow(of, schema)

    out = spark.createDataFrame([], schema)
    for items in _blocks(benchmark):
        out = out.unionByName(run(spark.sparkContext.broadcast(items)))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS) -> DataFrame:
    """The rows of docs(text, ...) that hold no item of the benchmark, with all their columns."""
    for items in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            for batch in batches:
                column = batch.column(batch.schema.get_field_index("text"))
                keep = np.ones(len(batch), dtype=bool)
                keep[[row for row, *_ in leaks(shared.value, column, max_edits)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
