"""Substring dedup with difference-cover anchors.

A difference cover of period v is a set D of offsets such that for any two positions i and j some shift s < v puts both
i + s and j + s on D modulo v. Two equal windows of L words therefore share an equal anchor of L - v + 1 words that
starts at a cover position of both texts, so only |D| / v of all positions are hashed and shuffled to find candidates.
Anchors found elsewhere too are extended: the full windows around them are hashed (128 bits) and the earliest
occurrence of each stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import packed, words
from llm.spark import buckets, table, with_doc_id, with_row_key

#: Perfect difference sets, by period. Fixed values.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}
_SEEDS = (11, 12)


def period_for(window: int) -> int:
    """The largest period that leaves an anchor of a third of the window or more."""
    return max(v for v in COVERS if window - v + 1 >= max(1, window // 3))


def _anchors(batches: Iterator[pa.RecordBatch], window: int, n: int) -> Iterator[pa.RecordBatch]:
    period = period_for(window)
    length = window - period + 1
    on = np.isin(np.arange(period), COVERS[period])
    for batch in batches:
        ids, place, keys = [], [], []
        doc_ids = batch["doc_id"].to_numpy(zero_copy_only=False)
        for first, texts in words.slices(batch["text"]):
            per, flat = words.split_words(texts)
            runs = words.run_hashes(words.hash_words(flat, _SEEDS[0]), length)
            row, at, rest = (x[: len(runs)] for x in words.places(per))
            # a text shorter than a window has none, so its anchors are of no use
            take = np.flatnonzero((rest >= length) & on[at % period] & (per[row] >= window))
            ids.append(doc_ids[first + row[take]])
            place.append(at[take])
            keys.append(runs[take][:, None])
        if ids:
            yield from packed.pack(np.concatenate(ids), np.concatenate(place), np.concatenate(keys), n, False)


def _windows(batches: Iterator[pa.RecordBatch], window: int, n: int) -> Iterator[pa.RecordBatch]:
    """Of texts with the places of shared anchors, the windows that hold one."""
    period = period_for(window)
    for batch in batches:
        ids, place, keys = [], [], []
        doc_ids = batch["doc_id"].to_numpy(zero_copy_only=False)
        lists = batch["places"]
        for first, texts in words.slices(batch["text"]):
            per, flat = words.split_words(texts)
            runs = [words.run_hashes(words.hash_words(flat, s), window) for s in _SEEDS]
            row, at, rest = (x[: len(runs[0])] for x in words.places(per))
            begins = np.concatenate(([0], np.cumsum(per)))
            near = np.zeros(int(per.sum()) + 1, dtype=np.int32)
            for k in range(len(texts)):
                own = begins[k] + np.asarray(lists[first + k].values.to_numpy())
                own = own[own < begins[k + 1]]
                np.add.at(near, np.maximum(own - period + 1, begins[k]), 1)
                np.add.at(near, own + 1, -1)
            take = np.flatnonzero((np.cumsum(near)[: len(row)] > 0) & (rest >= window))
            ids.append(doc_ids[first + row[take]])
            place.append(at[take])
            keys.append(np.stack([r[take] for r in runs], axis=1))
        if ids:
            yield from packed.pack(np.concatenate(ids), np.concatenate(place), np.concatenate(keys), n, True)


def _kept(batches: Iterator[pa.RecordBatch], window: int, digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept": []}
        for text, starts in zip(batch["text"], batch["places"], strict=True):
            own = text.as_buffer().to_pybytes().split() if text.is_valid else []
            n, gone = len(own), 0
            if starts.is_valid and len(starts.values):
                cover = np.zeros(n + window + 1, dtype=np.int32)
                at = starts.values.to_numpy()
                at = at[at <= n - window]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + window, -1)
                stays = np.cumsum(cover)[:n] == 0
                own = [own[i] for i in np.flatnonzero(stays)]
                gone = n - len(own)
            kept = b" ".join(own)
            out["n_words"].append(n)
            out["n_removed"].append(gone)
            out["kept"].append(hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def earlier_windows(keyed: DataFrame, window: int = 20) -> DataFrame:
    """(doc_id, places): windows of `window` words that also start earlier, as word places, of rows with a key each as doc_id."""
    n = buckets(keyed)

    def exchange(rows: DataFrame, key_words: int, earliest: bool) -> DataFrame:
        found = rows.groupBy("bucket").applyInArrow(
            lambda group: packed.decide(group, key_words, earliest, n), packed.ANSWER
        )
        return found.groupBy("home").applyInArrow(packed.merge, "id long, places array<int>").withColumnRenamed("id", "doc_id")

    shared = exchange(keyed.mapInArrow(lambda b: _anchors(b, window, n), packed.PACKED), 1, False)
    around = keyed.join(shared, "doc_id").mapInArrow(lambda b: _windows(b, window, n), packed.PACKED)
    return exchange(around, len(_SEEDS), True)


def dedup(docs: DataFrame, window: int = 20, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of docs(doc_id, text).

    Words are runs of anything but ASCII white space. A word goes if a window of `window` words over it also starts
    earlier: at a smaller doc_id, or before in the same document. `kept` is the text left, words joined by one space, or
    with `digest` its SHA-256. Null texts have no words, a null doc_id comes before all others, and texts shorter than
    a window are kept. Each row is a document of its own: rows of one doc_id, or without one, follow each other in the
    order of a hash of their texts, and of equal rows one is the first. Other columns are left aside; an empty table
    gives no rows.
    """
    rows, by_id = with_row_key(docs.select("doc_id", "text"), "row")
    keyed = rows.select(F.col("row").alias("doc_id"), "text")
    # both joins take the texts in the same form, so that they are dealt out once
    marked = keyed.join(earlier_windows(keyed, window), "doc_id", "left")
    out = marked.mapInArrow(lambda b: _kept(b, window, digest), "doc_id long, n_words long, n_removed long, kept string")
    return out if by_id else with_doc_id(out, rows)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


SQL = r"""
with words as (
  select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos
  from (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from documents)
), windows as (
  select doc_id, pos, count(*) over w as n, string_agg(word, ' ') over w as run from words
  window w as (partition by doc_id order by pos rows between current row and 19 following)
), again as (
  select doc_id, pos from (
    select doc_id, pos, row_number() over (partition by run order by doc_id, pos) as nth from windows where n = 20)
  where nth > 1
), marked as (
  select w.doc_id, w.pos, w.word, count(a.pos) over (
    partition by w.doc_id order by w.pos rows between 19 preceding and current row) > 0 as gone
  from words w left join again a on a.doc_id = w.doc_id and a.pos = w.pos
)
select d.doc_id, count(m.word)::bigint as n_words, (count(*) filter (where m.gone))::bigint as n_removed,
  sha256(coalesce(string_agg(m.word, ' ' order by m.pos) filter (where not m.gone), '')) as kept_sha256
from documents d left join marked m on m.doc_id = d.doc_id group by d.doc_id
"""
