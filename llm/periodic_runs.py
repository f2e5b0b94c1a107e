"""Runs of words that repeat with a period, and texts without the repetitions.

A run is a longest stretch of words with smallest period q, of at least `repeats` periods and `least` words. Each of its
words occurs `repeats` times in it, so a word that is rarer than that in a segment of a text cannot belong to a run
there and splits the segment. The parts are counted anew until no word splits them, which leaves little of ordinary
text. What stays is scanned by lags: for windows of 1, 2, 4, ... words the lag of a place is the distance to the next
equal window. Inside a run of period q the lag of windows of q to 2q - 1 words is exactly q, so stretches of equal
lags are the runs, found in O(n log^2 n) for n words however many periods there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import words
from llm.spark import sha256_hex, table

REPEATS = 4
LEAST = 6
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FIELDS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string"


def _breaks(segment: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers of the segments of places `at`: new ones where the old one changes or places are missing."""
    if not len(at):
        return at
    new = np.ones(len(at), dtype=np.int64)
    new[1:] = (segment[1:] != segment[:-1]) | (np.diff(at) != 1)
    return np.cumsum(new) - 1


def frequent_segments(ids: np.ndarray, row: np.ndarray, repeats: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, segment of each): segments of which every word occurs `repeats` times in its segment, recursively.

    `ids` are word numbers, `row` the text of each. Only segments that a word has split are counted again.
    """
    at, segment, stable = np.arange(len(ids)), row, []
    different = int(ids.max()) + 1 if len(ids) else 1
    while len(at):
        segment = _breaks(segment, at)
        long = np.bincount(segment)[segment] >= max(least, repeats)
        at, segment = at[long], segment[long]
        _, which, count = np.unique(segment * different + ids[at], return_inverse=True, return_counts=True)
        stays = count[which] >= repeats
        split = np.zeros(int(segment.max(initial=-1)) + 1, dtype=bool)
        split[segment[~stays]] = True
        stable.append(at[~split[segment]])
        again = stays & split[segment]
        at, segment = at[again], segment[again]
    places = np.sort(np.concatenate(stable)) if stable else np.empty(0, np.int64)
    return places, _breaks(row[places], places)


def find_runs(ids: np.ndarray, row: np.ndarray, repeats: int = REPEATS, least: int = LEAST) -> np.ndarray:
    """(place, length, period) of every run in texts of word numbers `ids`, a column each, by place, then period."""
    at, segment = frequent_segments(ids, row, repeats, least)
    found = [np.empty((3, 0), dtype=np.int64)]
    different = int(ids.max()) + 1 if len(ids) else 1
    names = np.unique(segment * different + ids[at], return_inverse=True)[1]
    k = 1
    while True:
        size = np.bincount(segment, minlength=1)
        deep = (size >= max(least, repeats * (k // 2 + 1)))[segment]  # room for the smallest period of this level
        at, segment, names = at[deep], segment[deep], names[deep]
        if not len(at):
            break
        rest = _rest(segment)
        whole = np.flatnonzero(rest >= k)
        order = whole[np.argsort(names[whole], kind="stable")]
        lag = np.zeros(len(at), dtype=np.int64)
        equal = np.flatnonzero(names[order[1:]] == names[order[:-1]])
        lag[order[equal]] = order[equal + 1] - order[equal]
        lag[(lag > k) | (lag <= k // 2)] = 0
        cut = np.flatnonzero(np.concatenate(([True], lag[1:] != lag[:-1], [True])))
        first, last = cut[:-1], cut[1:] - 1
        period = lag[first]
        length = last - first + k + period
        good = (period > 0) & (length >= np.maximum(least, repeats * period))
        found.append(np.stack([at[first], length, period])[:, good])
        # windows of twice the length, as pairs of windows
        pair = np.flatnonzero(rest >= 2 * k)
        doubled = np.full(len(at), -1, dtype=np.int64)
        doubled[pair] = np.unique(names[pair] * (int(names.max()) + 1) + names[pair + k], return_inverse=True)[1]
        names, k = doubled, 2 * k
    runs = np.concatenate(found, axis=1)
    return runs[:, np.lexsort((runs[2], runs[0]))]


def _rest(segment: np.ndarray) -> np.ndarray:
    """Words from each place to the end of its segment; segments lie one behind the other."""
    last = np.flatnonzero(np.concatenate((segment[1:] != segment[:-1], [True])))
    return last[np.searchsorted(last, np.arange(len(segment)))] - np.arange(len(segment)) + 1


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)


def _collapse(batches: Iterator[pa.RecordBatch], repeats: int, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in words.slices(batch["text"]):
            per, flat = words.split_words(texts)
            row, place, _ = words.places(per)
            ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            at, length, period = find_runs(ids, row, repeats, least)
            covered = np.zeros(len(ids) + 1, dtype=np.int64)
            np.add.at(covered, at + period, 1)
            np.add.at(covered, at + length, -1)
            stays = np.cumsum(covered)[: len(ids)] == 0
            runs = pa.StructArray.from_arrays([pa.array(place[at]), pa.array(length), pa.array(period)], fields=list(_RUN))
            kept = _lists(flat.filter(pa.array(stays)), np.bincount(row[stays], minlength=len(per)))
            columns = [
                batch["doc_id"].slice(first, len(texts)), pa.array(per, pa.int64()),
                _lists(runs, np.bincount(row[at], minlength=len(per))), pc.binary_join(kept, " "),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "kept"])


def collapse(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, kept) of every row of docs(doc_id, text).

    `runs` lists (start, length, period) in words, by start, then period; `kept` are the words that no run holds after
    its first period, joined by one space. Words are runs of anything but ASCII white space and are compared as they
    are. A null or blank text has no words and no runs. Rows are judged one by one, so null and repeated ids are as
    any others; other columns are left aside; an empty table gives no rows. `repeats` must be 3 or more.
    """
    if repeats < 3:
        raise ValueError("repeats must be 3 or more")
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _collapse(batches, repeats, least), _FIELDS)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts, chosen by a hash of the id, with a period from some word on; null ids and texts as they are."""

    def plant(batches):
        for batch in batches:
            chosen = pc.fill_null(pc.and_(pc.equal(batch["digit"], 0), pc.is_valid(batch["text"])), False)
            new = []
            for raw, g in zip(pc.cast(batch["text"].filter(chosen), pa.binary()), batch["g"].filter(chosen).to_pylist(), strict=True):
                own = raw.as_py().split()
                if n := len(own):
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    own[a:] = [own[a + i % p] for i in range(n - a)]
                new.append(b" ".join(own).decode())
            texts = pc.replace_with_mask(batch["text"], chosen, pa.array(new, batch["text"].type))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], texts], names=["doc_id", "text"])

    h = F.crc32(F.col("doc_id").cast("string"))
    return docs.select("doc_id", "text", (h % 10).alias("digit"), F.floor(h / 10).cast("long").alias("g")).mapInArrow(plant, "doc_id long, text string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha256_hex(F.array_join(lines, "")).alias("runs_sha256"), sha256_hex(F.col("kept")).alias("collapsed_sha256"),
    )
