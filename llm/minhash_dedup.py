"""MinHash near-dedup with sequential Bayesian verification.

Texts with equal shingle sets are one class, whose smallest doc_id stands for it. Signatures are banded; classes that
share a band are candidates. Candidates meet in units of bounded size, where a pair is compared batch by batch of the
signature and dropped as soon as the posterior probability that its similarity reaches the threshold is below MISS.
Survivors are verified on their full sets. A pair that is already linked through others in the unit needs no
comparison, so a unit gives at most a spanning forest of links, however many pairs it holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import words
from llm.spark import buckets, components, row_key, table, with_row_key, written

SHINGLE = 5
#: Linked are sets with 100 * intersection >= PERCENT * union.
PERCENT = 75
#: BANDS bands of ROWS values: a pair at the threshold shares none with probability (1 - 0.75**4)**32 = 5e-6.
BANDS, ROWS = 32, 4
#: Probability of dropping a pair at or over the threshold, for each of the BATCHES of a comparison.
MISS, BATCHES = 1e-6, (16, 32, 64, 96, 128)
#: Classes that a unit compares at most; larger candidate groups are cut into bands, and bands into pairs of chunks.
UNIT = 512
_RNG = np.random.default_rng(51)
_A = (_RNG.integers(0, 2**31, BANDS * ROWS, dtype=np.int64) * 2 + 1).astype(np.uint32)
_B = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.int64).astype(np.uint32)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(size of each text's set, sorted distinct shingle hashes of all texts in turn)."""
    per, flat = words.split_words(texts)
    hashes = words.hash_words(flat, 52, lower=True)
    row, _, rest = words.places(per)
    runs = words.run_hashes(hashes, SHINGLE)
    full = np.flatnonzero(rest[: len(runs)] >= SHINGLE)
    rows, values = [row[full]], [runs[full]]
    begins = np.concatenate(([0], np.cumsum(per)))
    for k in range(1, SHINGLE):  # fewer words: the whole sequence
        own = np.flatnonzero(per == k)
        if len(own):
            rows.append(own)
            values.append(words.mix(words.run_hashes(hashes, k)[begins[own]] + np.uint64(k)))
    row, value = np.concatenate(rows), np.concatenate(values)
    by = np.lexsort((value, row))
    row, value = row[by], value[by]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return np.bincount(row[new], minlength=len(per)), value[new]


def signatures(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """MinHash values of each set that is not empty, in rows."""
    full = sizes[sizes > 0]
    starts = (np.cumsum(full) - full).astype(np.int64)
    low = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), len(_A)), dtype=np.uint32)
    for j in range(len(_A) if len(starts) else 0):
        x = low * _A[j]
        x ^= x >> np.uint32(15)
        out[:, j] = np.minimum.reduceat(x * _A[j] + _B[j], starts)
    return out


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, key1, key2, bands): the set's identity in 128 bits, and its band keys."""
    for batch in batches:
        for first, texts in words.slices(batch["text"]):
            sizes, values = shingle_sets(texts)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            keys = [np.concatenate(([np.uint64(0)], np.cumsum(words.mix(values ^ np.uint64(s)), dtype=np.uint64))) for s in (53, 54)]
            keys = [(k[ends[1:]] - k[ends[:-1]]).view(np.int64) for k in keys]
            rows = signatures(sizes, values).reshape(-1, BANDS, ROWS).astype(np.uint64)
            band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
            for r in range(ROWS):
                band = words.mix(band * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
            offsets = np.concatenate(([0], np.cumsum(np.where(sizes > 0, BANDS, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(first, len(texts)), pa.array(sizes.astype(np.int64)), pa.array(keys[0]), pa.array(keys[1]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(band.reshape(-1).view(np.int64))),
                ],
                names=["doc_id", "n_shingles", "key1", "key2", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in words.slices(batch["text"]):
            sizes, values = shingle_sets(texts)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            raw = [values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(first, len(texts)), pa.array(raw, pa.binary())], names=["rep", "shingles"])


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest matches of n for which P(similarity >= threshold) >= miss, under an even prior."""
    total = 0.0
    for m in range(n + 2):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


_LEAST = {n: least_matches(n, PERCENT / 100, MISS) for n in BATCHES}


def links_in_unit(sets: list[np.ndarray], side: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links of a unit. side: 0 or 1; with both present only pairs across are compared."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    sig = signatures(sizes, np.concatenate(sets))
    across = len(np.unique(side)) > 1
    component = np.arange(m)
    found = []
    for i in range(m):
        js = np.arange(i + 1, m)
        # a size filter, and nothing that is linked already
        js = js[(component[js] != component[i]) & (100 * np.minimum(sizes[js], sizes[i]) >= PERCENT * np.maximum(sizes[js], sizes[i]))]
        if across:
            js = js[side[js] != side[i]]
        if not len(js):
            continue
        same = sig[js] == sig[i]
        stays = same.reshape(len(js), BANDS, ROWS).all(axis=2).any(axis=1)
        js, same = js[stays], same[stays]
        score = np.zeros(len(js), dtype=np.int64)
        at = 0
        for n in BATCHES:
            score += same[:, at:n].sum(axis=1)
            stays = score >= _LEAST[n]
            js, same, score, at = js[stays], same[stays], score[stays], n
        for j in js[np.argsort(-score, kind="stable")]:
            if component[j] == component[i]:
                continue
            shared = np.intersect1d(sets[i], sets[j], assume_unique=True).size
            if 100 * shared >= PERCENT * (sizes[i] + sizes[j] - shared):
                found.append((i, int(j)))
                component[component == component[j]] = component[i]
    return found


def _links(group: pa.Table) -> pa.Table:
    """Links of all units of a group."""
    group = group.sort_by([(c, "ascending") for c in ("kind", "unit", "low", "high", "rep")])
    cols = [group[c].to_numpy() for c in ("kind", "unit", "low", "high")]
    reps, chunk, raw = group["rep"].to_numpy(), group["chunk"].to_numpy(), group["shingles"].combine_chunks()
    new = np.ones(len(reps) + 1, dtype=bool)
    new[1:-1] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    cuts = np.flatnonzero(new)
    a, b = [], []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        sets = [np.frombuffer(raw[k].as_buffer(), dtype=np.uint64) for k in range(lo, hi)]
        for i, j in links_in_unit(sets, (chunk[lo:hi] != cols[2][lo]).astype(int)):
            a.append(reps[lo + i])
            b.append(reps[lo + j])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _units(classes: DataFrame) -> DataFrame:
    """(kind, unit, low, high, chunk, rep): which classes meet where, of classes(rep, bands)."""
    bands = classes.select("rep", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first <> last")
    near = bands.join(shared.select("band", "first"), "band")
    groups = components(near.select("rep", "first"), "rep", "first")
    sizes = groups.groupBy("component").count()
    groups = written(groups.join(sizes, "component").select(F.col("id").alias("rep"), "component", "count"), "groups")
    small = groups.where(F.col("count") <= UNIT).select(F.lit(0).alias("kind"), F.col("component").alias("unit"), "rep", "count")
    # a larger group is compared band by band
    large = near.join(groups.where(F.col("count") > UNIT).select("rep"), "rep").select("band", "rep").distinct()
    counts = large.groupBy("band").count()
    large = large.join(counts, "band").select(F.lit(1).alias("kind"), F.col("band").alias("unit"), "rep", "count")
    units = small.unionByName(large).withColumn("chunks", F.ceil(F.col("count") / UNIT).cast("int"))
    units = units.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    units = units.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return units.select("kind", "unit", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "rep")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs(doc_id, text).

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text's set holds its distinct runs of SHINGLE
    words, or the whole sequence if it has fewer. Links are confirmed on full sets. component_id is the smallest doc_id
    that links reach; kept says that it is the row's own. Texts without words are linked with nothing. A null doc_id
    is smaller than all others. Each row is a document of its own, also among rows of one doc_id or without one: of a
    component whose smallest doc_id several rows have, one is kept, chosen by a hash of its text. Other columns are
    left aside; an empty table gives no rows.
    """
    rows, by_id = with_row_key(docs.select("doc_id", "text"), "row")
    found = _components_of_rows(rows.select(F.col("row").alias("doc_id"), "text"))
    if by_id:
        return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))
    ids = rows.select(F.col("row").alias("component"), F.col("doc_id").alias("component_id"))
    named = found.withColumnRenamed("doc_id", "row").join(rows.select("row", "doc_id"), "row").join(ids, "component")
    return named.select("doc_id", "n_shingles", "component_id", (F.col("row") == F.col("component")).alias("kept"))


def _components_of_rows(keyed: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component) of rows with a key each as doc_id."""
    described = written(
        keyed.mapInArrow(_described, "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>"), "signatures"
    )
    same = ["key1", "key2", "n_shingles"]
    slim = described.select("doc_id", *same)
    reps = slim.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"))
    classes = written(described.join(reps, same).where("doc_id = rep").select("rep", "bands").distinct(), "classes")
    units = written(_units(classes), "units")
    of_units = units.select("rep").distinct()
    sets = keyed.join(of_units.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi").mapInArrow(_sets, "rep long, shingles binary")
    n = buckets(keyed)
    met = units.join(sets, "rep").withColumn("group", F.pmod(F.xxhash64("kind", "unit", "low", "high"), F.lit(n)))
    links = written(met.groupBy("group").applyInArrow(_links, "a long, b long"), "links")
    reached = components(links).withColumnRenamed("id", "rep")
    known = reps.join(reached, "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    return slim.join(known, same, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs(doc_id, text, ...) that stay, one document of each component, with all their columns."""
    key = row_key(docs)
    rows, _ = with_row_key(docs, key)
    found = _components_of_rows(rows.select(F.col(key).alias("doc_id"), "text"))
    kept = found.where("doc_id = component").select(F.col("doc_id").alias(key))
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
with recursive words as (
  select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos, len(words) as size
  from (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') as words from documents)
), runs as (
  select doc_id, size, pos, count(*) over w as n, string_agg(word, ' ') over w as run from words
  window w as (partition by doc_id order by pos rows between current row and 4 following)
), sets as (
  select distinct doc_id, run from runs where n = 5 or (size < 5 and pos = 1)
), sizes as (
  select doc_id, count(*) as n from sets group by doc_id
), links as (
  select a.doc_id as a, b.doc_id as b from sets a join sets b on a.run = b.run and a.doc_id < b.doc_id
  join sizes m on m.doc_id = a.doc_id join sizes n on n.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, m.n, n.n having 100 * count(*) >= 75 * (m.n + n.n - count(*))
), edges as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id as a, doc_id as b from documents union select r.a, e.b from reach r join edges e on e.a = r.b
), least as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, l.component_id, d.doc_id = l.component_id as kept
from documents d join least l on l.doc_id = d.doc_id left join sizes s on s.doc_id = d.doc_id
"""
