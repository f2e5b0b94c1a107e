"""What filters do to a corpus in every order they could be applied in.

A document is judged by all filters once, into a mask with one bit a failed filter. Only counts by part, mask and label
(the cells) go on. A recursive query then extends prefixes of filters by unused letters, mask by mask, carrying the bits
applied so far; each level says what its step does to a mask, and a join with the cells turns that into documents. The
recursion sees at most 2**filters masks, whatever the number of documents and parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import words
from llm.spark import table, written

LETTERS = "ABCDE"
#: A document without an id has no labels; its rows are dealt over so many join keys.
DEALT = 1024
#: Bytes of a text whose words are split at once.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = bytes(range(65, 91))
_FIELDS = "doc_id long, part string, mask int, digest binary"


class Limits(NamedTuple):
    """A: fewer words. B: a smaller percentage of distinct words. C: a larger percentage of A-Z. D: one of these signs.

    E, which has no parameter, is a text that a smaller doc_id has too.
    """

    words: int = 200
    distinct: int = 50
    upper: int = 3
    signs: str = "#$%&*|"


def word_counts(raw: bytes) -> tuple[int, int]:
    """(words, distinct words) of a text; a long one is split piece by piece."""
    n, seen, at = 0, set(), 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + PIECE) if at + PIECE < len(raw) else None
        end = cut.start() if cut else len(raw)
        own = raw[at:end].split()
        n += len(own)
        seen.update(own)
        at = end
    return n, len(seen)


def _judge(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    sign = re.compile(b"[" + re.escape(limits.signs.encode()) + b"]")
    for batch in batches:
        for first, texts in words.slices(batch["text"]):
            points = pc.utf8_length(texts).to_pylist()
            masks, digests = [], []
            for raw, n_points in zip(pc.cast(texts, pa.binary()).to_pylist(), points, strict=True):
                n, distinct = word_counts(raw)
                upper = len(raw) - len(raw.translate(None, _UPPER))
                mask = (n < limits.words) | (100 * distinct < limits.distinct * n) << 1
                masks.append(mask | (100 * upper > limits.upper * n_points) << 2 | (sign.search(raw) is not None) << 3)
                digests.append(hashlib.sha256(raw).digest())
            own = batch.slice(first, len(texts))
            columns = [own["doc_id"], own["part"], pa.array(masks, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "mask", "digest"])


def cells(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(part, mask, documents, good, toxic): documents of docs(doc_id, text, lang) by language and failed filters.

    Bit i of `mask` is filter LETTERS[i]. A null text is empty, a null language is the part ''. Every row is a document:
    rows of one doc_id do not fail E for each other, and a null doc_id comes before all others and has no labels. good
    and toxic count documents with a row of labels(doc_id, quality, toxic) that says 1. Other columns are left aside.
    """
    judged = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text").mapInArrow(
        lambda batches: _judge(batches, limits), _FIELDS
    )
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    dealt = F.when(F.col("doc_id").isNull(), F.floor(F.rand(5) * DEALT)).otherwise(0)
    labelled = (
        judged.withColumn("deal", dealt)
        .join(known.withColumn("deal", F.lit(0).cast("long")), ["doc_id", "deal"], "left")
        .select("doc_id", "part", "mask", "digest", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    )
    # a text is one row for each part and label before its copies meet: the least id there and the rows that have it
    same = ["digest", "part", "mask", "good", "toxic"]
    ids = labelled.groupBy(*same, "doc_id").agg(F.count("*").alias("n"))
    copies = ids.groupBy(*same).agg(F.min(F.struct("doc_id", "n")).alias("least"), F.sum("n").alias("n"))
    firsts = copies.groupBy("digest").agg(F.min(F.struct(F.col("least.doc_id").alias("doc_id"))).alias("first"))
    stay = F.when(F.col("least.doc_id").eqNullSafe(F.col("first.doc_id")), F.col("least.n")).otherwise(0)
    counted = copies.join(firsts, "digest").withColumn("stay", stay)
    repeated = F.lit(1 << LETTERS.index("E"))
    return (
        counted.select("part", "good", "toxic", F.inline(F.array(
            F.struct(F.col("mask").alias("mask"), F.col("stay").alias("n")),
            F.struct(F.col("mask").bitwiseOR(repeated).alias("mask"), (F.col("n") - F.col("stay")).alias("n")),
        )))
        .where("n > 0")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("documents"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


_AUDIT = """
with recursive walk (mask, prefix, unused, step, before, bit) as (
  select distinct mask, '', '{letters}', 0, 0, 0 from {cells}
  union all
  select mask, prefix || letter, replace(unused, letter, ''), step + 1, before | bit,
    shiftleft(1, instr('{letters}', letter) - 1)
  from (select *, explode(split(unused, '')) as letter from walk where unused <> '')
), steps as (
  select c.part, w.prefix, w.step, right(w.prefix, 1) as letter,
    sum(if(c.mask & (w.before | w.bit) = 0, c.documents, 0)) as kept,
    sum(if(c.mask & w.before = 0 and c.mask & w.bit <> 0, c.documents, 0)) as removed,
    sum(if(c.mask & w.before <> 0 and c.mask & w.bit <> 0, c.documents, 0)) as redundant,
    sum(if(c.mask = w.bit, c.documents, 0)) as unique_fails,
    sum(if(c.mask & w.before = 0 and c.mask & w.bit <> 0, c.good, 0)) as good_lost,
    sum(if(c.mask & w.before = 0 and c.mask & w.bit <> 0, c.toxic, 0)) as toxic_lost
  from walk w join {cells} c on c.mask = w.mask where w.step > 0 group by c.part, w.prefix, w.step
), orders as (
  select prefix as filter_order, explode(sequence(1, {n})) as step
  from (select distinct prefix from walk where step = {n})
)
select s.part, o.filter_order, o.step, s.kept, s.removed, s.redundant, s.unique_fails, s.good_lost, s.toxic_lost,
  sum(s.removed) over (partition by s.part, s.letter) as shapley
from orders o join steps s on s.prefix = left(o.filter_order, o.step)
"""


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of all `letters` and step, of cells(part, mask, documents, good, toxic).

    kept: documents left after the step; removed: by it; redundant: failing its filter, but removed before;
    unique_fails: failing its filter only; good_lost, toxic_lost: of those removed; shapley: removed by its filter, over
    all orders. Zeros are rows too; without cells there are no rows.
    """
    fixed = written(counted, "cells")  # at most 2**letters rows a part
    query = _AUDIT.replace("{letters}", letters).replace("{n}", str(len(letters)))
    return counted.sparkSession.sql(query, cells=fixed)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


SQL = r"""
with recursive docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), judged as (
  select doc_id, part,
    (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::int
    + 8 * regexp_matches(text, '[#$%&*|]')::int
    + 16 * (row_number() over (partition by text order by doc_id nulls first) > 1)::int as mask
  from docs
), cells as (
  select part, mask, count(*) as n, count(*) filter (where quality = 1) as good, count(*) filter (where toxic = 1) as toxic
  from judged left join labels using (doc_id) group by part, mask
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as bit
), walk as (
  select '' as filter_order, 0 as applied
  union all
  select filter_order || letter, applied | bit from walk, letters where applied & bit = 0
), steps as (
  select o.filter_order, k.step::int as step, substr(o.filter_order, k.step, 1) as letter, b.applied as before, l.bit
  from walk o, unnest([1, 2, 3, 4, 5]) as k(step), walk b, letters l
  where length(o.filter_order) = 5 and b.filter_order = left(o.filter_order, k.step - 1)
    and l.letter = substr(o.filter_order, k.step, 1)
), counted as (
  select part, filter_order, step, letter,
    coalesce(sum(n) filter (where mask & (before | bit) = 0), 0)::bigint as kept,
    coalesce(sum(n) filter (where mask & before = 0 and mask & bit > 0), 0)::bigint as removed,
    coalesce(sum(n) filter (where mask & before > 0 and mask & bit > 0), 0)::bigint as redundant,
    coalesce(sum(n) filter (where mask = bit), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (where mask & before = 0 and mask & bit > 0), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (where mask & before = 0 and mask & bit > 0), 0)::bigint as toxic_lost
  from steps, cells group by part, filter_order, step, letter
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint as shapley from counted
"""
