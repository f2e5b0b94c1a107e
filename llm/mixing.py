"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, read again from the start when it is empty, up to
MAX_PASSES times. A document's virtual finish time is the source's words up to and with it, divided by the source's
weight. The mix takes documents by virtual finish time until the budget is reached.

Running sums are taken in ranges (of the shuffle key within a source, of virtual time over all), so that no task sees
more than one range of one source, however large the source is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.spark import WORD, checkpointed, row_key, table, with_row_key

WEIGHTS = (5.0, 2.0, 1.0)
MAX_PASSES = 3
SEED = 20
#: Rows that a range of the shuffle key or of virtual time holds about.
RANGE_ROWS = 1 << 15


def n_words(text: Column) -> Column:
    """Words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Plan:
    sources: DataFrame  # source, source_size, weight, target
    bits: int  # bits of the shuffle key that name a range
    offsets: DataFrame  # of each source and range: `before`, the source's words in earlier ranges, and its row of sources
    cut: float  # last virtual finish time that the mix takes


def _draw(seed: int, key: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key))


def _range(bits: int) -> Column:
    return F.shiftright("draw", 64 - bits) if bits else F.lit(0).cast("long")


def _queued(rows: DataFrame, plan: Plan) -> DataFrame:
    """rows(source, size, draw, ...) with source_size, weight, target and `upto`, the source's words up to here."""
    keyed = rows.withColumn("range", _range(plan.bits))
    # one join by source and range, so that a large source is dealt out by range
    about = plan.offsets.select(F.col("source").alias("_s"), F.col("range").alias("_r"), "before", "source_size", "weight", "target")
    keyed = keyed.join(about, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
    order = Window.partitionBy("source", "range").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, 0)
    return keyed.withColumn("upto", F.col("before") + F.sum("size").over(order)).drop("range", "before", "_s", "_r")


def _finish(number: Column) -> Column:
    """Virtual finish time of a row's pass `number` (from 0)."""
    return (F.col("source_size") * number + F.col("upto")) / F.col("weight")


def _sources(sized: DataFrame, weights: tuple[float, ...], passes: int) -> DataFrame:
    """Sources with their weights: ranked by code point, null last, without gathering them in one task."""
    ordered = checkpointed(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).orderBy(F.asc_nulls_last("source"))
    )
    part = ordered.withColumn("part", F.spark_partition_id()).withColumn(
        "nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    counts = part.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select(F.col("part").alias("_p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = part.join(before, F.col("part") == F.col("_p"))
    weight = F.get(cycle, F.pmod(F.col("before") + F.col("nth"), F.lit(len(weights))).cast("int"))
    return checkpointed(ranked.select("source", "source_size", "rows", weight.alias("weight")))


def _level(sources: DataFrame, budget: float, passes: int) -> float:
    """The virtual time at which sources, each up to `passes` times its size, have given the budget."""
    level = 0.0
    capped = F.col("source_size") * passes <= F.col("weight") * F.lit(level)
    while True:
        row = sources.agg(
            F.sum(F.when(capped, F.col("source_size") * passes)).alias("full"), F.sum(F.when(~capped, F.col("weight"))).alias("open")
        ).first()
        if not row["open"]:
            return level
        new = (budget - float(row["full"] or 0)) / row["open"]
        if new <= level:
            return level
        level = new
        capped = F.col("source_size") * passes <= F.col("weight") * F.lit(level)


def plan_mix(
    sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = MAX_PASSES, share: float = 1.0
) -> Plan:
    """Targets and cut for sized(source, size, draw, ...), which is read several times."""
    sources = _sources(sized, weights, passes)
    row = sources.agg(F.sum("source_size").alias("size"), F.sum("rows").alias("rows")).first()
    budget = share * float(row["size"] or 0)
    level = _level(sources, budget, passes)
    target = F.least((F.col("source_size") * passes).cast("double"), F.col("weight") * level)
    sources = sources.select("source", "source_size", "weight", target.alias("target"))
    ranges = max(1, (row["rows"] or 0) // RANGE_ROWS)
    bits = math.ceil(math.log2(ranges))
    sums = sized.withColumn("range", _range(bits)).groupBy("source", "range").agg(F.sum("size").alias("n"))
    # one row for each range of a source
    before = F.sum("n").over(Window.partitionBy("source").orderBy("range")) - F.col("n")
    sums = sums.select(F.col("source").alias("_s"), "range", before.alias("before"))
    offsets = checkpointed(sums.join(sources, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    plan = Plan(sources, bits, offsets, math.inf)
    if not budget or not level:
        return plan
    entries = (
        _queued(sized.where("size > 0"), plan)
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
        .select("size", _finish(F.col("number")).alias("finish"))
    )
    slots = ranges * 4 * passes
    entries = entries.withColumn("slot", F.least(F.floor(F.col("finish") / level * slots), F.lit(4 * slots)))
    # one row for each slot of virtual time
    total = F.sum("n").over(Window.orderBy("slot"))
    by_slot = entries.groupBy("slot").agg(F.sum("size").alias("n"), F.max("finish").alias("last")).withColumn("total", total)
    whole = by_slot.where(F.col("total") <= budget).agg(F.max("total").alias("total"), F.max("last").alias("last")).first()
    crossing = by_slot.where(F.col("total") > budget).agg(F.min("slot")).first()[0]
    cut = whole["last"] if whole["last"] is not None else -1.0
    if crossing is not None:
        inside = entries.where(F.col("slot") == crossing).groupBy("finish").agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.orderBy("finish")) + (whole["total"] or 0)
        last = inside.withColumn("upto", upto).where(F.col("upto") <= budget).agg(F.max("finish")).first()[0]
        cut = last if last is not None else cut
    return Plan(sources, bits, offsets, float(cut))


def sizes(rows: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, draw) of rows with a key each; equal ids draw on their own, so none share a range."""
    return rows.select("doc_id", "source", n_words(F.col("text")).alias("size"), _draw(seed, key).alias("draw"))


def _passes(plan: Plan, passes: int) -> Column:
    """How often the mix takes a row."""
    taken = sum((F.when(_finish(F.lit(k)) <= plan.cut, 1).otherwise(0) for k in range(1, passes)), F.when(_finish(F.lit(0)) <= plan.cut, 1).otherwise(0))
    return F.when(F.col("size") > 0, taken).otherwise(1)


def shares(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = MAX_PASSES, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, passes, taken) of every row of docs(doc_id, text, source).

    Sources in code-point order, null last, have the weights in turn. `target` shares the words of all rows by weight,
    at most `passes` times a source's own words; `taken` is what the mix takes of a row, repeats counted. Documents are
    taken whole, so a source stays within a document of its target. Null and empty texts have size 0 and are kept once.
    Rows of one doc_id are rows of their own. An empty table gives no rows.
    """
    rows, _ = with_row_key(docs.select("doc_id", "text", "source"), "row")
    sized = checkpointed(sizes(rows, "row", seed))
    plan = plan_mix(sized, weights, passes)
    out = _queued(sized, plan).withColumn("passes", _passes(plan, passes))
    return out.select("doc_id", "source", "size", "source_size", "target", "passes", (F.col("size") * F.col("passes")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = MAX_PASSES, seed: int = SEED) -> DataFrame:
    """The rows that the mix takes, repeated as it repeats them, with the columns of docs(doc_id, text, source, ...)."""
    key = row_key(docs)
    rows, _ = with_row_key(docs, key)
    plan = plan_mix(checkpointed(sizes(rows, key, seed)), weights, passes)
    row = rows.select(F.struct(*docs.columns).alias("row"), "source", n_words(F.col("text")).alias("size"), _draw(seed, key).alias("draw"))
    taken = _queued(row, plan).withColumn("passes", _passes(plan, passes)).where("passes > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("passes")))).select("row.*")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "passes")
