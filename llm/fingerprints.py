"""One-permutation MinHash fingerprints, in DataFrame functions alone.

Each shingle is hashed once; its highest bits name a bin, and a bin keeps its least hash. An empty bin takes the value
of the non-empty bin that comes first in the bin's own order of all bins (optimal densification, probing a permutation).
A fingerprint holds the four lowest bits of each bin; as those agree by chance once in 16, likeness is corrected for it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.spark import WORD, input_bytes, sha256_hex, table, with_row_key, written

SHINGLE = 5
#: Bins are named by the highest BIN_BITS bits of a hash; each gives NIBBLE bits.
BIN_BITS, NIBBLE = 8, 4
BINS = 1 << BIN_BITS
_PER_LONG = 64 // NIBBLE
_LOWEST = 0x1111111111111111
#: Probes that are tried one by one before all non-empty bins are ranked.
PROBES = 12
#: Bytes of input in a range of ids, which a window task reads (and spills, if it must).
RANGE_BYTES = 16 << 20


def _priority(bin_: Column, other: Column) -> Column:
    """Where `other` stands in the order of bins that `bin_` probes."""
    return F.xxhash64(bin_.cast("int"), other.cast("int"))


def _bin(hash_: Column) -> Column:
    return (F.shiftright(hash_, 64 - BIN_BITS) + BINS // 2).cast("int")


def _probes(spark: SparkSession) -> list[list[int]]:
    """The first PROBES bins in the order of each bin."""
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    order = lambda b: F.slice(F.transform(F.array_sort(F.transform(every, lambda o: F.struct(_priority(b, o).alias("p"), o.alias("o")))), lambda s: s["o"]), 1, PROBES)
    return spark.range(1).select(F.transform(every, order)).first()[0]


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def with_codes(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of a text column as an array of longs, empty for a text without words.

    Shingles are runs of SHINGLE words; a text of fewer words is one shingle as a whole.
    """
    probes = F.lit(_probes(df.sparkSession))
    step = df.withColumn("_w", F.transform(word_list(F.col(text)), lambda w: F.xxhash64(w)))
    n = F.size("_w")
    long_ = F.transform(
        F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(SHINGLE)])
    )
    step = step.withColumn("_s", F.sort_array(F.when(n >= SHINGLE, long_).when(n > 0, F.array(F.xxhash64("_w"))).otherwise(F.array().cast("array<bigint>"))))
    first = lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(F.col("_s"), i - 1)))
    step = step.withColumn("_m", F.filter("_s", first)).drop("_s")
    gap = lambda i: _bin(F.get(F.col("_m"), i)) - F.when(i > 0, _bin(F.get(F.col("_m"), i - 1))).otherwise(-1) - 1
    none = F.lit(None).cast("bigint")
    filled = F.flatten(F.transform("_m", lambda x, i: F.concat(F.array_repeat(none, gap(i)), F.array(x))))
    last = F.coalesce(_bin(F.get(F.col("_m"), F.size("_m") - 1)), F.lit(-1))
    step = step.withColumn("_d", F.concat(filled, F.array_repeat(none, BINS - 1 - last)))

    def dense(x: Column, b: Column) -> Column:
        tries = [F.get(F.col("_d"), F.get(F.get(probes, b), F.lit(t))) for t in range(PROBES)]
        ranked = F.array_min(F.transform("_m", lambda m: F.struct(_priority(b, _bin(m)).alias("p"), m.alias("m"))))["m"]
        return F.coalesce(x, *tries, ranked).bitwiseAND(F.lit((1 << NIBBLE) - 1))

    pack = lambda d: F.transform(
        F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)),
        lambda i: F.aggregate(F.slice(d, i * _PER_LONG + 1, _PER_LONG), F.lit(0).cast("bigint"), lambda a, x: F.shiftleft(a, NIBBLE).bitwiseOR(x)),
    )
    # a lambda variable holds the filled bins, which would else be computed for every long
    packed = F.transform(F.array(F.transform("_d", dense)), pack)[0]
    code = F.when(F.size("_m") > 0, packed).otherwise(F.array().cast("array<bigint>"))
    return step.withColumn(name, code).drop("_w", "_m", "_d")


def text_of(codes: Column) -> Column:
    """A fingerprint as lowercase hexadecimal text."""
    return F.array_join(F.transform(codes, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints; 1 for two without shingles, 0 for one."""

    def equal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        return F.bit_count(F.bitwise_not(z).bitwiseAND(F.lit(_LOWEST)))

    same = F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << NIBBLE)
    value = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(value)


def _with_range(docs: DataFrame) -> DataFrame:
    """Adds `range`: ascending ranges of `row` with about RANGE_BYTES of the input each."""
    n = max(1, input_bytes(docs) // RANGE_BYTES)
    points = [k / n for k in range(1, n)]
    bounds = sorted(set(docs.agg(F.percentile_approx("row", points, 10 * n)).first()[0] or [])) if points else []
    if not bounds:
        return docs.withColumn("range", F.lit(0))
    step = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= F.col("row")))
    group = below(F.lit([g[0] for g in groups])) - 1
    place = F.when(group < 0, 0).otherwise(group * step + below(F.get(F.lit(groups), group)))
    return docs.withColumn("range", place.cast("int"))


def with_next(docs: DataFrame, add: Callable[[DataFrame], DataFrame], added: list[str]) -> DataFrame:
    """`add` applied to docs(row, text, ...), and next_<column> for `text` and `added`: of the next row, after the last of the first.

    Rows are put in order range by range. The first row of each range is looked up apart, before `add`, so that what
    `add` computes is computed once a row and once more for these.
    """
    cols = ["text", *added]
    order = Window.partitionBy("range").orderBy("row")
    ranged = _with_range(docs)
    led = add(ranged).withColumn("_next", F.lead(F.struct(*cols)).over(order))
    heads = ranged.groupBy("range").agg(F.min("row").alias("head"))
    # where a range ends, the head of the next one follows, behind the last range the first of all
    following = F.coalesce(F.lead("head").over(Window.orderBy("range")), F.first("head").over(Window.orderBy("range")))
    heads = written(heads.select(F.col("range").alias("_r"), following.alias("_row")), "heads")  # a number for each RANGE_BYTES
    found = add(docs.join(F.broadcast(heads.select(F.col("_row").alias("row")).distinct()), "row", "left_semi"))
    texts = heads.join(found.select(F.col("row").alias("_row"), F.struct(*cols).alias("_head")), "_row").drop("_row")
    # no hint: rows lie by range already, and the heads' texts have no bound
    out = led.join(texts, F.col("range") == F.col("_r"), "left")
    after = F.coalesce("_next", "_head")
    return out.select(*docs.columns, *added, *[after[c].alias(f"next_{c}") for c in cols])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of docs(doc_id, text): equal texts have equal fingerprints.

    A text that is null or has no words has the empty fingerprint.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_codes(rows, "text", "codes").select("doc_id", text_of(F.col("codes")).alias("fingerprint"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Every text with its second half replaced from the next document, both fingerprints, and likenesses.

    (doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of every row of
    docs(doc_id, text). Null texts are empty; rows without a doc_id come first, and rows of one doc_id follow each
    other in the order of a hash of their texts; an empty table gives no rows; other columns are left aside.
    """
    rows, _ = with_row_key(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "row")
    both = with_next(rows, lambda df: with_codes(df, "text", "codes"), ["codes"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "codes", "next_codes", edited.alias("edited"))
    both = with_codes(both, "edited", "edited_codes")
    return both.select(
        "doc_id", "n_chars", "edited",
        text_of(F.col("codes")).alias("fingerprint"), text_of(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = edited_pairs(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", sha256_hex(F.col("edited")).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )
