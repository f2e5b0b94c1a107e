"""Line dedup by an exact set-similarity join, in DataFrame functions alone.

Lines with equal word sets are one class, known by its first line. A class's tokens are put in order of rarity, as counted over all texts, and only
a prefix is indexed: two sets whose Jaccard similarity reaches the threshold share a token of their prefixes. In the
join on tokens, pairs are dropped by length, by the position of the shared token (which bounds what can follow), and by
64-bit maps of each set (whose differing bits bound the sets' difference). What is left is verified on the words, the
likeliest pair of a line first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.spark import WORD, sha256_hex, table, with_doc_id, with_row_key, written_alone

#: Lines match if their word sets have at least this Jaccard similarity, in percent.
PERCENT = 80
#: Counters (as a power of two) that count all tokens by hash; a token is as rare as its counter says. This bounds what
#: goes to every task to a number a counter. Tokens that share a counter only make the order less sharp: any order that
#: is the same for all lines gives the same matches.
COUNTERS = 17
#: Levels of rarity that a doubling of a counter makes; 2^31 is the last count of a level of its own.
LEVELS = 2
#: Sets of more words have a map of 128 bits, as many of them differ in few enough of 64 bits without being alike.
WIDE = 96
#: Prefixes keep so many bits of a token, which may only add candidates.
TOKEN_BITS = 31


def _parts(line: Column) -> Column:
    """The words of a line, with empty strings between white space that meets.

    A split by one character needs no pattern, and few lines hold other white space than spaces.
    """
    other = F.contains(line, F.lit("\t"))
    for c in "\x0b\x0c\r":
        other = other | F.contains(line, F.lit(c))
    return F.when(other, F.split(line, r"[\x20\x09-\x0D]")).otherwise(F.split(line, " "))


def _words(line: Column) -> Column:
    return F.array_remove(F.array_distinct(_parts(line)), "")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _slot(token: Column) -> Column:
    return token.bitwiseAND(F.lit((1 << COUNTERS) - 1)).cast("int")


def _levels(docs: DataFrame) -> Column:
    """Of each counter over the words of all texts, its logarithm, as an array."""
    words = docs.select(F.explode(_lines(F.col("text"))).alias("line")).select(F.explode(_parts(F.col("line"))).alias("w")).where("w <> ''")
    counts = words.groupBy(_slot(F.xxhash64("w")).alias("slot")).count()
    level = F.least(F.ceil(F.log2("count") * LEVELS).cast("int"), F.lit(LEVELS * 31)) + 1
    out = ["0"] * (1 << COUNTERS)
    for r in counts.select("slot", level.alias("level")).collect():  # one row a counter
        out[r["slot"]] = str(r["level"])
    return F.split(F.lit(",".join(out)), ",").cast("array<int>")


def _place(token: Column, levels: Column) -> Column:
    """Where a token stands in the order of rarity: the level of its counter, then its hash."""
    level = F.coalesce(F.get(levels, _slot(token)), F.lit(0))
    return F.shiftleft(level.cast("long"), 57).bitwiseOR(F.shiftrightunsigned(token, 7))


def _classes(docs: DataFrame, levels: Column, percent: int) -> DataFrame:
    """(doc_id, line, n, bits, more, prefix) of each class of equal word sets, by its first line."""
    lines = docs.select("doc_id", F.posexplode(_lines(F.col("text"))).alias("line", "words"))
    hashes = F.array_distinct(F.transform(_parts(F.col("words")), lambda w: F.xxhash64(w)))
    tokens = lines.select("doc_id", "line", F.array_remove(hashes, F.xxhash64(F.lit(""))).alias("t")).where(F.size("t") > 0)
    # a bit says whether the number of its tokens is odd: a token that one set has alone turns one bit of `bits`, and for
    # half of all tokens the same bit of `more`, so that `bits` without `more`, and `more`, are a map of 128 bits
    bit = lambda t, of: F.call_function("shiftleft", of, t.bitwiseAND(F.lit(63)).cast("int"))
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    bits = F.aggregate("t", none, lambda a, t: a.bitwiseXOR(bit(t, one)))
    more = F.aggregate("t", none, lambda a, t: a.bitwiseXOR(bit(t, F.shiftright(t, 6).bitwiseAND(one))))
    tokens = tokens.select(
        "doc_id", "line", F.size("t").alias("n"), bits.alias("bits"), F.when(F.size("t") > WIDE, more).otherwise(none).alias("more"),
        F.sort_array(F.transform("t", lambda t: _place(t, levels))).alias("order"),
    )
    # a match leaves out less than n - ceil(percent * n) tokens, so one of so many and one more is shared
    size = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    prefix = F.transform(F.slice("order", F.lit(1), size), lambda t: t.bitwiseAND(F.lit((1 << TOKEN_BITS) - 1)).cast("int"))
    keyed = tokens.select(F.xxhash64("order").alias("key1"), F.xxhash64(F.lit(7), "order").alias("key2"), F.struct("doc_id", "line", "n", "bits", "more", prefix.alias("prefix")).alias("c"))
    return keyed.groupBy("key1", "key2").agg(F.min("c").alias("c")).select("c.*")


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """(a_doc_id, a_line, b_doc_id, b_line, differ): classes and earlier ones that pass all filters, and how many bits differ."""
    mask = F.lit((1 << TOKEN_BITS) - 1)
    shift = lambda c, n: F.shiftleft(F.col(c).cast("long"), n)
    rows = classes.select("doc_id", "line", "n", "bits", "more", F.posexplode("prefix").alias("p", "token"))
    # all rows are shuffled, so what is small goes two to a long
    rows = rows.select(shift("line", TOKEN_BITS).bitwiseOR(F.col("token").cast("long")).alias("at"), "doc_id", shift("n", 32).bitwiseOR(F.col("p").cast("long")).alias("place"), "bits", "more")
    a, b = (rows.select(*[F.col(c).alias(f"{s}_{c}") for c in rows.columns]) for s in "ab")
    n_a, n_b = (F.shiftright(f"{s}_place", 32) for s in "ab")
    left = F.least(*[F.shiftright(f"{s}_place", 32) - F.col(f"{s}_place").bitwiseAND(F.lit((1 << 32) - 1)) for s in "ab"])
    bits, more = (F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}")) for c in ("bits", "more"))
    differ = F.when(F.least(n_a, n_b) > WIDE, F.bit_count(bits.bitwiseXOR(more)) + F.bit_count(more)).otherwise(F.bit_count(bits))
    line_a, line_b = (F.shiftright(f"{s}_at", TOKEN_BITS).cast("int") for s in "ab")
    found = a.join(b, F.col("a_at").bitwiseAND(mask) == F.col("b_at").bitwiseAND(mask)).where(
        ((F.col("b_doc_id") < F.col("a_doc_id")) | ((F.col("b_doc_id") == F.col("a_doc_id")) & (line_b < line_a)))
        & (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent)
        & (left * (100 + percent) >= (n_a + n_b) * percent)
        & (differ * (100 + percent) <= (n_a + n_b) * (100 - percent))
    )
    return found.select("a_doc_id", line_a.alias("a_line"), "b_doc_id", line_b.alias("b_line"), differ.alias("differ")).distinct()


def _verified(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, line) of the later lines of pairs whose word sets match.

    A line needs one match, so its likeliest earlier line is tried first, and the others only where that one fails.
    """
    end = lambda s: F.struct(F.col(f"{s}_doc_id").alias("doc_id"), F.col(f"{s}_line").alias("line"))
    needed = pairs.select(F.explode(F.array(end("a"), end("b"))).alias("e")).select("e.*").groupBy("doc_id").agg(F.collect_set("line").alias("needed"))
    lines = docs.join(needed, "doc_id").select("doc_id", _lines(F.col("text")).alias("lines"), F.explode("needed").alias("line"))
    # lines travel as they are, which is less than their words one by one
    lines = lines.select("doc_id", "line", F.get("lines", F.col("line")).alias("own"))

    def matches(tried: DataFrame) -> tuple[Column, DataFrame]:
        for s in "ab":
            side = lines.select(*[F.col(c).alias(f"{s}_{c}") for c in lines.columns])
            tried = tried.join(side, [f"{s}_doc_id", f"{s}_line"], "left")
        a, b = _words(F.col("a_own")), _words(F.col("b_own"))
        return F.coalesce(F.size(F.array_intersect(a, b)) * (100 + percent) >= (F.size(a) + F.size(b)) * percent, F.lit(False)), tried

    line = ["a_doc_id", "a_line"]
    best = pairs.groupBy(*line).agg(F.min(F.struct("differ", "b_doc_id", "b_line")).alias("b")).select(*line, "b.b_doc_id", "b.b_line")
    match, tried = matches(best)
    first = tried.select(*line, match.alias("gone"))
    others = pairs.select(*[F.col(c).alias(f"o_{c}") for c in pairs.columns])
    again = first.join(others, (F.col("a_doc_id") == F.col("o_a_doc_id")) & (F.col("a_line") == F.col("o_a_line")) & ~F.col("gone"), "left")
    match, tried = matches(again.select(*line, "gone", F.col("o_b_doc_id").alias("b_doc_id"), F.col("o_b_line").alias("b_line")))
    return tried.where(F.col("gone") | match).select(F.col("a_doc_id").alias("doc_id"), F.col("a_line").alias("line")).distinct()


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept) of every row of docs(doc_id, text).

    Lines end at line feeds; a line's set holds its distinct words, runs of anything but ASCII white space. A line goes if
    an earlier one (smaller doc_id, or before in the document), removed or not, has a set of at least `percent` Jaccard
    similarity. Lines without words stay. `kept` is what stays, joined by line feeds. A null text has no lines, a null
    doc_id comes before all others. Each row is a document of its own: rows of one doc_id, or without one, follow each
    other in the order of a hash of their texts. Other columns are left aside; an empty table gives no rows.
    """
    rows, by_id = with_row_key(docs.select("doc_id", "text"), "row")
    keyed = rows.select(F.col("row").alias("doc_id"), "text")
    # read twice, with and without prefixes: written once, as the words of all texts went into it
    classes = written_alone(_classes(keyed, _levels(keyed), percent), "lines")
    # likewise, as the verification reads pairs and the lines they name
    pairs = written_alone(_candidates(classes, percent), "pairs")
    gone = _verified(keyed, pairs, percent)
    stays = classes.select("doc_id", "line").join(gone, ["doc_id", "line"], "left_anti").groupBy("doc_id").agg(F.collect_list("line").alias("stays"))
    lines = keyed.join(stays, "doc_id", "left").select(
        "doc_id", F.coalesce(_lines(F.col("text")), F.array().cast("array<string>")).alias("lines"), F.coalesce("stays", F.array().cast("array<int>")).alias("stays")
    )
    at = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>"))
    blank = F.filter(at, lambda i: ~F.get("lines", i).rlike(WORD))
    kept = F.sort_array(F.array_intersect(at, F.concat(blank, "stays")))
    out = lines.select("doc_id", "lines", kept.alias("at"))
    found = out.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("at")).cast("long").alias("n_removed"),
        F.array_join(F.transform("at", lambda i: F.get("lines", i)), "\n").alias("kept"),
    )
    return found if by_id else with_doc_id(found, rows)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256"))


SQL = r"""
with lines as (
  select doc_id, line, l, list_sort(list_distinct(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))) as words
  from (select doc_id, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) as line
        from documents)
), classes as (
  select row_number() over (order by doc_id, line) as id, doc_id, line, words, len(words) as n
  from (select *, row_number() over (partition by words order by doc_id, line) as nth from lines where len(words) > 0)
  where nth = 1
), tokens as (
  select id, n, unnest(words) as w from classes
), later as (
  select distinct id from (
    select a.id from tokens a join tokens b
      on a.w = b.w and b.id < a.id and least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
    group by a.id, b.id, a.n, b.n having count(*) * 180 >= (a.n + b.n) * 80)
), marked as (
  select l.doc_id, l.line, l.l, len(l.words) = 0 or c.id is not null as stays
  from lines l left join (select * from classes where id not in (select id from later)) c using (doc_id, line)
)
select d.doc_id, count(m.line)::bigint as n_lines, (count(m.line) - count(*) filter (where m.stays))::bigint as n_removed,
  sha256(coalesce(string_agg(m.l, chr(10) order by m.line) filter (where m.stays), '')) as kept_sha256
from documents d left join marked m using (doc_id) group by d.doc_id
"""
