"""Preference formatting, in DataFrame functions alone.

Of a chosen and a rejected conversation the longest common run of first turns is rendered once, as the prompt; the rest
of each is a completion, with the spans of characters that a loss counts (what an assistant says, and its end mark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.spark import table

#: The template. Fixed values; `<|` in a text is written `< |`, so that a text cannot forge a mark.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNS = "assistant"

TURN = "struct<role:string,text:string>"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(turn["role"]), F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(END))


def _safe(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _spans(turns: Column) -> Column:
    """[start, end) in characters of what the turns rendered hold for a loss."""
    sized = F.transform(
        turns, lambda t: F.struct(F.char_length(_head(t)).alias("h"), F.char_length(_body(t)).alias("b"), F.equal_null(t["role"], F.lit(LEARNS)).alias("on"))
    )
    step = lambda s, t: F.struct(
        (s["at"] + t["h"] + t["b"]).alias("at"),
        F.concat(
            s["spans"],
            F.when(t["on"], F.array(F.struct((s["at"] + t["h"]).alias("start"), (s["at"] + t["h"] + t["b"]).alias("end"))))
            .otherwise(F.array().cast("array<struct<start:int,end:int>>")),
        ).alias("spans"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(sized, zero, step)["spans"]


def common_prefix(a: Column, b: Column) -> Column:
    """Number of first elements that two arrays share; nulls are equal."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: F.equal_null(x, y))
    at = F.array_position(same, F.lit(False))
    return F.when(at == 0, n).otherwise(at.cast("int") - 1)


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, n_prompt, prompt, chosen, rejected, chosen_spans, rejected_spans) of pairs(pair_id, chosen, rejected).

    chosen and rejected are arrays of struct<role, text>; null counts as no turns. A null role or text is rendered as an
    empty one, and equals only null. If one conversation begins the other, its completion is empty; two equal ones
    leave both empty. Pairs that repeat give a row each; other columns are left aside; no pairs give no rows.
    """
    none = F.array().cast(f"array<{TURN}>")
    both = pairs.select("pair_id", F.coalesce("chosen", none).alias("chosen"), F.coalesce("rejected", none).alias("rejected"))
    both = both.withColumn("n_prompt", common_prefix(F.col("chosen"), F.col("rejected")))
    rest = lambda side: F.slice(F.col(side), F.col("n_prompt") + 1, F.greatest(F.size(side) - F.col("n_prompt"), F.lit(0)))
    parts = both.select(
        "pair_id", "n_prompt", F.slice("chosen", F.lit(1), F.col("n_prompt")).alias("prompt"),
        rest("chosen").alias("chosen"), rest("rejected").alias("rejected"),
    )
    return parts.select(
        "pair_id", "n_prompt", _rendered(F.col("prompt")).alias("prompt"),
        _rendered(F.col("chosen")).alias("chosen"), _rendered(F.col("rejected")).alias("rejected"),
        _spans(F.col("chosen")).alias("chosen_spans"), _spans(F.col("rejected")).alias("rejected_spans"),
    )


def answer_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected): each conversation against itself with another's last answer.

    Conversations 2k and 2k + 1 lend each other their last assistant turn. A conversation without one has the other's
    turn added at its end; one without a partner, or whose partner has no answer, is cut before its last answer. Turns
    are in order of (turn, role, text), nulls first. Rows of a null conv_id belong to no conversation and are left aside.
    """
    turn = F.struct("turn", "role", "text")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.shiftright("conv_id", 1).alias("two"), "conv_id", turn.alias("t")
    )
    both = rows.groupBy("two").agg(F.sort_array(F.collect_list(F.struct("conv_id", "t"))).alias("all"))
    plain = lambda x: F.struct(x["t"]["role"].alias("role"), x["t"]["text"].alias("text"))

    def side(odd: int) -> Column:
        return F.transform(F.filter("all", lambda x: x["conv_id"].bitwiseAND(F.lit(1)) == odd), plain)

    sides = both.select("two", side(0).alias("s0"), side(1).alias("s1"))
    answers = lambda s: F.filter(s, lambda t: F.equal_null(t["role"], F.lit(LEARNS)))
    sides = sides.select("two", "s0", "s1", F.try_element_at(answers(F.col("s0")), F.lit(-1)).alias("a0"), F.try_element_at(answers(F.col("s1")), F.lit(-1)).alias("a1"))

    def pair(own: int) -> Column:
        turns, other = F.col(f"s{own}"), F.col(f"a{1 - own}")
        learns = F.transform(turns, lambda t, i: F.when(F.equal_null(t["role"], F.lit(LEARNS)), i).otherwise(-1))
        last = F.array_max(learns)
        before = F.slice(turns, F.lit(1), F.when(last >= 0, last).otherwise(F.size(turns)))
        lent = F.when(other.isNotNull(), F.array(other)).otherwise(F.array().cast(f"array<{TURN}>"))
        return F.struct((F.shiftleft("two", 1) + own).alias("pair_id"), turns.alias("chosen"), F.concat(before, lent).alias("rejected"))

    each = sides.select(F.explode(F.array(pair(0), pair(1))).alias("p")).select("p.*")
    return each.where(F.size("chosen") > 0)


def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = format_pairs(answer_pairs(table(spark, sf_dir, "conversations")))
    flat = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return out.select(
        F.col("pair_id").alias("conv_id"), F.col("n_prompt").cast("long").alias("n_prompt"), "prompt", "chosen", "rejected",
        flat(F.col("chosen_spans")).alias("chosen_spans"), flat(F.col("rejected_spans")).alias("rejected_spans"),
    )


SQL = """
with turns as (
  select conv_id, role, text, row_number() over (partition by conv_id
           order by turn nulls first, role nulls first, text nulls first) as n
  from conversations where conv_id is not null
), ends as (
  select conv_id, count(*) as size, max(n) filter (where role = 'assistant') as last from turns group by conv_id
), answers as (
  select e.conv_id, t.text from ends e join turns t on t.conv_id = e.conv_id and t.n = e.last
), cuts as (
  select e.conv_id, coalesce(e.last - 1, e.size) as before, p.conv_id is not null as lent, p.text as lent_text,
    case when e.last is not null and p.conv_id is not null and o.text is not distinct from p.text
      then e.last else coalesce(e.last - 1, e.size) end as n_prompt
  from ends e left join answers o using (conv_id) left join answers p on p.conv_id = xor(e.conv_id, 1)
), rendered as (
  select t.conv_id, t.n, t.role is not distinct from 'assistant' as learns, c.n_prompt,
    '<|' || replace(coalesce(t.role, ''), '<|', '< |') || '|>' || chr(10) as head,
    replace(coalesce(t.text, ''), '<|', '< |') || '<|end|>' || chr(10) as body
  from turns t join cuts c using (conv_id)
), placed as (
  select *, coalesce(sum(length(head) + length(body)) filter (where n > n_prompt) over (
    partition by conv_id order by n rows between unbounded preceding and 1 preceding), 0) + length(head) as start
  from rendered
), sides as (
  select conv_id, coalesce(string_agg(head || body, '' order by n) filter (where n <= n_prompt), '') as prompt,
    coalesce(string_agg(head || body, '' order by n) filter (where n > n_prompt), '') as chosen,
    coalesce(string_agg(start::bigint || '-' || (start + length(body))::bigint, ',' order by n)
      filter (where n > n_prompt and learns), '') as chosen_spans
  from placed group by conv_id
), rejected as (
  select conv_id, n_prompt, case when lent and n_prompt <= before then '<|assistant|>' || chr(10)
    || replace(coalesce(lent_text, ''), '<|', '< |') || '<|end|>' || chr(10) else '' end as rejected
  from cuts
)
select s.conv_id, r.n_prompt::bigint as n_prompt, s.prompt, s.chosen, r.rejected, s.chosen_spans,
  case when r.rejected = '' then '' else '14-' || length(r.rejected) end as rejected_spans
from sides s join rejected r using (conv_id)
"""
