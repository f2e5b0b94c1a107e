"""Parameters of an extraction, read as SQL expressions over a row of texts."""

from __future__ import annotations

from viewlake.functions.iso_time import iso_timestamp
from viewlake.functions.json_text import single_value


def media_list(text: str) -> str:
    """SQL expression: the media ids of a text, each once, in the order given; NULL where it is no list of ids.

    Text that is JSON is a list of ids or one id as a JSON string; any other text holds ids between commas. White space
    around an id and empty ids do not count. A number in a list is the id it is written as.
    """
    value = f"try_parse_json({single_value(text)})"
    entry = "if(schema_of_variant(e) = 'STRING', try_variant_get(e, '$', 'string'), to_json(e))"
    listed = f"transform(try_variant_get(v, '$', 'array<variant>'), e -> {entry})"
    entries = (
        f"case when v is null then split({text}, ',') when schema_of_variant(v) = 'STRING'"
        f" then array(try_variant_get(v, '$', 'string')) else {listed} end"
    )
    tidy = f"transform({entries}, e -> regexp_replace(e, r'^\\s+|\\s+$', ''))"
    ids = f"array_distinct(filter({tidy}, e -> e <> ''))"
    return f"get(transform(array({value}), v -> nullif({ids}, cast(array() as array<string>))), 0)"


def iso_day(text: str) -> str:
    """SQL expression: the date that an ISO date without a time names; NULL for any other text."""
    return f"case when {text} rlike r'^[0-9W-]{{7,10}}\\z' then cast({iso_timestamp(text)} as date) end"


def window_problem(start: str, end: str) -> str:
    """SQL expression: what is wrong with the two bounds of a window, which may both be blank; NULL if nothing is."""
    first, last = f"nullif({start}, '')", f"nullif({end}, '')"
    return (
        f"case when {first} is null and {last} is null then null"
        f" when {first} is null or {last} is null then 'Give both window bounds or none.'"
        f" when {iso_day(first)} is null then concat('A window bound must be a date like 2026-01-31, not ', {first})"
        f" when {iso_day(last)} is null then concat('A window bound must be a date like 2026-01-31, not ', {last})"
        f" when {iso_day(first)} > {iso_day(last)} then concat('The window ', {first}, ' to ', {last}, ' is empty.') end"
    )


def window_bound(bound: str, run_date: str) -> str:
    """SQL expression: a bound as a date, by default the last full day before the run."""
    given = f"nullif({bound}, '')"
    return f"coalesce({iso_day(given)}, date_sub({run_date}, 1))"
