"""ISO 8601 times as SQL expressions: one grammar for the rule that checks them and the value that is loaded."""

from __future__ import annotations

_TIME = r"([01]\d|2[0-3])(?:(:?)([0-5]\d)(?:\{same}([0-5]\d)(?:[.,](\d+))?)?)?"


def _pattern(date: str, groups: int) -> str:
    """The date, any separator, a time and an offset; minutes and seconds use a colon both or neither."""
    time = _TIME.replace("{same}", str(groups + 2))
    offset = _TIME.replace("{same}", str(groups + 8))
    return f"(?s)^{date}(?:.{time}(?:([+-]){offset})?)?\\z"


# Hyphens are used throughout a date or not at all. A digit behind the week is its day unless more digits follow.
_CALENDAR = _pattern(r"((?!0000)\d{4})(-?)(\d{2})\2(\d{2})", 4)
_WEEK = _pattern(r"((?!0000)\d{4})(-?)W(\d{2})(?:\2([1-7])(?!\d))?", 4)
# The form nearly every time has, which a plain cast reads as the grammar does.
_USUAL = r"^(?!0000)\d{4}-\d{2}-\d{2}T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{1,6})?Z\z"


def _groups(first: int) -> str:
    """Hour, minute, second and fraction of a time whose hour is group `first`."""
    return "|".join(f"${first + k}" for k in (0, 2, 3, 4))


def iso_timestamp(text: str) -> str:
    """SQL expression: the time that an ISO date or date-time names, as a TIMESTAMP; NULL for any other text.

    The date may be a calendar or a week date, with or without hyphens, the separator any character, the fraction of any
    length behind a point or comma (microseconds are kept). Without an offset a time is one of the session's zone. A time
    cut short before its offset (``12:30:+01:00``) and a digit as separator behind a week without hyphens are refused.
    """
    plain = f"replace({text}, 'Z', '+00:00')"
    parts = (
        f"case when {plain} rlike r'{_CALENDAR}'"
        f" then split(regexp_replace({plain}, r'{_CALENDAR}', '$1-$3-$4|{_groups(5)}|$10|{_groups(11)}'), r'\\|')"
        f" when {plain} rlike r'{_WEEK}'"
        f" then split(regexp_replace({plain}, r'{_WEEK}', '$1-$3-$4|{_groups(5)}|$10|{_groups(11)}'), r'\\|') end"
    )
    # the date of a week is that of its days counted from the Monday of the week of 4 January
    monday = "cast(date_trunc('week', make_date(int(split(p[0], '-')[0]), 1, 4)) as date)"
    week, day = "int(split(p[0], '-')[1])", "int(coalesce(nullif(split(p[0], '-')[2], ''), '1'))"
    thursday = f"date_add({monday}, {week} * 7 - 4)"
    of_week = (
        f"case when {week} > 0 and year({thursday}) = int(split(p[0], '-')[0])"
        f" and year(date_add({monday}, {week} * 7 + {day} - 8)) < 10000"
        f" then string(date_add({monday}, {week} * 7 + {day} - 8)) end"
    )
    is_week = f"{plain} rlike r'^.{{4}}-?W'"
    date = f"case when {is_week} then {of_week} else p[0] end"

    def number(k: int) -> str:
        return f"coalesce(nullif(p[{k}], ''), '00')"

    def seconds(k: int) -> str:
        return f"concat({number(k)}, '.', substring(rpad(p[{k + 1}], 6, '0'), 1, 6))"

    local = f"try_cast(concat({date}, ' ', {number(1)}, ':', {number(2)}, ':', {seconds(3)}) as timestamp_ntz)"
    ahead = f"make_dt_interval(0, int({number(6)}), int({number(7)}), cast({seconds(8)} as decimal(8, 6)))"
    moment = (
        f"case when p[5] = '' then cast({local} as timestamp) else cast(convert_timezone('UTC', current_timezone(),"
        f" case p[5] when '+' then {local} - {ahead} else {local} + {ahead} end) as timestamp) end"
    )
    # lambdas are interpreted, so the whole grammar is left to the times that need it
    return (
        f"case when {text} rlike r'{_USUAL}' then try_cast({text} as timestamp)"
        f" else get(transform(array({parts}), p -> {moment}), 0) end"
    )


def is_iso_timestamp(text: str) -> str:
    """SQL condition: the text is an ISO date or date-time."""
    return f"({iso_timestamp(text)} is not null)"
