"""Strict JSON parsing of single lines, as SQL expressions.

A line is parsed into one VARIANT. What that cannot take, because of a string or number of its own length limit, is
parsed member by member with the limits raised, so that no length decides whether a line is valid.
"""

from __future__ import annotations

END_MARK = "~end-of-line~"
#: Column of a parsed struct that is set where a member could not be taken over.
UNREAD = "_unread"
_ANY_LENGTH = (
    "map('maxStringLen', '2147483647', 'maxNumLen', '2147483647', 'allowSingleQuotes', 'false',"
    f" 'allowNonNumericNumbers', 'false', 'columnNameOfCorruptRecord', '{UNREAD}')"
)
_BARE_NUMBER = r"([\[:,]\s*+)(?:NaN|-?Infinity)(?=\s*+[,\]}])"


def _lenient(text: str) -> str:
    """Parse JSON text; bare NaN and infinities become an infinite double."""
    return (
        f"coalesce(try_parse_json({text}), case when {text} rlike 'NaN|Infinity'"
        f" then try_parse_json(regexp_replace({text}, r'{_BARE_NUMBER}', '$1-1e999')) end)"
    )


def wrapped_line(line: str) -> str:
    """The line parsed as the first element of an array that ends in a mark.

    ``try_parse_json`` stops at the end of the first value and ignores what follows.
    The mark shows that it got to the end of the line. A line that holds the mark
    itself is parsed without it, and :func:`line_value` checks it in another way.
    """
    text = (
        f"case when contains({line}, '{END_MARK}') then concat('[', {line}, ']')"
        f" else concat('[', {line}, ',\"{END_MARK}\"]') end"
    )
    return f"case when is_valid_utf8({line}) then {_lenient(text)} end"


def line_value(line: str, wrapped: str) -> str:
    """The line's JSON value, or NULL unless the line is exactly one JSON value."""
    as_member = "concat('{\"r\":', " + line + ", '}')"
    complete = (
        f"case when contains({line}, '{END_MARK}') then {_lenient(as_member)} is not null"
        f" else try_variant_get({wrapped}, '$[1]', 'string') <=> '{END_MARK}'"
        f" and try_variant_get({wrapped}, '$[2]', 'variant') is null end"
    )
    return f"case when {complete} then try_variant_get({wrapped}, '$[0]', 'variant') end"


def single_value(text: str) -> str:
    """The text where it is exactly one JSON value, of any length; bare NaN and infinities as infinite doubles."""

    def is_one(candidate: str) -> str:
        values = f"from_json(concat('[', {candidate}, ',\"{END_MARK}\"]'), 'array<string>', {_ANY_LENGTH})"
        marked = f"get(transform(array({values}), v -> size(v) = 2 and v[1] <=> '{END_MARK}'), 0)"
        # What closes the array early and opens another one is no member of an object.
        return f"({marked} and from_json(concat('{{\"r\":', {candidate}, '}}'), 'map<string,string>', {_ANY_LENGTH}) is not null)"

    finite = f"regexp_replace({text}, r'{_BARE_NUMBER}', '$1-1e999')"
    return (
        f"case when not is_valid_utf8({text}) then null when {is_one(text)} then {text}"
        f" when {text} rlike 'NaN|Infinity' and {is_one(finite)} then {finite} end"
    )


def object_members(single: str, kinds: str) -> str:
    """Members of a JSON object as a struct, each parsed on its own; NULL for NULL and for any other JSON value.

    ``single`` is text as :func:`single_value` gives it, ``kinds`` lists ``name type``. A member of another type than
    declared is NULL; ``UNREAD`` is set where a member was left out, also for its size.
    """
    return (
        f"case when {single} rlike r'^\\s*+\\{{' then"
        f" from_json({single}, 'struct<{kinds},{UNREAD} string>', {_ANY_LENGTH}) end"
    )


def member(value: str, name: str) -> str:
    """``"name":value`` as JSON text, for building lines from columns."""
    text = f"to_json(named_struct('{name}', {value}), map('ignoreNullFields', 'false'))"
    return f"substring({text}, 2, length({text}) - 2)"
