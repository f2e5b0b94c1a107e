"""The contract compiled to SQL expressions: issues and unknown fields of one record.

The expressions are built as SQL text: a few dozen rules make thousands of nodes, and a
Python call into the JVM for each of them would cost seconds per query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from viewlake.functions import contract as C
from viewlake.functions.iso_time import is_iso_timestamp
from viewlake.functions.json_text import UNREAD, line_value, object_members, single_value, wrapped_line

NO_ISSUES = "cast(array() as array<struct<code:string,field:string,message:string>>)"
NO_NAMES = "cast(array() as array<string>)"
RECEIVED_TEXT = "try_variant_get(top.received_at, '$', 'string')"

#: Columns that tell where a line stands, in the message that stops a run.
ADDRESS = ("source_uri", "block_start", "block_row", "event_id")


#: Longest line, in bytes, that the pattern of usual records is tried on.
USUAL_BYTES = 1 << 20
#: A usual record, or an object in it, has no more members than this.
_MEMBERS = 64


def _issue(code: str, field: str, message: str) -> str:
    return f"named_struct('code', '{code}', 'field', '{field}', 'message', '{message}')"


def _tag(path: str) -> str:
    """Column with the type name of a member: NULL if absent, VOID for a JSON null."""
    return "tag_" + path.replace(".", "_")


def _has_kind(tag: str, kind: str) -> str:
    if kind == "string":
        return f"{tag} = 'STRING'"
    if kind == "boolean":
        return f"{tag} = 'BOOLEAN'"
    if kind == "number":
        return f"({tag} in ('BIGINT', 'DOUBLE', 'FLOAT') or startswith({tag}, 'DECIMAL'))"
    if kind == "integer":
        # Integers beyond a long arrive as DECIMAL(19..38, 0); "1.0" as DECIMAL(1,0).
        return rf"({tag} = 'BIGINT' or {tag} rlike r'^DECIMAL\((19|2\d|3\d),0\)$')"
    if kind == "timestamp":
        return f"({tag} = 'STRING' and is_received_time)"
    raise ValueError(f"unknown kind {kind!r}")


def _fits(field: C.Field) -> str:
    return "(" + " or ".join(_has_kind(_tag(field.path), kind) for kind in field.kinds) + ")"


def _is_no_object(name: str) -> str:
    return f"(top.{name} is not null and not is_variant_null(top.{name}) and in_{name} is null)"


_OUT_OF_RANGE = (
    f"({_has_kind(_tag('percent_viewed'), 'number')}"
    " and not try_variant_get(top.percent_viewed, '$', 'double') between 0.0D and 1.0D)"
)


_BAD_SHARE = _issue(C.OUT_OF_RANGE, "percent_viewed", "Expected a number between 0.0 and 1.0.")


def _is_clean() -> str:
    """True when no rule fires. Nearly every record takes this cheap way out."""
    parts = ["top is not null"]
    parts += [f"coalesce({_fits(f)}, false)" for f in C.REQUIRED]
    parts += [f"coalesce({_tag(f.path)} = 'VOID' or {_fits(f)}, true)" for f in C.OPTIONAL]
    parts += [f"not {_is_no_object(name)}" for name in C.OBJECTS]
    parts.append(f"not coalesce({_OUT_OF_RANGE}, false)")
    return " and ".join(parts)


def _field_issue(field: C.Field) -> str:
    tag, path = _tag(field.path), field.path
    wrong = _issue(C.WRONG_TYPE, path, f"Expected {' or '.join(field.kinds)}.")
    if field.required:
        missing = _issue(C.MISSING, path, "Required field is missing.")
        null = _issue(C.NULL, path, "Required field cannot be null.")
        return (
            f"case when {tag} is null then {missing} when {tag} = 'VOID' then {null}"
            f" when not {_fits(field)} then {wrong} end"
        )
    # Below a value that is no object every tag is NULL, so nothing fires.
    return f"case when {tag} <> 'VOID' and not {_fits(field)} then {wrong} end"


def _record_issues() -> str:
    """All issues in contract order, the range rule last."""
    found = [_field_issue(f) for f in C.REQUIRED]
    for position, field in enumerate(C.OPTIONAL):
        parent = field.parent
        if parent and parent != C.OPTIONAL[position - 1].parent:
            bad = _issue(C.WRONG_TYPE, parent, "Expected object.")
            found.append(f"case when {_is_no_object(parent)} then {bad} end")
        found.append(_field_issue(field))
    found.append(f"case when {_OUT_OF_RANGE} then {_BAD_SHARE} end")
    return f"array_compact(array({', '.join(found)}))"


def _unknown_names(value: str, parent: str | None) -> str:
    known = ", ".join(f"'{name}'" for name in C.known_names(parent))
    names = f"map_keys(try_variant_get({value}, '$', 'map<string,variant>'))"
    extra = f"array_except({names}, array({known}))"
    if parent:
        extra = f"transform({extra}, name -> concat('{parent}.', name))"
    return f"coalesce({extra}, {NO_NAMES})"


def _names_in_text() -> str:
    known = ", ".join(f"'{name}'" for name in C.known_names(None))
    return f"coalesce(filter(array_distinct(json_object_keys(single)), name -> name not in ({known})), {NO_NAMES})"


def _members(value: str, parent: str | None) -> str:
    """The declared members as one struct of VARIANT; NULL unless it is an object.

    One cast lays all members out; looking every path up on its own would walk and
    copy the record once per rule.
    """
    kinds = ",".join(f"{name}:variant" for name in C.known_names(parent))
    return f"try_variant_get({value}, '$', 'struct<{kinds}>')"


def _type_tag(field: C.Field, line: str) -> str:
    holder = f"in_{field.parent}" if field.parent else "top"
    kind = f"schema_of_variant({holder}.{field.name})"
    if "integer" in field.kinds:
        # An integer of more digits than a decimal holds has become a double; its text tells.
        digits = f"get_json_object({line}, '$.{field.path}') rlike '^-?[0-9]+$'"
        # null-safe, or the text of every record without the field would be searched too
        kind = f"case when {kind} <=> 'DOUBLE' and {digits} then 'BIGINT' else {kind} end"
    return f"{kind} as {_tag(field.path)}"


_CONTROLS = "".join(rf"\x{code:02x}" for code in range(32))  # one by one they are a table of the matcher, a range is not
_TEXT = rf'"[^"\\{_CONTROLS}]*"'
_INTEGER = r"-?(?:0|[1-9]\d{0,17}+)"
_NUMBER = _INTEGER + r"(?:\.\d{1,25}+)?+(?:[eE][+-]?\d{1,2}+)?+"
_DAY = r"(?:(?:0[1-9]|1[0-2])-(?:0[1-9]|1\d|2[0-8])|(?:0[13-9]|1[0-2])-(?:29|30)|(?:0[13578]|1[02])-31)"
_USUAL_VALUES = {
    "string": _TEXT,
    "timestamp": rf'"(?!0000)\d{{4}}-{_DAY}T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{{1,6}})?Z"',
    "number": _NUMBER,
    "integer": _INTEGER,
    "boolean": "(?:true|false)",
}


def _usual_member(field: C.Field) -> str:
    """Pattern of a member; a required one leaves an empty group behind, and the share a group of its text."""
    value = "|".join([_USUAL_VALUES[kind] for kind in field.kinds] + ["null"] * (not field.required))
    group = "(" if field.path == "percent_viewed" else "(?:"
    return f'{field.name}"{"()" * field.required}: *+{group}{value})'


def _usual_object(members: list[str]) -> str:
    """Pattern of a JSON object of these members, in any order."""
    return rf'\{{(?:"(?:{"|".join(members)})(?:, *+(?=")|(?=\}}))){{1,{_MEMBERS}}}+\}}'


def usual_share(line: str) -> str:
    """SQL expression: the text of ``percent_viewed`` in a usual record, an empty text for any other line.

    A usual record has all required and else only declared members, and their spelling shows that they have their types.
    It has no issue but perhaps a share out of range, and no unknown field, and needs no parsing. Escapes in texts, other
    spellings of times and numbers and whatever else the pattern does not know say nothing about a line. Of members of
    one name all have to be right, and the last share counts, as in the parser.
    """
    members = [_usual_member(f) for f in C.FIELDS if not f.parent]
    for parent in C.OBJECTS:
        inner = _usual_object([_usual_member(f) for f in C.FIELDS if f.parent == parent])
        members.append(f'{parent}": *+(?:null|{inner})')
    # groups count from the left: an empty one a required member, with the share's text behind its own
    names = [f.path for f in C.REQUIRED]
    share = names.index("percent_viewed") + 2
    groups = [k for k in range(1, len(names) + 2) if k != share]
    seen = "".join(rf"(?:\{k})" for k in groups)  # refers to a group, and fails unless the group took part
    shape = rf"\A{_usual_object(members)}[ \t\r]*+\z{seen}"
    return (
        f"case when octet_length({line}) <= {USUAL_BYTES} and is_valid_utf8({line})"
        f" then regexp_extract({line}, r'{shape}', {share}) else '' end"
    )


def check_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add ``is_valid``, ``issues`` and ``unknown_fields`` to every line.

    A line of any length is checked. One member beyond what a VARIANT can hold stops the run with the line's address.
    Each step is used more than once by the next, so Catalyst keeps the projections
    apart and a line is parsed only once. Usual records (see ``usual_share``) are not parsed at all: of them ``event`` and
    what follows from it is NULL.
    """
    keep = [f"`{name}`" for name in lines.columns]
    inner = [f"in_{name}" for name in C.OBJECTS]
    malformed = _issue(C.MALFORMED, "$", "Not a single JSON value.")
    no_object = _issue(C.NOT_AN_OBJECT, "$", "Expected a JSON object.")
    kinds = ",".join(f"{name} variant" for name in C.known_names(None))
    address = ", ".join(f"`{name}`" for name in ADDRESS if name in lines.columns)
    too_large = f"raise_error(concat_ws(' ', 'A line has a member too large to be read:'{address and ', ' + address}))"
    unknown = [f"case when event is null then {_names_in_text()} else {_unknown_names('event', None)} end"]
    unknown += [_unknown_names(f"top.{name}", name) for name in C.OBJECTS]
    unknown_fields = f"case when top is null then {NO_NAMES} else concat({', '.join(unknown)}) end"
    issues = (
        f"case when is_valid then {NO_ISSUES} when usual then array({_BAD_SHARE}) when event is null and single is null then array({malformed})"
        f" when top is null then array({no_object}) else {_record_issues()} end"
    )
    result = (
        f"named_struct('is_valid', is_valid, 'issues', {issues}, 'unknown_fields', unknown_fields)"
    )
    text = "doubtful"
    steps = [
        [f"{usual_share(f'`{column}`')} as share"],
        ["share", "share <> '' as usual"],
        ["usual", "share <> '' and try_cast(share as double) between 0.0D and 1.0D as in_range",
         f"case when not usual then `{column}` end as {text}"],
        ["usual", "in_range", text, f"{wrapped_line(text)} as wrapped"],
        ["usual", "in_range", text, f"{line_value(text, 'wrapped')} as event"],
        ["usual", "in_range", "event", f"case when event is null and not usual then {single_value(text)} end as single"],
        ["usual", "in_range", "event", "single", f"{object_members('single', kinds)} as apart"],
        ["usual", "in_range", "event", "single", f"case when apart.{UNREAD} is not null then {too_large} when apart is null"
         f" then {_members('event', None)} else struct({', '.join(f'apart.{n}' for n in C.known_names(None))}) end as top"],
        ["usual", "in_range", "event", "single", "top", *[f"{_members(f'top.{n}', n)} as in_{n}" for n in C.OBJECTS]],
        ["usual", "in_range", "event", "single", "top", *inner,
         f"not usual and coalesce({is_iso_timestamp(RECEIVED_TEXT)}, false) as is_received_time",
         *[_type_tag(f, f"`{column}`") for f in C.FIELDS]],
        ["*", f"in_range or {_is_clean()} as is_valid", f"{unknown_fields} as unknown_fields"],
        # Filters do not move below a generator. Without it, Catalyst would push one
        # through every projection above and write the parsing out once per use. The
        # generator is interpreted, so only broken records leave it real work.
        [f"inline_outer(array({result}))"],
    ]
    for step in steps:
        lines = lines.selectExpr(*([] if "*" in step else keep), *step)
    return lines
