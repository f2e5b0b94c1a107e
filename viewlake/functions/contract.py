"""The event contract: which fields a record has and of which type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- fixed values: contract version, field names and types -------------------
CONTRACT_VERSION = "2026-03-v1"

REQUIRED_TYPES = """
event_key       string
received_at     timestamp
visitor_key     string
media_id        string
media_name      string
media_url       string
percent_viewed  number
ip              string
country         string
"""

OPTIONAL_TYPES = """
embed_url                           string
org                                 string
region                              string
city                                string
lat                                 number
lon                                 number
email                               string
iframe_heatmap_url                  string
thumbnail.url                       string
thumbnail.width                     integer
thumbnail.height                    integer
thumbnail.fileSize                  integer
thumbnail.contentType               string
thumbnail.type                      string
conversion_type                     integer|string
conversion_data.email               string
conversion_data.first_name          string
conversion_data.is_new_lead         boolean
conversion_data.last_name           string
user_agent_details.browser          string
user_agent_details.browser_version  string
user_agent_details.platform         string
user_agent_details.mobile           boolean
"""

MALFORMED = "malformed_json"
NOT_AN_OBJECT = "invalid_record_type"
MISSING = "missing_required_field"
NULL = "null_required_field"
WRONG_TYPE = "invalid_type"
OUT_OF_RANGE = "out_of_range"
# ---- end of fixed values -------------------------------------------------------

CODES = (MALFORMED, NOT_AN_OBJECT, MISSING, NULL, WRONG_TYPE, OUT_OF_RANGE)


@dataclass(frozen=True)
class Field:
    """One declared field; ``parent`` is set for the children of an object."""

    path: str
    kinds: tuple[str, ...]
    required: bool

    @property
    def parent(self) -> str | None:
        return self.path.rpartition(".")[0] or None

    @property
    def name(self) -> str:
        return self.path.rpartition(".")[2]


def _fields(table: str, required: bool) -> tuple[Field, ...]:
    rows = (line.split() for line in table.strip().splitlines())
    return tuple(Field(path, tuple(kinds.split("|")), required) for path, kinds in rows)


REQUIRED = _fields(REQUIRED_TYPES, True)
OPTIONAL = _fields(OPTIONAL_TYPES, False)
FIELDS = REQUIRED + OPTIONAL
OBJECTS = tuple(dict.fromkeys(f.parent for f in FIELDS if f.parent))


def known_names(parent: str | None) -> list[str]:
    """Declared names at the top level, or inside one declared object."""
    names = [f.name for f in FIELDS if f.parent == parent]
    return names if parent else names + list(OBJECTS)


_SPARK_TYPES = {
    ("string",): T.StringType(),
    ("timestamp",): T.StringType(),
    ("number",): T.DoubleType(),
    ("integer",): T.LongType(),
    ("boolean",): T.BooleanType(),
}


def raw_schema() -> T.StructType:
    """Schema for reading validated lines, so that no inference pass is needed."""
    schema = T.StructType()
    for field in FIELDS:
        if not field.parent:
            schema.add(field.name, _SPARK_TYPES.get(field.kinds, T.VariantType()))
        elif field.parent not in schema.names:
            children = [f for f in FIELDS if f.parent == field.parent]
            schema.add(
                field.parent,
                T.StructType([T.StructField(c.name, _SPARK_TYPES[c.kinds]) for c in children]),
            )
    return schema
