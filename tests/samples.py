"""Sample wire events, built from the declared contract."""

import json

from viewlake.functions import contract as C

_VALUES = {"timestamp": "2026-06-05T07:15:30.250Z", "number": 0.5}


def event(**changes):
    """A valid event with every required field; a change to ``...`` leaves the field out."""
    fields = {f.name: _VALUES.get(f.kinds[0], f"some {f.name}") for f in C.REQUIRED}
    fields["media_name"] += " on YouTube"
    fields.update(changes)
    return {name: value for name, value in fields.items() if value is not ...}


def line(**changes):
    return json.dumps(event(**changes))
