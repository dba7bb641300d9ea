"""Strict JSON reading shared by the operators on raw lines."""

from __future__ import annotations

import json


def _refuse(name: str):
    raise ValueError(name)


#: Accepts exactly one JSON value; NaN and infinities are no JSON. Of repeated keys the last counts.
_strict = json.JSONDecoder(parse_constant=_refuse).decode


def json_value(text: str | None):
    """``(True, value)`` if ``text`` is exactly one valid JSON value, else ``(False, None)``."""
    if text is None:
        return False, None
    try:
        return True, _strict(text)
    except (ValueError, RecursionError):
        return False, None


def json_object(text: str | None) -> dict | None:
    """The object of a line, or None for a null, blank, unreadable or other line."""
    ok, value = json_value(text)
    return value if ok and type(value) is dict else None
