"""Rule conditions as SQL predicates. Each is true or false, never NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The hours of a time_range condition that names none.
DEFAULT_START_HOUR = 0
DEFAULT_END_HOUR = 6

EQUALITY_FIELDS = ("source", "action", "status", "user")


def quoted(value: str) -> str:
    """``value`` as a SQL string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def cond_equality(field: str, value: str) -> str:
    """Exact, case-sensitive match of ``source``, ``action``, ``status`` or ``user``."""
    return f"coalesce(`{field}` = {quoted(value)}, false)"


def cond_direction(value: str) -> str:
    return cond_equality("direction", value)


def cond_path_match(prefixes: Sequence[str]) -> str:
    """The path starts with one of the prefixes; an empty path or list never matches."""
    if not prefixes:
        return "false"
    hits = " OR ".join(f"startswith(path, {quoted(p)})" for p in prefixes)
    return f"coalesce(path <> '' AND ({hits}), false)"


def cond_time_range(start: int | None = None, end: int | None = None) -> str:
    """Hour of the event in ``[start, end)``, around midnight when start > end."""
    start = DEFAULT_START_HOUR if start is None else int(start)
    end = DEFAULT_END_HOUR if end is None else int(end)
    joined = "AND" if start <= end else "OR"
    return f"(hour(ts) >= {start} {joined} hour(ts) < {end})"


def rule_condition(conditions: dict) -> str:
    """All conditions a rule sets on a single event; unknown keys are ignored."""
    tests = [cond_equality(k, conditions[k]) for k in EQUALITY_FIELDS if k in conditions]
    if "direction" in conditions:
        tests.append(cond_direction(conditions["direction"]))
    if "path_match" in conditions:
        tests.append(cond_path_match(conditions["path_match"]))
    if "time_range" in conditions:
        hours = conditions["time_range"]
        tests.append(cond_time_range(hours.get("start_hour"), hours.get("end_hour")))
    return " AND ".join(tests) or "true"


def equals_if_set(field: str, value: str | None) -> Column:
    """Optional equality filter: an empty or missing value does not restrict."""
    return F.col(field) == value if value else F.lit(True)
