"""vigilog: security-log analytics as Spark jobs."""

from vigilog.operators.detect import detect_events, rule_matches
from vigilog.operators.normalize import normalize_events, rejected_lines
from vigilog.sources.rules import Rule, load_rules, rules_from

__all__ = [
    "Rule",
    "detect_events",
    "load_rules",
    "normalize_events",
    "rejected_lines",
    "rule_matches",
    "rules_from",
]
