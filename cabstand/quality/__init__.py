"""Declared data-quality rules, compiled into as few passes over the data as they need."""

from cabstand.quality.rules import Rule, Suite, rule_from_declaration, suite_from_json
from cabstand.quality.run import ValidationFailed, evaluate, failing_rows, gate, parse_percent, verdict

__all__ = [
    "Rule",
    "Suite",
    "ValidationFailed",
    "evaluate",
    "failing_rows",
    "gate",
    "parse_percent",
    "rule_from_declaration",
    "suite_from_json",
    "verdict",
]
