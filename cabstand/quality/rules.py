"""Rules as data, and the loader for declared suites."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Rule:
    """One declared rule. ``params`` depend on the kind; ``mostly`` is the share that has to pass."""

    kind: str
    column: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    mostly: float = 1.0

    @property
    def rule_id(self) -> str:
        target = self.column or "-".join(str(self.params[k]) for k in ("a", "b") if k in self.params)
        return f"{self.kind}:{target}" if target else self.kind


@dataclass(frozen=True)
class Suite:
    """A named list of rules with the failing-row counts that make a warning or an error."""

    name: str
    rules: tuple[Rule, ...]
    warn_above: int = 1000
    error_above: int = 10000


# Declaration names, the rule kind each stands for, and its argument names.
DECLARATIONS = {
    "expect_table_columns_to_match_ordered_list": ("columns_ordered", {"column_list": "columns"}),
    "expect_table_columns_to_match_set": ("columns_set", {"column_list": "columns"}),
    "expect_table_column_count_to_equal": ("column_count", {"value": "count"}),
    "expect_column_to_exist": ("column_exists", {}),
    "expect_column_values_to_be_of_type": ("column_type", {"column_type": "type"}),
    "expect_column_values_to_be_in_type_list": ("type_list", {"type_list": "types"}),
    "expect_column_values_to_not_be_null": ("not_null", {}),
    "not_null": ("not_null", {}),
    "expect_column_values_to_be_in_set": ("in_set", {"value_set": "values"}),
    "accepted_values": ("in_set", {"values": "values"}),
    "expect_column_values_to_be_between": (
        "between",
        {"min_value": "low", "max_value": "high", "strictly": "strict"},
    ),
    "expect_column_max_to_be_between": (
        "max_between",
        {"min_value": "low", "max_value": "high", "strictly": "strict"},
    ),
    "expect_column_values_to_be_within_n_stdevs": ("within_stdevs", {"sigma_threshold": "sigmas"}),
    "expect_column_proportion_of_unique_values_to_be_between": (
        "unique_share",
        {"min_value": "low", "max_value": "high", "strictly": "strict"},
    ),
    "expect_column_pair_values_A_to_be_greater_than_B": (
        "pair_greater",
        {"column_A": "a", "column_B": "b", "or_equal": "or_equal"},
    ),
    "expect_grouped_row_values_to_have_recent_data": (
        "recent",
        {"group_by": "keys", "timestamp_column": "column", "datepart": "unit", "interval": "interval"},
    ),
    "unique": ("unique", {}),
}


def rule_from_declaration(name: str, arguments: Mapping[str, Any] | None = None, column: str | None = None) -> Rule:
    """A rule from its declared name and arguments; a dotted prefix of the name is ignored."""
    arguments = dict(arguments or {})
    try:
        kind, renames = DECLARATIONS[name.rsplit(".", 1)[-1]]
    except KeyError:
        raise ValueError(f"unknown rule {name!r}") from None
    mostly = float(arguments.pop("mostly", 1.0))
    column = arguments.pop("column", column)
    ignored = {"quote_values", "row_condition", "group_by"} - set(renames)
    params = {renames[key]: value for key, value in arguments.items() if key in renames}
    unknown = set(arguments) - set(renames) - ignored
    if unknown:
        raise ValueError(f"unknown arguments of {name}: {sorted(unknown)}")
    if "column" in params:
        column = params.pop("column")
    if kind == "within_stdevs":
        params.setdefault("sigmas", 3)
    return Rule(kind, column, params, mostly)


def suite_from_json(text: str, **limits: int) -> Suite:
    """A suite from its JSON form: a name and a list of rule types with keyword arguments."""
    body = json.loads(text)
    rules = tuple(rule_from_declaration(e["expectation_type"], e.get("kwargs")) for e in body["expectations"])
    return Suite(body["expectation_suite_name"], rules, **limits)
