"""Data-quality rules as aggregate columns.

A rule type turns its dict into four aggregates: rows looked at, rows in violation, the observed
number and the verdict. As all of them are plain aggregates, any number of rules is one ``agg`` or
one observation on a write.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.errors import RuleError


@dataclass(frozen=True)
class Measures:
    """Aggregates of one rule; ``keep`` is its row test, where the rule has one."""

    rows: Column
    violations: Column
    observed: Column
    passed: Column
    limit: str
    keep: Column | None = None


class Unmeasurable(Exception):
    """The rule cannot be measured on this schema, so it counts as failed."""


RuleType = Callable[[dict, T.StructType], Measures]
_TYPES: dict[str, RuleType] = {}


def rule_type(name: str) -> Callable[[RuleType], RuleType]:
    """Registers a rule type; a later registration under the same name replaces it."""

    def add(build: RuleType) -> RuleType:
        _TYPES[name] = build
        return build

    return add


def register_rule(name: str, build: RuleType) -> None:
    rule_type(name)(build)


def rule_types() -> list[str]:
    return list(_TYPES)


def check_rules(rules: list[dict]) -> None:
    """Reports unknown types and missing keys before any job runs."""
    for rule in rules:
        if rule.get("type") == "custom":
            if not callable(rule.get("check")):
                raise RuleError(f"rule {rule.get('name')!r}: a custom rule needs a callable 'check'")
        elif rule.get("type") not in _TYPES:
            known = ", ".join([*_TYPES, "custom"])
            raise RuleError(f"rule {rule.get('name')!r}: unknown type {rule.get('type')!r}, use one of {known}")
        if not rule.get("name"):
            raise RuleError(f"a rule of type {rule['type']!r} has no name")
        for key in REQUIRED.get(rule["type"], ()):
            if rule.get(key) is None:
                raise RuleError(f"rule {rule['name']!r} lacks {key!r}")


def measures_of(rule: dict, schema: T.StructType) -> Measures:
    return _TYPES[rule["type"]](rule, schema)


# Keys without which a rule of a type makes no sense.
REQUIRED = {
    "null_check": ("column",),
    "range_check": ("column",),
    "allowed_values": ("column", "values"),
    "not_after": ("column", "as_of"),
    "positive_id": ("column",),
    "formula": ("column", "expression"),
}


def _column(rule: dict, schema: T.StructType) -> Column:
    name = rule["column"]
    if name not in schema.fieldNames():
        raise Unmeasurable(f"no column {name!r}")
    return F.col(f"`{name}`")


def _comparable(rule: dict, schema: T.StructType, bounds: list) -> tuple[Column, Column]:
    """The column in the type of its bounds, and a test for text that has no such value.

    Text that is no number would end the whole job, while it has to fail this rule alone.
    """
    column = _column(rule, schema)
    numbers = [bound for bound in bounds if isinstance(bound, (int, float))]
    if not numbers or not isinstance(schema[rule["column"]].dataType, T.StringType):
        return column, F.lit(False)
    whole = all(isinstance(bound, int) for bound in numbers)
    number = column.try_cast("bigint" if whole else "double")
    return number, column.isNotNull() & number.isNull()


def _rows() -> Column:
    return F.count(F.lit(1))


def _bounded(violated: Column, rows: Column, limit: str, keep: Column | None) -> Measures:
    """A rule that allows no violation at all."""
    count = F.count_if(violated)
    return Measures(rows, count, count.cast("double"), count == 0, limit, keep)


@rule_type("null_check")
def null_check(rule: dict, schema: T.StructType) -> Measures:
    """Share of nulls in percent, at most ``threshold``; an empty table passes."""
    column = _column(rule, schema)
    threshold = float(rule.get("threshold", 0.0))
    nulls, rows = F.count_if(column.isNull()), _rows()
    share = F.when(rows > 0, nulls / rows * 100).otherwise(F.lit(0.0))
    passed = F.when(rows > 0, share <= threshold).otherwise(F.lit(True))
    return Measures(rows, nulls, share, passed, f"at most {threshold}% null", column.isNotNull())


@rule_type("range_check")
def range_check(rule: dict, schema: T.StructType) -> Measures:
    """No value below ``min_value`` or above ``max_value``; nulls are not looked at."""
    low, high = rule.get("min_value"), rule.get("max_value")
    column, outside = _comparable(rule, schema, [low, high])
    inside = []
    if low is not None:
        outside, inside = outside | (column < low), [*inside, column >= low]
    if high is not None:
        outside, inside = outside | (column > high), [*inside, column <= high]
    keep = None
    if inside:
        keep = inside[0] if len(inside) == 1 else inside[0] & inside[1]
    rows = F.count(F.col(f"`{rule['column']}`"))
    return _bounded(outside, rows, f"between {low} and {high}", keep)


@rule_type("row_count")
def row_count(rule: dict, schema: T.StructType) -> Measures:
    """Number of rows from ``min_count`` to ``max_count``, both included and both optional."""
    low, high = rule.get("min_count"), rule.get("max_count")
    rows = _rows()
    passed = F.lit(True)
    if low is not None:
        passed = passed & (rows >= low)
    if high is not None:
        passed = passed & (rows <= high)
    violations = F.when(passed, F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    return Measures(rows, violations, rows.cast("double"), passed, f"from {low} to {high} rows")


@rule_type("allowed_values")
def allowed_values(rule: dict, schema: T.StructType) -> Measures:
    """Every value that is not null is one of ``values``."""
    column = _column(rule, schema)
    known = column.isin(list(rule["values"]))
    return _bounded(~known, F.count(column), f"one of {list(rule['values'])}", known)


@rule_type("not_after")
def not_after(rule: dict, schema: T.StructType) -> Measures:
    """No date later than ``as_of``, which is a parameter so that a rerun gives the same verdict."""
    column = _column(rule, schema)
    as_of = F.lit(rule["as_of"]).cast("date")
    return _bounded(column > as_of, F.count(column), f"not after {rule['as_of']}", column <= as_of)


@rule_type("positive_id")
def positive_id(rule: dict, schema: T.StructType) -> Measures:
    """Every id is present and above zero."""
    column, unreadable = _comparable(rule, schema, [0])
    good = column.isNotNull() & (column > 0)
    return _bounded(unreadable | column.isNull() | (column <= 0), _rows(), "present and above 0", good)


@rule_type("formula")
def formula(rule: dict, schema: T.StructType) -> Measures:
    """The stored value equals a SQL expression over the other columns."""
    column, wanted = _column(rule, schema), F.expr(rule["expression"])
    return _bounded(column != wanted, F.count(column), f"equal to {rule['expression']}", column == wanted)
