"""Rules applied to single rows: bad rows are dropped or set aside instead of blocking a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.errors import RuleError
from sluiceway.quality.rules import Unmeasurable, check_rules, measures_of


def row_tests(rules: list[dict], schema: T.StructType) -> dict[str, Column]:
    """Row test of every rule that has one; thresholds do not apply to single rows.

    Only a test that is false counts against a row: a range says nothing about a null, which is
    the business of the null check.
    """
    check_rules(rules)
    tests = {}
    for rule in rules:
        if rule["type"] == "custom":
            continue
        try:
            keep = measures_of(rule, schema).keep
        except Unmeasurable as error:
            raise RuleError(f"rule {rule['name']!r}: {error}") from error
        if keep is not None:
            tests[rule["name"]] = F.coalesce(keep, F.lit(True))
    return tests


def keep_valid(df: DataFrame, rules: list[dict], observation: Observation | None = None) -> DataFrame:
    """Rows that meet every expectation; ``observation`` counts the violations of each rule.

    Works on streams too. Counting happens in the job that uses the result.
    """
    tests = row_tests(rules, df.schema)
    if observation is not None and tests:
        df = df.observe(observation, *[F.count_if(~test).alias(name) for name, test in tests.items()])
    for test in tests.values():
        df = df.where(test)
    return df


def set_aside(df: DataFrame, rules: list[dict], output: str = "failed_rules") -> DataFrame:
    """Rows that violate an expectation, with the names of the rules they violate."""
    tests = row_tests(rules, df.schema)
    names = [F.when(~test, F.lit(name)) for name, test in tests.items()]
    failed = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return df.withColumn(output, failed).where(F.size(output) > 0)
