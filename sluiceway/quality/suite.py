"""Runs a suite of rules in one pass and reports the outcome."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.quality.rules import Unmeasurable, check_rules, measures_of


@dataclass
class Report:
    """Outcome of a suite."""

    executed: list[str] = field(default_factory=list)
    passed: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    details: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, Any] = field(default_factory=dict)

    def all_passed(self) -> bool:
        return not self.failed

    def add(self, name: str, passed: bool, message: str) -> None:
        self.executed.append(name)
        self.metrics[name] = {"passed": passed, "message": message}
        if passed:
            self.passed.append(name)
        else:
            self.failed.append(name)
            self.details[name] = message


class Suite:
    """Rules bound to a frame.

    ``columns`` are the aggregates of all rules; ``report`` reads their values back. A rule that
    does not fit the schema fails alone and leaves the others untouched.
    """

    def __init__(self, validation: dict | list | None, df: DataFrame):
        if isinstance(validation, dict):
            rules = validation.get("rules") or [] if validation.get("enabled", True) else []
        else:
            rules = validation or []
        check_rules(rules)
        self.rules = rules
        self.measured, self.broken = {}, {}
        schema = df.schema
        for place, rule in enumerate(rules):
            if rule["type"] == "custom":
                continue
            try:
                self.measured[place] = measures_of(rule, schema)
            except Unmeasurable as error:
                self.broken[place] = str(error)
        if self.measured and self._misfit(df, self.columns()):
            for place in list(self.measured):
                error = self._misfit(df, self.columns_of(place))
                if error:
                    del self.measured[place]
                    self.broken[place] = error

    @staticmethod
    def _misfit(df: DataFrame, columns: list[Column]) -> str | None:
        """Why the columns do not fit the frame; this only analyzes a plan and runs no job."""
        try:
            df.agg(*columns)
        except AnalysisException as error:
            return str(error)
        return None

    def columns_of(self, place: int) -> list[Column]:
        m = self.measured[place]
        return [
            m.rows.alias(f"rule{place}_rows"),
            m.violations.alias(f"rule{place}_violations"),
            m.observed.alias(f"rule{place}_observed"),
            m.passed.alias(f"rule{place}_passed"),
        ]

    def columns(self) -> list[Column]:
        return [column for place in self.measured for column in self.columns_of(place)]

    def measure(self, df: DataFrame) -> dict:
        """Values of all aggregates from one job.

        Should that job fail on the data of some rule, each rule gets a job of its own and only
        those that fail again are broken.
        """
        if not self.measured:
            return {}
        try:
            return df.agg(*self.columns()).first().asDict()
        except PySparkException:
            values = {}
            for place in list(self.measured):
                try:
                    values.update(df.agg(*self.columns_of(place)).first().asDict())
                except PySparkException as error:
                    del self.measured[place]
                    self.broken[place] = str(error)
            return values

    def report(self, values: dict, df: DataFrame) -> Report:
        """Report from the values of ``columns``; custom rules look at ``df`` themselves."""
        report = Report()
        for place, rule in enumerate(self.rules):
            if place in self.broken:
                report.add(rule["name"], False, self.broken[place])
            elif rule["type"] == "custom":
                try:
                    passed, message = rule["check"](df)
                    report.add(rule["name"], bool(passed), str(message))
                except Exception as error:
                    report.add(rule["name"], False, f"check raised {error}")
            else:
                message = (
                    f"{rule.get('column', 'table')}: {values[f'rule{place}_violations']} violations in "
                    f"{values[f'rule{place}_rows']} rows, observed {values[f'rule{place}_observed']:g}, "
                    f"wanted {self.measured[place].limit}"
                )
                report.add(rule["name"], values[f"rule{place}_passed"], message)
        return report


def evaluate(df: DataFrame, validation: dict | list | None) -> Report:
    """Runs all rules with one aggregation job; without rules, or disabled, no job runs."""
    suite = Suite(validation, df)
    return suite.report(suite.measure(df), df)


def report_frame(df: DataFrame, validation: dict | list) -> DataFrame:
    """The report as a lazy frame, one row per rule other than custom ones."""
    suite = Suite(validation, df)
    names = ("rows", "violations", "observed", "passed")
    rows = []
    for place, rule in enumerate(suite.rules):
        if place in suite.measured:
            numbers = [F.col(f"rule{place}_{part}") for part in names]
        elif place in suite.broken:
            unknown = F.lit(None).cast("bigint")
            numbers = [unknown, unknown, F.lit(None).cast("double"), F.lit(False)]
        else:
            continue
        labels = [F.lit(rule["name"]).alias("rule"), F.lit(rule["type"]).alias("type")]
        rows.append(F.struct(*labels, *[n.alias(name) for n, name in zip(numbers, names)]))
    columns = suite.columns() or [F.count(F.lit(1)).alias("rows")]
    return df.agg(*columns).select(F.inline(F.array(*rows)))
