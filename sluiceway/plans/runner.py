"""Runs a spec: read, chain the steps, check the rules, write."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field
from threading import Thread
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession

from sluiceway.errors import SpecError
from sluiceway.plans.steps import chain, prepare
from sluiceway.quality.rules import check_rules
from sluiceway.quality.suite import Report
from sluiceway.sinks.writer import check_target, write_checked
from sluiceway.sources.readers import counted, read_sources

log = logging.getLogger(__name__)

#: Seconds to wait for the counts of a job that has ended; they come with its last event.
PATIENCE = 30


@dataclass
class RunResult:
    """Outcome of a run; an error ends as ``status = "failed"`` and its text."""

    status: str
    name: str
    metrics: dict[str, Any] = field(default_factory=dict)
    validation_passed: bool = False
    error: str | None = None
    report: Report | None = None


def check_spec(spec: dict) -> str:
    """Reports everything that can be wrong before a job runs; returns the name of the spec."""
    name = (spec.get("pipeline") or {}).get("name")
    if not name:
        raise SpecError("the spec has no pipeline name")
    if not spec.get("sources"):
        raise SpecError(f"{name}: at least one source is needed")
    if not spec.get("target"):
        raise SpecError(f"{name}: a target is needed")
    check_target(spec["target"])
    for step in spec.get("transformations") or []:
        prepare(step)
    validation = spec.get("validation") or {}
    if validation.get("enabled", True):
        check_rules(validation.get("rules") or [])
    return name


def build(spark: SparkSession, spec: dict, seen: dict[str, Observation] | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Result frame of a spec and all named frames, without running any job.

    The result is what the last step makes, or the first source if there are no steps. ``seen`` takes up a
    count for every source that the result reads.
    """
    frames = read_sources(spark, spec["sources"])
    if seen is not None:
        for name in read_by_result(spec):
            frames[name], seen[name] = counted(frames[name], f"{name}-{uuid.uuid4().hex}")
    steps = spec.get("transformations") or []
    if not steps:
        return frames[spec["sources"][0]["name"]], frames
    frames = chain(spark, frames, steps)
    return frames[steps[-1]["output"]], frames


def read_by_result(spec: dict) -> list[str]:
    """Sources that the last step needs, in their order."""
    steps = spec.get("transformations") or []
    needed = {steps[-1]["output"] if steps else spec["sources"][0]["name"]}
    for step in reversed(steps):
        if step["output"] in needed:
            # A step may read a table by the very name of its result.
            needed.discard(step["output"])
            needed.update(step["inputs"])
    return [source["name"] for source in spec["sources"] if source["name"] in needed]


def _rows(seen: Observation) -> int | None:
    """What an observation has counted; None where the optimizer left its source out of the job."""
    found: list[int | None] = []
    waiting = Thread(target=lambda: found.append(seen.get.get("rows")), daemon=True)
    waiting.start()
    waiting.join(PATIENCE)
    return found[0] if found else None


def run(spark: SparkSession, spec: dict) -> RunResult:
    """Runs a spec to its end; the session is left as it is.

    With ``"count_sources": True`` the metrics have ``source_rows``, the rows that were read of every source
    the result needs. They are counted by the job that writes; filters are then not pushed into the scans,
    which is why they are counted only if asked for.
    """
    name = "unknown"
    seen: dict[str, Observation] = {}
    try:
        name = check_spec(spec)
        counting = bool(spec.get("count_sources"))
        result, _ = build(spark, spec, seen if counting else None)
        written, report = write_checked(result, spec["target"], spec.get("validation"))
    except Exception as error:
        log.error("%s failed: %s", name, error)
        return RunResult("failed", name, error=str(error))
    if not report.all_passed():
        log.warning("%s was written although rules failed: %s", name, ", ".join(report.failed))
    metrics = {
        "rows_written": written.rows_written,
        "validation_rules_executed": len(report.executed),
        "validation_rules_passed": len(report.passed),
    }
    if counting:
        metrics["source_rows"] = {source: _rows(observation) for source, observation in seen.items()}
    return RunResult("success", name, metrics, report.all_passed(), report=report)


def run_many(spark: SparkSession, specs: list[dict]) -> tuple[list[RunResult], dict[str, int]]:
    """Runs specs one after the other, each whatever became of the others, and counts the outcomes."""
    results = [run(spark, spec) for spec in specs]
    succeeded = sum(result.status == "success" for result in results)
    return results, {"total": len(results), "succeeded": succeeded, "failed": len(results) - succeeded}
