"""Declarative batch and streaming analytics on PySpark.

A plain dict names sources, steps, data-quality rules and one target. The library composes the
steps into one lazy Spark plan, measures every rule in the same pass that writes the staged
result, and publishes it only when the rules pass.
"""

from sluiceway.plans.runner import RunResult, run, run_many
from sluiceway.plans.steps import register_step, step_types
from sluiceway.quality.suite import Report, evaluate, report_frame
from sluiceway.sinks.writer import WriteResult, write

__all__ = [
    "Report",
    "RunResult",
    "WriteResult",
    "evaluate",
    "register_step",
    "report_frame",
    "run",
    "run_many",
    "step_types",
    "write",
]
