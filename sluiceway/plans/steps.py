"""Step types of a spec.

A step type is a function that checks a step's dict and returns what to do with the named frames.
Checking happens before any plan is built, so a wrong step is reported before any job runs.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Mapping
from contextlib import contextmanager
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from sluiceway.errors import SluicewayError, StepError
from sluiceway.operators.aggregates import FUNCTIONS
from sluiceway.operators.joins import join

Frames = Mapping[str, DataFrame]
Action = Callable[[SparkSession, Frames], DataFrame]
StepType = Callable[[dict], Action]

_TYPES: dict[str, StepType] = {}
_naming = RLock()


def step_type(name: str) -> Callable[[StepType], StepType]:
    """Registers a step type; a later registration under the same name replaces it."""

    def add(build: StepType) -> StepType:
        _TYPES[name] = build
        return build

    return add


def register_step(name: str, build: StepType) -> None:
    step_type(name)(build)


def step_types() -> list[str]:
    return list(_TYPES)


def clear_steps() -> None:
    _TYPES.clear()


def prepare(step: dict) -> Action:
    """Checks one step and returns its action."""
    kind = step.get("type")
    if kind not in _TYPES:
        raise StepError(f"step {step.get('name')!r}: unknown type {kind!r}, use one of {list(_TYPES)}")
    for key in ("name", "inputs", "output"):
        if not step.get(key):
            raise StepError(f"step {step.get('name')!r} lacks {key!r}")
    return _TYPES[kind](step)


def apply_step(spark: SparkSession, frames: Frames, step: dict) -> DataFrame:
    """The frame a single step makes of the named frames."""
    return prepare(step)(spark, frames)


def chain(spark: SparkSession, frames: Frames, steps: list[dict]) -> dict[str, DataFrame]:
    """All frames by name after the steps ran in order; nothing but the plan is built."""
    actions = [(step, prepare(step)) for step in steps]
    known = dict(frames)
    for step, action in actions:
        known[step["output"]] = action(spark, known)
    return known


def _inputs(step: dict, frames: Frames) -> list[DataFrame]:
    unknown = [name for name in step["inputs"] if name not in frames]
    if unknown:
        raise StepError(f"step {step['name']!r}: no frame named {', '.join(unknown)}")
    return [frames[name] for name in step["inputs"]]


def _need(step: dict, key: str):
    if not step.get(key):
        raise StepError(f"step {step['name']!r} lacks {key!r}")
    return step[key]


def _need_inputs(step: dict, count: int) -> None:
    if len(step["inputs"]) != count:
        raise StepError(f"step {step['name']!r} takes {count} inputs, got {len(step['inputs'])}")


@step_type("filter")
def filter_step(step: dict) -> Action:
    condition = _need(step, "condition")
    _need_inputs(step, 1)
    return lambda spark, frames: _inputs(step, frames)[0].where(condition)


@step_type("join")
def join_step(step: dict) -> Action:
    # YAML 1.1 reads an unquoted "on" as true, hence the other two spellings.
    on = step.get("on") or step.get("keys") or step.get(True)
    if not on:
        raise StepError(f"step {step['name']!r} lacks 'on'")
    _need_inputs(step, 2)
    how, split = step.get("how", "inner"), bool(step.get("split"))
    return lambda spark, frames: join(*_inputs(step, frames), on, how, split)


@step_type("aggregate")
def aggregate_step(step: dict) -> Action:
    wanted = _need(step, "aggregations")
    _need_inputs(step, 1)
    for column, name in wanted.items():
        if name not in FUNCTIONS:
            raise StepError(f"step {step['name']!r}: unknown function {name!r} for {column!r}")

    def action(spark: SparkSession, frames: Frames) -> DataFrame:
        columns = [FUNCTIONS[name](column).alias(f"{column}_{name}") for column, name in wanted.items()]
        return _inputs(step, frames)[0].groupBy(*(step.get("group_by") or [])).agg(*columns)

    return action


@step_type("python")
def python_step(step: dict) -> Action:
    function = _need(step, "function")
    if not callable(function):
        function = _import(step, function)

    def action(spark: SparkSession, frames: Frames) -> DataFrame:
        inputs = _inputs(step, frames)
        try:
            result = function(*inputs, **(step.get("params") or {}))
        except SluicewayError:
            raise
        except Exception as error:
            raise StepError(f"step {step['name']!r}: {error}") from error
        if not isinstance(result, DataFrame):
            raise StepError(f"step {step['name']!r} returned {type(result).__name__}, not a DataFrame")
        return result

    return action


def _import(step: dict, path: str) -> Callable:
    module, _, name = path.rpartition(".")
    try:
        return getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError, ValueError) as error:
        raise StepError(f"step {step['name']!r}: cannot load {path!r}: {error}") from error


@step_type("sql")
def sql_step(step: dict) -> Action:
    """A query over the inputs; ``streaming_sql`` is its form where an input is a stream.

    Streams support no exact distinct count, so a query that has one names an approximate one there;
    without that Spark says so when the stream starts.
    """
    text = _need(step, "sql")
    streaming = step.get("streaming_sql") or text

    def action(spark: SparkSession, frames: Frames) -> DataFrame:
        try:
            with views(spark, frames):
                result = spark.sql(text)
                return spark.sql(streaming) if result.isStreaming else result
        except Exception as error:
            raise StepError(f"step {step['name']!r}: {error}") from error

    return action


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary


@contextmanager
def views(spark: SparkSession, frames: Frames):
    """Frames as temporary views for as long as a query is analyzed.

    The views of the session that had these names come back, and no run sees those of another: names belong
    to the session, so runs in other threads wait for the moment that the analysis takes.
    """
    with _naming:
        yield from _named(spark, frames)


def _named(spark: SparkSession, frames: Frames):
    taken = {name: spark.table(name) for name in frames if _is_view(spark, name)}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in frames:
            if name in taken:
                taken[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
