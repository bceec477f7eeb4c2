"""Runs a spec as streaming tables with batch views at the end.

Fact sources are streams and dimensions are batches. Steps on streams run into stored tables; the last
step, and any step that mixes streams with other batch tables, is a batch over those tables and is
recomputed each time. The rules are row expectations on the last view.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sluiceway import storage
from sluiceway.errors import SinkError, SpecError
from sluiceway.plans.steps import chain, prepare
from sluiceway.quality.expectations import keep_valid
from sluiceway.quality.rules import check_rules
from sluiceway.sinks import writer
from sluiceway.sources.readers import DIMENSION_WORDS, read_source, read_stream, source_mode
from sluiceway.streaming import sinks
from sluiceway.streaming.engagement import with_event_time
from sluiceway.streaming.snapshots import Snapshots


def _is_dimension(name: str) -> bool:
    return any(word in name.lower() for word in DIMENSION_WORDS)


def table_kinds(spec: dict) -> dict[str, str]:
    """``stream`` or ``batch`` for every source and step output.

    The last step is a batch. Another step on streams is a stream, also where it joins dimensions;
    with any other batch table among its inputs it is a batch.
    """
    kinds = {source["name"]: source_mode(source) for source in spec["sources"]}
    dimensions = {name for name, kind in kinds.items() if kind == "batch"}
    steps = spec.get("transformations") or []
    for step in steps:
        name, inputs = step["output"], step["inputs"]
        streams = [i for i in inputs if kinds.get(i) == "stream"]
        others = [i for i in inputs if kinds.get(i) != "stream" and i not in dimensions]
        last = step is steps[-1]
        kinds[name] = "stream" if streams and not others and not last else "batch"
        if kinds[name] == "batch" and not streams and _is_dimension(name):
            dimensions.add(name)
    return kinds


@dataclass
class StreamRun:
    """Stored tables by name, the final view, and how many late rows each stream dropped."""

    tables: dict[str, str]
    view: DataFrame
    kinds: dict[str, str]
    late: dict[str, int]


def run(spark: SparkSession, spec: dict, folder: str | None = None, seconds: int | None = None) -> StreamRun:
    """Runs the streams of a spec over all files that are there, then builds the final view.

    ``spec["streaming"]`` may hold ``watermark`` (``{"column", "delay"}``), ``output_mode``,
    ``keys`` and ``partition_by`` of the stored tables, ``drop_late``, ``checkpoint``, ``state_partitions`` and
    ``continuous``. With the same ``folder`` a second run reads only new files.
    """
    settings = spec.get("streaming") or {}
    if settings.get("continuous"):
        raise SpecError("a continuous run does not end; use start_streams and stop the queries")
    folder = folder or storage.new_folder(spark, "streams")
    queries, targets, frames, kinds = start_streams(spark, spec, folder)
    late = {name: sinks.finish(query, seconds) for name, query in zip(targets, queries)}
    if any(late.values()) and not settings.get("drop_late"):
        raise SinkError(f"rows came later than the watermark: {late}; choose a longer delay or set drop_late")
    view = final_view(spark, spec, frames, targets)
    if spec.get("target"):
        writer.write(view, spec["target"])
    return StreamRun({name: target.path for name, target in targets.items()}, view, kinds, late)


def split_steps(spec: dict, kinds: dict[str, str]) -> tuple[list[dict], list[dict]]:
    """Steps that can be built at once, and those that have to wait for stored streams."""
    waiting, now, later = set(), [], []
    for step in spec.get("transformations") or []:
        needs_store = kinds[step["output"]] == "batch" and any(kinds[i] == "stream" for i in step["inputs"])
        if needs_store or any(i in waiting for i in step["inputs"]):
            waiting.add(step["output"])
            later.append(step)
        else:
            now.append(step)
    return now, later


def start_streams(spark: SparkSession, spec: dict, folder: str):
    """Starts one query for every stream that a batch step, or nobody but the user, reads.

    Returns the queries, the targets by name, all frames and the kinds. What steps make of dimensions is
    computed once, before the streams that join it start.
    """
    settings = spec.get("streaming") or {}
    kinds = table_kinds(spec)
    for step in spec.get("transformations") or []:
        prepare(step)
    frames = {}
    for source in spec["sources"]:
        name = source["name"]
        frames[name] = read_stream(spark, source) if kinds[name] == "stream" else read_source(spark, source)
        mark = settings.get("watermark")
        if mark and kinds[name] == "stream" and mark["column"] in frames[name].columns:
            frames[name] = with_event_time(frames[name], mark["column"], mark["delay"])
    now, later = split_steps(spec, kinds)
    static = [step for step in now if kinds[step["output"]] == "batch"]
    frames = chain(spark, frames, static)
    streamed = [step for step in now if step not in static]
    joined = {name for step in streamed for name in step["inputs"]}
    snapshots = Snapshots(spark, f"{folder}/snapshots")
    for step in static:
        if step["output"] in joined:
            frames[step["output"]] = snapshots.take(step["output"], frames[step["output"]])
    frames = chain(spark, frames, streamed)
    if spec.get("transformations"):
        wanted = list(dict.fromkeys(name for step in later for name in step["inputs"] if name in frames))
    else:
        wanted = [spec["sources"][0]["name"]]
    queries, targets = [], {}
    sources = {source["name"] for source in spec["sources"]}
    for name in wanted:
        if not frames[name].isStreaming:
            continue
        stateful = name not in sources and settings.get("keys")
        target = sinks.StreamTarget(
            path=f"{folder}/{name}",
            checkpoint=f"{settings.get('checkpoint', folder + '/checkpoints')}/{name}",
            output_mode=settings.get("output_mode", "update") if stateful else "append",
            keys=tuple(settings.get("keys") or ()) if stateful else (),
            partition_by=tuple(settings.get("partition_by") or ()) if stateful else (),
            continuous=bool(settings.get("continuous")),
            state_partitions=settings.get("state_partitions"),
        )
        queries.append(sinks.start(frames[name], target))
        targets[name] = target
    return queries, targets, frames, kinds


def final_view(spark: SparkSession, spec: dict, frames: dict, targets: dict[str, sinks.StreamTarget]) -> DataFrame:
    """Result of the batch steps over the stored tables, without the rows that violate an expectation."""
    stored = {name: frame for name, frame in frames.items() if not frame.isStreaming}
    for name, target in targets.items():
        stored[name] = sinks.read(spark, target, frames[name].schema)
    steps = spec.get("transformations") or []
    if steps:
        _, later = split_steps(spec, table_kinds(spec))
        view = chain(spark, stored, later)[steps[-1]["output"]]
    else:
        view = stored[spec["sources"][0]["name"]]
    validation = spec.get("validation") or {"enabled": False}
    rules = validation.get("rules") or [] if validation.get("enabled", True) else []
    check_rules(rules)
    return keep_valid(view, rules)
