"""Targets of a spec, and the gate in front of them."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import ArithmeticException, DateTimeException, NumberFormatException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluiceway import storage
from sluiceway.errors import GateError, SinkError
from sluiceway.quality.suite import Report, Suite
from sluiceway.sinks import layout, merge
from sluiceway.sources.readers import is_table_name

# Target types and write modes of a spec.
TYPES = ("parquet", "delta")
MODES = ("append", "overwrite", "merge")

# Errors a rule may cause on the data; the write is then staged again without its rules.
DATA_ERRORS = (ArithmeticException, DateTimeException, NumberFormatException, SparkRuntimeException)


@dataclass
class WriteResult:
    """What was written where."""

    success: bool
    path: str
    mode: str
    rows_written: int
    metrics: dict[str, Any] = field(default_factory=dict)


def check_target(target: dict) -> None:
    """Reports a wrong target before any job runs."""
    if target.get("type") not in TYPES:
        raise SinkError(f"unknown target type {target.get('type')!r}, use one of {TYPES}")
    if not target.get("path"):
        raise SinkError("the target has no path")
    mode = target.get("mode", "append")
    if mode not in MODES:
        raise SinkError(f"unknown write mode {mode!r}, use one of {MODES}")
    if mode == "merge" and not target.get("merge_keys"):
        raise SinkError("merge needs merge_keys")


def gate(report: Report | None, fail_on_error: bool = True) -> None:
    """Stops a write whose report has failed rules; no report means no gate."""
    if report is not None and fail_on_error and not report.all_passed():
        raise GateError(f"nothing was written, failed rules: {', '.join(report.failed)}")


def write(df: DataFrame, target: dict, report: Report | None = None, fail_on_error: bool = True) -> WriteResult:
    """Writes a frame whose rules were already evaluated, if they were at all."""
    check_target(target)
    gate(report, fail_on_error)
    if target.get("mode", "append") == "append":
        return _publish(df, target)
    staged, rows, _ = _stage(df, target, Suite(None, df))
    return _publish_staged(df, staged, rows, target)


def write_checked(df: DataFrame, target: dict, validation: dict | None) -> tuple[WriteResult, Report]:
    """Stages the frame, measures its rules in that same job, and publishes it if they pass.

    The result is neither cached nor computed twice. The measures sit above the last shuffle, in
    the tasks that write, where Spark counts each partition once even if executors are lost.
    """
    check_target(target)
    validation = validation or {"enabled": False}
    suite = Suite(validation, df)
    if not suite.rules and target.get("mode", "append") == "append":
        return _publish(df, target), Report()
    staged, rows, values = _stage(df, target, suite)
    stored = df.sparkSession.read.schema(df.schema).parquet(staged)
    try:
        report = suite.report(suite.measure(stored) if values is None else values, stored)
        gate(report, validation.get("fail_on_error", True))
    except Exception:
        storage.remove(df.sparkSession, staged)
        raise
    return _publish_staged(df, staged, rows, target), report


def drop(spark, path: str) -> None:
    """Removes an output table or folder if there is one."""
    if is_table_name(path):
        spark.sql(f"DROP TABLE IF EXISTS {path}")
    elif storage.exists(spark, path):
        storage.remove(spark, path)


def export_csv(df: DataFrame, path: str) -> None:
    """Writes a result as CSV files with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _stage(df: DataFrame, target: dict, suite: Suite) -> tuple[str, int, dict | None]:
    """Folder, number of rows and values of the rules; no values if a rule fails on the data."""
    measures = suite.columns()
    try:
        return _write_staged(df, target, measures)
    except DATA_ERRORS:
        if not measures:
            raise
        staged, rows, _ = _write_staged(df, target, [])
        return staged, rows, None


def _write_staged(df: DataFrame, target: dict, measures: list[Column]) -> tuple[str, int, dict]:
    spark, path = df.sparkSession, target["path"]
    in_place = target["type"] == "parquet" and not is_table_name(path)
    staged = storage.sibling(path, "staged") if in_place else storage.new_folder(spark, "staged")
    columns = target.get("partition_by") or []
    seen = Observation()
    # The observation is the last operator before the writer, see write_checked.
    observed = merge.arranged(df, columns).observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    try:
        observed.write.partitionBy(*columns).parquet(staged)
    except Exception:
        storage.remove(spark, staged)
        raise
    return staged, seen.get["rows"], seen.get


def _publish_staged(df: DataFrame, staged: str, rows: int, target: dict) -> WriteResult:
    spark = df.sparkSession
    mode = target.get("mode", "append")
    if target["type"] == "parquet" and mode != "merge" and not is_table_name(target["path"]):
        if mode == "overwrite":
            storage.swap_in(spark, staged, target["path"])
        else:
            storage.recover(spark, target["path"])
            storage.publish(spark, staged, target["path"])
        _optimize(df, target)
        return _result(target, rows)
    stored = spark.read.schema(df.schema).parquet(staged)
    try:
        return _publish(stored, target, rows)
    finally:
        storage.remove(spark, staged)


def _publish(df: DataFrame, target: dict, rows: int | None = None) -> WriteResult:
    if target.get("mode", "append") == "merge":
        _merge(df, target)
    else:
        rows = _save(df, target)
    _optimize(df, target)
    return _result(target, rows)


def _result(target: dict, rows: int) -> WriteResult:
    metrics = {"rows_written": rows, "target_type": target["type"]}
    return WriteResult(True, target["path"], target.get("mode", "append"), rows, metrics)


def _save(df: DataFrame, target: dict, mode: str | None = None) -> int:
    """Plain append or overwrite, counting the rows on the way."""
    if not is_table_name(target["path"]):
        storage.recover(df.sparkSession, target["path"])
    seen = Observation()
    counted = merge.arranged(df, target.get("partition_by") or []).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(target["type"]).mode(mode or target.get("mode", "append"))
    writer = writer.partitionBy(*(target.get("partition_by") or []))
    try:
        if is_table_name(target["path"]):
            writer.saveAsTable(target["path"])
        else:
            writer.save(target["path"])
    except Exception as error:
        if target["type"] == "delta" and "DATA_SOURCE_NOT_FOUND" in str(error):
            raise SinkError("this Spark has no delta connector") from error
        raise
    return seen.get["rows"]


def _merge(df: DataFrame, target: dict) -> None:
    """Merge into an existing target; a missing one is created. Any other error is passed on."""
    spark, path, keys = df.sparkSession, target["path"], list(target["merge_keys"])
    named = is_table_name(path)
    if target["type"] == "parquet" and not named:
        merge.merge_folder(df, path, keys, target.get("partition_by") or [])
    elif not (spark.catalog.tableExists(path) if named else storage.exists(spark, path)):
        _save(df, target, "append")
    elif target["type"] == "parquet":
        folder, columns = _table_folder(spark, path)
        merge.merge_folder(df, folder, keys, columns)
        _refresh(spark, path, columns)
    else:
        table = path if named else f"delta.`{path}`"
        same = " AND ".join(f"target.`{key}` = source.`{key}`" for key in keys)
        spark.sql(
            f"MERGE INTO {table} AS target USING {{source}} AS source ON {same} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
            source=df,
        )


def _table_folder(spark, name: str) -> tuple[str, list[str]]:
    """Where the files of a catalog table are, and the columns it is partitioned by."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    if described is None:
        raise SinkError(f"{name} has no folder of its own")
    return described["data_type"], [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _refresh(spark, name: str, columns: list[str]) -> None:
    """Tells the catalog of files that were written into a table's folder."""
    if columns:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def _optimize(df: DataFrame, target: dict) -> None:
    spark, path = df.sparkSession, target["path"]
    wanted = target.get("optimize") or {}
    vacuum = target.get("vacuum") or {}
    if target["type"] == "delta":
        table = path if is_table_name(path) else f"delta.`{path}`"
        if wanted.get("enabled"):
            order = ", ".join(wanted.get("zorder_by") or [])
            spark.sql(f"OPTIMIZE {table}" + (f" ZORDER BY ({order})" if order else ""))
        if vacuum.get("enabled"):
            spark.sql(f"VACUUM {table} RETAIN {int(vacuum.get('retention_hours', 168))} HOURS")
    elif wanted.get("enabled"):
        named = is_table_name(path)
        folder, columns = _table_folder(spark, path) if named else (path, target.get("partition_by"))
        layout.compact(spark, folder, columns, wanted.get("zorder_by"), int(wanted.get("file_bytes", layout.FILE_BYTES)))
        if named:
            _refresh(spark, path, columns)
