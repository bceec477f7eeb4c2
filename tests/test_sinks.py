import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluiceway import storage
from sluiceway.errors import GateError, SinkError
from sluiceway.quality.suite import Report, evaluate
from sluiceway.sinks import layout, merge, writer
from sluiceway.sinks.writer import write, write_checked


def target(path, mode="overwrite", **rest):
    return {"type": "parquet", "path": str(path), "mode": mode, **rest}


def files(path):
    return sorted(p for p in path.rglob("*.parquet"))


def hidden(path):
    return [p.name for p in path.iterdir() if p.name.startswith("_")]


PASSING = {"rules": [{"name": "some", "type": "row_count", "min_count": 1}]}
FAILING = {"rules": [{"name": "many", "type": "row_count", "min_count": 99}]}


def test_overwrite_then_append_doubles_the_rows(spark, people, tmp_path):
    path = tmp_path / "t"
    assert write(people, target(path)).rows_written == 5
    result = write(people, target(path, "append"))
    assert (result.success, result.mode, result.rows_written) == (True, "append", 5)
    assert spark.read.parquet(str(path)).count() == 10
    write(people, target(path))
    assert spark.read.parquet(str(path)).count() == 5
    assert hidden(tmp_path) == []


def test_append_is_the_default(spark, people, tmp_path):
    plain = {"type": "parquet", "path": str(tmp_path / "t")}
    assert write(people, plain).mode == "append"
    write(people, plain)
    assert spark.read.parquet(plain["path"]).count() == 10


def test_partitions(spark, people, tmp_path):
    write(people, target(tmp_path / "t", partition_by=["date"]))
    assert sorted(p.name for p in (tmp_path / "t").glob("date=*")) == [f"date=2023-03-0{i}" for i in (5, 6, 7)]
    assert len(files(tmp_path / "t")) == 3


@pytest.mark.parametrize("mode", ["overwrite", "append", "merge"])
def test_gate(spark, people, tmp_path, mode):
    wanted = target(tmp_path / "t", mode, merge_keys=["id"])
    with pytest.raises(GateError, match="many"):
        write(people, wanted, evaluate(people, FAILING))
    assert not (tmp_path / "t").exists()
    with pytest.raises(GateError, match="many"):
        write_checked(people, wanted, FAILING)
    assert not (tmp_path / "t").exists() and hidden(tmp_path) == []
    write(people, wanted, evaluate(people, PASSING))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_gate_leaves_the_old_result(spark, people, tmp_path):
    write(people, target(tmp_path / "t"))
    with pytest.raises(GateError):
        write_checked(people.limit(1), target(tmp_path / "t"), FAILING)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_failures_may_be_reported_only(spark, people, tmp_path):
    result, report = write_checked(people, target(tmp_path / "t"), {**FAILING, "fail_on_error": False})
    assert result.rows_written == 5 and report.failed == ["many"]


def test_rules_and_write_share_one_pass(spark, people, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    traced = people.mapInPandas(seen, people.schema)
    rules = {"rules": [
        {"name": "a", "type": "null_check", "column": "id"},
        {"name": "b", "type": "range_check", "column": "age", "min_value": 1},
        {"name": "c", "type": "custom", "check": lambda df: (df.count() == 5, "five")},
    ]}
    result, report = write_checked(traced, target(tmp_path / "t", partition_by=["date"]), rules)
    assert calls.value == 5 and result.rows_written == 5 and report.passed == ["a", "b", "c"]


def test_rule_failing_on_the_data_blocks_and_cleans_up(people, tmp_path):
    rules = {"rules": [{"name": "divides", "type": "formula", "column": "age", "expression": "1 / (age - 30)"}]}
    with pytest.raises(GateError, match="divides"):
        write_checked(people, target(tmp_path / "t"), rules)
    assert list(tmp_path.iterdir()) == []


def test_empty_result(spark, people, tmp_path):
    result, report = write_checked(people.limit(0), target(tmp_path / "t"), {"rules": []})
    assert result.rows_written == 0
    rules = {"rules": [{"name": "n", "type": "null_check", "column": "id"}]}
    result, report = write_checked(people.where("id > 99"), target(tmp_path / "u"), rules)
    assert result.rows_written == 0 and report.all_passed()
    assert spark.read.schema(people.schema).parquet(str(tmp_path / "u")).count() == 0


def test_overwriting_what_the_plan_reads_keeps_the_data(spark, people, tmp_path):
    write(people, target(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert write(stored.where("age >= 30"), target(tmp_path / "t")).rows_written == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


@pytest.mark.parametrize(
    "wrong",
    [
        {"type": "excel", "path": "x"},
        {"type": "parquet"},
        {"type": "parquet", "path": "x", "mode": "replace"},
        {"type": "parquet", "path": "x", "mode": "merge"},
    ],
)
def test_wrong_targets_are_reported_before_any_job(people, jobs, wrong):
    def run():
        with pytest.raises(SinkError):
            write(people, wrong)

    assert jobs(run) == 0


def test_delta_without_connector_says_so(people, tmp_path):
    with pytest.raises(SinkError, match="delta connector"):
        write(people, {"type": "delta", "path": str(tmp_path / "t")})


def test_catalog_table(spark, people):
    name = "spark_catalog.default.people_target"
    writer.drop(spark, name)
    wanted = {"type": "parquet", "path": name, "mode": "overwrite", "partition_by": ["date"]}
    write(people, wanted)
    result, _ = write_checked(people, {**wanted, "mode": "append"}, PASSING)
    assert result.rows_written == 5 and spark.table(name).count() == 10
    write(people, wanted)
    merged = people.where("id > 3").withColumn("salary", F.lit(1).cast("bigint"))
    write(merged, {**wanted, "mode": "merge", "merge_keys": ["id"]})
    assert spark.table(name).count() == 5 and spark.table(name).where("salary = 1").count() == 2
    writer.drop(spark, name)
    assert not spark.catalog.tableExists(name)


def test_drop_folder_and_export(spark, people, tmp_path):
    writer.export_csv(people, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 5 and back.columns == people.columns
    writer.drop(spark, str(tmp_path / "csv"))
    writer.drop(spark, str(tmp_path / "csv"))
    assert not (tmp_path / "csv").exists()


@pytest.fixture
def old(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "lost")], "id int, v string")


@pytest.fixture
def new(spark):
    return spark.createDataFrame([("B", 2), ("c", 3), ("found", None)], "v string, id int")


MERGED = {(1, "a"), (2, "B"), (3, "c"), (None, "lost"), (None, "found")}


def test_upsert(old, new):
    assert {tuple(row) for row in merge.upsert(old, new, ["id"]).collect()} == MERGED


def test_upsert_casts_like_the_target_and_needs_its_columns(old, new):
    wide = new.withColumn("id", F.col("id").cast("bigint"))
    assert merge.upsert(old, wide, ["id"]).schema == old.schema
    with pytest.raises(SinkError, match="lacks"):
        merge.upsert(old, new.drop("v"), ["id"])
    with pytest.raises(SinkError, match="adds"):
        merge.upsert(old, new.withColumn("w", F.lit(1)), ["id"])


def test_two_source_rows_for_one_target_row(old, new):
    with pytest.raises(PySparkException, match="several source rows"):
        merge.upsert(old, new.unionAll(new.where("id = 2")), ["id"]).collect()
    twice = merge.upsert(old, new.unionAll(new.where("id = 3")), ["id"])
    assert twice.where("id = 3").count() == 2


def test_merge_creates_then_updates(spark, old, new, tmp_path):
    wanted = target(tmp_path / "t", "merge", merge_keys=["id"])
    assert write(old, wanted).rows_written == 3
    assert write(new, wanted).rows_written == 3
    assert {tuple(row) for row in spark.read.parquet(wanted["path"]).collect()} == MERGED
    assert hidden(tmp_path) == []


def test_failed_merge_leaves_the_target(spark, old, new, tmp_path):
    wanted = target(tmp_path / "t", "merge", merge_keys=["id"])
    write(old, wanted)
    with pytest.raises(Exception, match="several source rows"):
        write(new.unionAll(new), wanted)
    assert spark.read.parquet(wanted["path"]).count() == 3


@pytest.mark.parametrize("listed", [5_000, 1])
def test_partitioned_merge_touches_only_its_partitions(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(merge, "LISTED_PARTITIONS", listed)
    rows = [(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, None, 40)]
    schema = "id int, part string, v int"
    wanted = target(tmp_path / "t", "merge", merge_keys=["id", "part"], partition_by=["part"])
    write(spark.createDataFrame(rows, schema), wanted)
    untouched = files(tmp_path / "t" / "part=b")
    changes = [(2, "a", 21), (5, "c", 50), (4, None, 41)]
    write(spark.createDataFrame(changes, schema), wanted)
    found = {(row.id, row.part, row.v) for row in spark.read.parquet(wanted["path"]).collect()}
    assert found == {(1, "a", 10), (2, "a", 21), (3, "b", 30), (4, None, 40), (5, "c", 50), (4, None, 41)}
    assert files(tmp_path / "t" / "part=b") == untouched


def test_merge_reads_the_touched_files_alone(spark, tmp_path, monkeypatch):
    """Beyond the listed number of partitions, too: of 200 folders a quarter is touched and no other file read."""
    monkeypatch.setattr(merge, "LISTED_PARTITIONS", 20)
    monkeypatch.setattr(merge, "FOLDERS_IN_A_SCAN", 20)
    part = "if(id % 100 = 7, NULL, concat('a:', lpad(id, 4, '0'))) AS part"
    path = str(tmp_path / "t")
    wanted = target(path, "merge", merge_keys=["id", "part"], partition_by=["part"])
    write(spark.range(200).selectExpr("id", part, "1 AS v").repartition(1), wanted)
    newer = spark.range(0, 240, 4).selectExpr("id", part, "2 AS v")
    stored = merge.read_as(spark, path, {"part": newer.schema["part"].dataType})
    read = merge.touched(stored, newer, ["part"], path)
    folders = {file.rpartition("/")[0] for file in read.inputFiles()}
    assert len(folders) == 50 and read.count() == 50
    write(newer, wanted)
    found = {row.id: (row.part, row.v) for row in merge.read_as(spark, path, {"part": newer.schema["part"].dataType}).collect()}
    assert len(found) == 210 and found[4] == ("a:0004", 2) and found[5] == ("a:0005", 1) and found[7] == (None, 1)
    assert hidden(tmp_path) == []


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_checked_append_writes_once(spark, tmp_path, jobs, partition_by):
    frame = spark.range(100).selectExpr("id", "if(id < 3, NULL, concat('p', id % 4)) AS part")
    wanted = target(tmp_path / "t", "append", partition_by=partition_by)
    rules = {"rules": [{"name": "ids", "type": "null_check", "column": "id"}]}
    runs = [lambda: writer.write_checked(frame, wanted, rules) for _ in range(2)]
    plain = jobs(lambda: merge.arranged(frame, partition_by).write.partitionBy(*partition_by).parquet(f"{tmp_path}/plain"))
    assert [jobs(run) for run in runs] == [plain] * 2
    assert spark.read.parquet(wanted["path"]).count() == 200
    assert spark.read.parquet(wanted["path"]).where("part IS NULL").count() == 6
    assert hidden(tmp_path) == []
    with pytest.raises(GateError):
        writer.write_checked(frame, wanted, {"rules": [{"name": "many", "type": "row_count", "min_count": 999}]})
    assert hidden(tmp_path) == []
    assert spark.read.parquet(wanted["path"]).count() == 200


def test_checked_append_arrives_after_a_crash(spark, tmp_path, monkeypatch):
    """The driver ends while files move; the next write moves the rest before its own."""
    frame = spark.range(40).selectExpr("id", "id % 4 AS part")
    wanted = target(tmp_path / "t", "append", partition_by=["part"])
    rules = {"rules": [{"name": "ids", "type": "null_check", "column": "id"}]}
    real, calls = storage.move, []

    def move(*arguments):
        calls.append(arguments)
        if len(calls) > 3:
            raise KeyboardInterrupt
        real(*arguments)

    monkeypatch.setattr(storage, "move", move)
    with pytest.raises(KeyboardInterrupt):
        writer.write_checked(frame, wanted, rules)
    monkeypatch.setattr(storage, "move", real)
    assert 0 < spark.read.parquet(wanted["path"]).count() < 40
    writer.write_checked(frame, wanted, rules)
    assert spark.read.parquet(wanted["path"]).count() == 80 and hidden(tmp_path) == []


def test_merge_on_two_partition_columns(spark, tmp_path):
    rows = [(1, "a", 1, 10), (2, "a", 2, 20), (3, None, 1, 30)]
    schema = "id int, p string, q int, v int"
    wanted = target(tmp_path / "t", "merge", merge_keys=["id", "p", "q"], partition_by=["p", "q"])
    write(spark.createDataFrame(rows, schema), wanted)
    write(spark.createDataFrame([(1, "a", 1, 11), (9, None, 1, 90)], schema), wanted)
    found = {(row.id, row.v) for row in spark.read.parquet(wanted["path"]).collect()}
    assert found == {(1, 11), (2, 20), (3, 30), (9, 90)}


@pytest.mark.parametrize("partition_by", [[], ["part"]])
@pytest.mark.parametrize("broken_at", [1, 2, 3, 4])
def test_merge_completes_after_a_crash(spark, tmp_path, monkeypatch, partition_by, broken_at):
    """The driver ends at any move of a swap; the same merge, run again, loses and doubles nothing."""
    schema = "id int, part string, v int"
    wanted = target(tmp_path / "t", "merge", merge_keys=["id", "part"], partition_by=partition_by)
    write(spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, "c", 40)], schema), wanted)
    changes = spark.createDataFrame([(2, "a", 21), (3, "b", 31), (5, "b", 50)], schema)
    real, calls = storage.move, []

    class Crash(BaseException):
        pass

    def move(*arguments):
        calls.append(arguments)
        if len(calls) >= broken_at:
            raise Crash
        real(*arguments)

    monkeypatch.setattr(storage, "move", move)
    broken = False
    try:
        write(changes, wanted)
    except Crash:
        broken = True
    assert broken == (broken_at <= (4 if partition_by else 2))
    monkeypatch.setattr(storage, "move", real)
    write(changes, wanted)
    found = sorted((row.id, row.part, row.v) for row in spark.read.parquet(wanted["path"]).collect())
    assert found == [(1, "a", 10), (2, "a", 21), (3, "b", 31), (4, "c", 40), (5, "b", 50)]
    assert [name for name in hidden(tmp_path) if "retired" in name] == []


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    frame = spark.range(1_000).withColumn("day", F.col("id") % 3)
    frame.repartition(20).write.parquet(str(tmp_path / "t"))
    assert len(files(tmp_path / "t")) == 20
    assert layout.compact(spark, str(tmp_path / "t")) == 1
    assert len(files(tmp_path / "t")) == 1 and spark.read.parquet(str(tmp_path / "t")).count() == 1_000
    frame.repartition(8).write.partitionBy("day").parquet(str(tmp_path / "p"))
    layout.compact(spark, str(tmp_path / "p"), ["day"])
    assert len(files(tmp_path / "p")) == 3 and spark.read.parquet(str(tmp_path / "p")).count() == 1_000
    assert hidden(tmp_path) == []


def test_optimize_of_a_target(spark, people, tmp_path):
    wanted = target(tmp_path / "t", optimize={"enabled": True, "zorder_by": ["age", "name"]}, partition_by=["date"])
    write(people, wanted)
    assert spark.read.parquet(wanted["path"]).count() == 5
    assert len(list((tmp_path / "t").glob("date=*"))) == 3


def test_ranges_narrow_the_files(spark):
    frame = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1_000)).alias("a"), "id")
    spans = (
        layout.clustered(frame, ["a", "id"], 16)
        .groupBy(F.spark_partition_id())
        .agg((F.max("a") - F.min("a")).alias("a"), F.count(F.lit(1)).alias("n"))
        .agg(F.max("a"), F.count(F.lit(1)), F.sum("n"), F.max("n"))
        .first()
    )
    assert spans[0] < 200 and spans[1] == 16 and spans[2] == 20_000 and spans[3] < 4_000


@pytest.mark.parametrize("partition_by", [[], ["date"]])
def test_tables_of_parquet_are_merged_and_optimized(spark, people, partition_by):
    name = "spark_catalog.default.people_optimized"
    writer.drop(spark, name)
    keys = ["id", "date"]
    wanted = {"type": "parquet", "path": name, "mode": "overwrite", "partition_by": partition_by}
    write(people.repartition(5), wanted)
    newer = people.where("id > 3").withColumn("salary", F.lit(1).cast("bigint"))
    newer = newer.unionByName(newer.limit(1).withColumn("date", F.lit("2024-01-01")))
    write(newer, {**wanted, "mode": "merge", "merge_keys": keys})
    assert spark.table(name).count() == 6 and spark.table(name).where("salary = 1").count() == 3
    write(people, {**wanted, "mode": "append", "optimize": {"enabled": True, "zorder_by": ["age"]}})
    assert spark.table(name).count() == 11
    files_of_a_part = spark.table(name).inputFiles()
    assert len(files_of_a_part) == (4 if partition_by else 1)
    assert sorted(map(tuple, spark.table(name).where("salary > 1").select("id", "name", "date").collect())) == sorted(
        [*map(tuple, people.select("id", "name", "date").collect()), *map(tuple, people.where("id < 4").select("id", "name", "date").collect())]
    )
    writer.drop(spark, name)


def test_clustering_splits_one_heavy_value(spark):
    frame = spark.range(10_000).withColumn("k", F.when(F.col("id") < 9_000, 5).otherwise(F.col("id")))
    sizes = layout.clustered(frame, ["k"], 8).groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 4_000


def test_ranges_of_written_files(spark, tmp_path):
    frame = spark.range(5_000).select(F.pmod(F.xxhash64("id"), F.lit(700)).alias("k"))
    layout.clustered(frame, ["k"], 8).write.parquet(str(tmp_path / "c"))
    found = layout.overlaps(layout.file_ranges(spark.read.parquet(str(tmp_path / "c")), "k")).first()
    assert (found.files, found.rows, found.overlapping) == (8, 5_000, 0)
    frame.repartition(5).write.parquet(str(tmp_path / "r"))
    assert layout.overlaps(layout.file_ranges(spark.read.parquet(str(tmp_path / "r")), "k")).first().overlapping == 4


def test_report_methods():
    report = Report()
    report.add("good", True, "fine")
    report.add("bad", False, "reason")
    assert not report.all_passed() and report.executed == ["good", "bad"]
    assert report.failed == ["bad"] and report.details == {"bad": "reason"}


def test_staging_is_next_to_the_target():
    staged = storage.sibling("/data/out/t", "staged")
    assert staged.startswith("/data/out/_staged_t_")
