import pytest

from sluiceway import run, run_many
from sluiceway.plans import runner, user_engagement


@pytest.fixture
def spec(people, tmp_path):
    people.coalesce(1).write.parquet(f"{tmp_path}/people")
    return {
        "pipeline": {"name": "staff"},
        "sources": [{"name": "people", "type": "parquet", "path": f"{tmp_path}/people"}],
        "transformations": [
            {"name": "rich", "type": "filter", "inputs": ["people"], "output": "rich", "condition": "salary > 60000"},
            {"name": "cut", "type": "sql", "inputs": ["rich"], "output": "cut", "sql": "SELECT id, name FROM rich"},
        ],
        "validation": {"rules": [{"name": "id", "type": "null_check", "column": "id"}]},
        "target": {"type": "parquet", "path": f"{tmp_path}/out", "mode": "overwrite"},
    }


def test_run(spark, spec):
    result = run(spark, spec)
    assert (result.status, result.name, result.validation_passed, result.error) == ("success", "staff", True, None)
    assert result.metrics == {"rows_written": 2, "validation_rules_executed": 1, "validation_rules_passed": 1}
    written = spark.read.parquet(spec["target"]["path"])
    assert written.count() == 2 and written.columns == ["id", "name"]


def test_a_whole_run_is_one_job(spark, spec, jobs):
    schema = "id bigint, name string, age bigint, salary bigint, date string"
    spec["sources"][0]["schema"] = schema
    assert jobs(lambda: run(spark, spec)) == 1


def test_failed_rules_write_nothing(spark, spec, tmp_path):
    spec["validation"]["rules"].append({"name": "many", "type": "row_count", "min_count": 9})
    result = run(spark, spec)
    assert result.status == "failed" and not result.validation_passed and "many" in result.error
    assert not (tmp_path / "out").exists()


def test_failed_rules_may_only_warn(spark, spec):
    spec["validation"] = {"fail_on_error": False, "rules": [{"name": "many", "type": "row_count", "min_count": 9}]}
    result = run(spark, spec)
    assert result.status == "success" and not result.validation_passed
    assert result.report.failed == ["many"] and spark.read.parquet(spec["target"]["path"]).count() == 2


def test_validation_off_or_absent(spark, spec):
    spec["validation"] = {"enabled": False, "rules": [{"name": "many", "type": "row_count", "min_count": 9}]}
    assert run(spark, spec).validation_passed
    del spec["validation"]
    assert run(spark, spec).metrics["validation_rules_executed"] == 0


def test_no_steps(spark, spec):
    del spec["transformations"]
    assert run(spark, spec).metrics["rows_written"] == 5


def test_every_frame_stays_addressable(spark, spec):
    result, frames = runner.build(spark, spec)
    assert set(frames) == {"people", "rich", "cut"} and frames["rich"].count() == 2 and result.columns == ["id", "name"]


@pytest.mark.parametrize(
    ("change", "message"),
    [
        ({"pipeline": {}}, "name"),
        ({"sources": []}, "source"),
        ({"target": None}, "target"),
        ({"target": {"type": "excel", "path": "x"}}, "excel"),
        ({"transformations": [{"name": "a", "type": "magic", "inputs": ["people"], "output": "b"}]}, "magic"),
        ({"validation": {"rules": [{"name": "a", "type": "magic"}]}}, "magic"),
        ({"validation": {"rules": [{"name": "a", "type": "null_check"}]}}, "column"),
        ({"sources": [{"name": "people", "type": "parquet", "path": "/no/such/folder"}]}, "people"),
    ],
)
def test_errors_end_as_failed(spark, spec, change, message):
    result = run(spark, {**spec, **change})
    assert result.status == "failed" and message in result.error


def test_many(spark, spec):
    broken = {**spec, "sources": [{"name": "people", "type": "parquet", "path": "/no/such/folder"}]}
    results, counts = run_many(spark, [broken, spec])
    assert [r.status for r in results] == ["failed", "success"]
    assert counts == {"total": 2, "succeeded": 1, "failed": 1}


def test_engagement_spec(spark, tmp_path):
    rows = [(i, 1 + i % 3, ["page_view", "click", "purchase"][i % 2], f"2024-01-0{1 + i // 12} 10:{i:02d}:00") for i in range(24)]
    events = spark.createDataFrame(rows, ["event_id", "user_id", "event_type", "timestamp"])
    events.withColumn("timestamp", events["timestamp"].cast("timestamp")).write.parquet(f"{tmp_path}/events")
    profiles = [(1, "Ann", "free", "2023-12-01"), (2, "Bo", "premium", "2023-12-31")]
    spark.createDataFrame(profiles, ["user_id", "name", "segment", "signup_date"]).write.parquet(f"{tmp_path}/profiles")
    spec = user_engagement.spec(
        {"type": "parquet", "path": f"{tmp_path}/events"}, {"type": "parquet", "path": f"{tmp_path}/profiles"}, f"{tmp_path}/out"
    )
    result = run(spark, spec)
    assert result.status == "success" and result.metrics["rows_written"] == 6
    written = spark.read.parquet(f"{tmp_path}/out")
    days = {(row.user_id, str(row.date)): row for row in written.collect()}
    assert days[(1, "2024-01-02")].days_since_signup == 32 and days[(3, "2024-01-01")].days_since_signup is None
    assert days[(2, "2024-01-01")].engagement_score == days[(2, "2024-01-01")].page_views + 2 * days[(2, "2024-01-01")].clicks


def test_rows_of_every_source_are_counted_by_the_write(spark, spec, people, tmp_path, jobs):
    people.withColumn("bonus", people.salary * 2).select("id", "bonus").write.parquet(f"{tmp_path}/bonus")
    spark.range(4).write.parquet(f"{tmp_path}/idle")
    schemas = {"people": "id bigint, name string, age bigint, salary bigint, date string", "bonus": "id bigint, bonus bigint", "idle": "id bigint"}
    spec["sources"] = [{"name": n, "type": "parquet", "path": f"{tmp_path}/{n}", "schema": s} for n, s in schemas.items()]
    text = "SELECT r.id, r.name, b.bonus FROM rich r JOIN bonus b USING (id) WHERE b.bonus > 130000"
    spec["transformations"][1] = {"name": "cut", "type": "sql", "inputs": ["rich", "bonus"], "output": "cut", "sql": text}
    assert "source_rows" not in run(spark, spec).metrics
    spec["count_sources"] = True
    plain = jobs(lambda: run(spark, {**spec, "count_sources": False}))
    results = []
    assert jobs(lambda: results.append(run(spark, spec))) == plain
    assert results[0].metrics["source_rows"] == {"people": 5, "bonus": 5}
    spec["transformations"] = []
    assert run(spark, spec).metrics["source_rows"] == {"people": 5}


def test_a_source_read_twice_is_counted_once(spark, spec):
    text = "SELECT a.id, b.name FROM people a JOIN people b ON a.id = b.id"
    spec["transformations"] = [{"name": "both", "type": "sql", "inputs": ["people"], "output": "both", "sql": text}]
    spec["count_sources"] = True
    result = run(spark, spec)
    assert result.status == "success", result.error
    assert result.metrics["source_rows"] == {"people": 5}
