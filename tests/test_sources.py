import json

import pytest
from pyspark.sql import functions as F

from sluiceway import storage
from sluiceway.errors import SluicewayError, SourceError
from sluiceway.sources import inventory, synthetic
from sluiceway.sources.readers import counted, is_table_name, read_source, read_sources, read_stream, source_mode


def test_unknown_type_is_reported_before_anything_is_read(spark, people, tmp_path, jobs):
    people.write.parquet(f"{tmp_path}/people")
    sources = [
        {"name": "good", "type": "parquet", "path": f"{tmp_path}/people"},
        {"name": "bad", "type": "excel", "path": "x"},
    ]

    def read():
        with pytest.raises(SourceError, match="excel"):
            read_sources(spark, sources)

    assert jobs(read) == 0


def test_delta_without_connector_says_so(spark, tmp_path):
    with pytest.raises(SourceError, match="delta connector"):
        read_source(spark, {"name": "d", "type": "delta", "path": str(tmp_path), "options": {"versionAsOf": 1}})


def test_missing_path_names_the_source(spark, tmp_path):
    with pytest.raises(SourceError, match="gone"):
        read_source(spark, {"name": "gone", "type": "parquet", "path": f"{tmp_path}/nowhere"})


def test_missing_key(spark):
    with pytest.raises(SourceError, match="path"):
        read_source(spark, {"name": "a", "type": "csv"})


def test_csv_defaults_and_overrides(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id;name\n1;x\n2;y\n")
    source = {"name": "a", "type": "csv", "path": str(path)}
    assert read_source(spark, {**source, "options": {"sep": ";"}}).dtypes == [("id", "int"), ("name", "string")]
    plain = read_source(spark, {**source, "options": {"sep": ";", "header": "false", "inferSchema": "false"}})
    assert plain.dtypes == [("_c0", "string"), ("_c1", "string")] and plain.count() == 3
    given = read_source(spark, {**source, "schema": "id bigint, name string", "options": {"sep": ";"}})
    assert given.dtypes == [("id", "bigint"), ("name", "string")] and given.count() == 2


def test_json_lines_and_multi_line(spark, tmp_path):
    lines, whole = tmp_path / "lines.json", tmp_path / "whole.json"
    lines.write_text('{"a": 1}\n{"a": 2}\n')
    whole.write_text(json.dumps([{"a": 1}, {"a": 2}, {"a": 3}], indent=2))
    assert read_source(spark, {"name": "j", "type": "json", "path": str(lines)}).count() == 2
    source = {"name": "j", "type": "json", "path": str(whole), "options": {"multiLine": "true"}}
    assert read_source(spark, source).count() == 3


def test_rows_are_counted_by_the_job_that_reads(spark, people, jobs):
    frame, seen = counted(people, "people")
    assert jobs(lambda: frame.write.format("noop").mode("overwrite").save()) == 1
    assert seen.get == {"rows": 5}


def test_table_names():
    assert is_table_name("spark_catalog.default.people")
    assert not is_table_name("default.people")
    assert not is_table_name("/data/a.b.c")
    assert not is_table_name("s3:a.b.c")


def test_catalog_table_as_source(spark, people):
    people.write.mode("overwrite").saveAsTable("spark_catalog.default.people_source")
    source = {"name": "p", "type": "parquet", "path": "spark_catalog.default.people_source"}
    assert read_source(spark, source).count() == 5
    spark.sql("DROP TABLE spark_catalog.default.people_source")


@pytest.mark.parametrize(
    ("name", "mode"),
    [("events", "stream"), ("user_profiles", "batch"), ("raw_customers_v2", "batch"), ("orders", "stream")],
)
def test_mode_by_name(name, mode):
    assert source_mode({"name": name}) == mode


def test_mode_given():
    assert source_mode({"name": "products", "mode": "stream"}) == "stream"
    with pytest.raises(SourceError):
        source_mode({"name": "a", "mode": "sometimes"})


def test_stream_over_one_file_and_over_a_folder(spark, people, tmp_path):
    people.coalesce(1).write.parquet(f"{tmp_path}/people")
    file = next(str(p) for p in (tmp_path / "people").glob("*.parquet"))
    for path in (f"{tmp_path}/people", file):
        frame = read_stream(spark, {"name": "people", "type": "parquet", "path": path})
        assert frame.isStreaming and frame.columns == people.columns


def test_missing_dataset_is_listed(spark, people, tmp_path):
    people.write.parquet(f"{tmp_path}/people")
    found = inventory.dataset_counts(spark, {"people": f"{tmp_path}/people", "gone": f"{tmp_path}/gone"})
    assert {tuple(row) for row in found.collect()} == {("people", 5, True), ("gone", None, False)}


def test_schema_overview(spark, people):
    spark.sql("CREATE DATABASE IF NOT EXISTS listed")
    assert inventory.schema_overview(spark, "listed").count() == 0
    people.write.mode("overwrite").saveAsTable("listed.people_table")
    people.createOrReplaceTempView("passing")
    found = inventory.schema_overview(spark, "listed").collect()
    assert [tuple(row) for row in found] == [("people_table", 5, 5, "id, name, age, salary, date")]
    spark.catalog.dropTempView("passing")
    spark.sql("DROP DATABASE listed CASCADE")


def test_profile_is_one_job(spark, people, jobs):
    frame = inventory.column_profile(people.withColumn("gap", F.when(F.col("id") > 2, F.col("id"))), "people")
    rows = []
    assert jobs(lambda: rows.extend(frame.collect())) <= 2
    profile = {row.column_name: row for row in rows}
    assert profile["gap"].nulls == 2 and profile["age"].min_value == "25" and profile["name"].max_value == "Teo"


def test_samples_follow_the_rules_of_their_entities(spark):
    events = synthetic.sample_events(spark.range(20_000))
    kinds = {row.event_type: row["count"] for row in events.groupBy("event_type").count().collect()}
    assert set(kinds) == set(synthetic.EVENT_TYPES) and min(kinds.values()) > 3_500
    with_product = events.where("product_id IS NOT NULL").select("event_type").distinct()
    assert {row[0] for row in with_product.collect()} == {"click", "add_to_cart", "purchase"}
    assert events.where("(revenue IS NOT NULL) != (event_type = 'purchase')").count() == 0
    limits = events.agg(F.min("revenue"), F.max("revenue"), F.min("user_id"), F.max("user_id")).first()
    assert limits[0] >= 10 and limits[1] <= 500 and limits[2] == 1 and limits[3] == 100
    days = events.agg(F.min(F.to_date("timestamp")).cast("string"), F.max(F.to_date("timestamp")).cast("string"))
    assert tuple(days.first()) == ("2024-01-01", "2024-01-30")
    sales = synthetic.sample_transactions(spark.range(20_000))
    share = sales.where("status = 'completed'").count() / 20_000
    assert 0.95 <= share < 0.98
    assert sales.where("abs(total_amount - quantity * unit_price) > 0.001").count() == 0
    assert synthetic.sample_profiles(spark.range(1, 101)).where("age BETWEEN 18 AND 65").count() == 100
    assert synthetic.sample_products(spark.range(1, 51)).where("rating BETWEEN 3 AND 5").count() == 50


def test_shared_folder_comes_from_the_session(spark):
    assert storage.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert storage.new_folder(spark, "x") != storage.new_folder(spark, "x")


def test_without_the_setting_only_local_sessions_get_a_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "local[2]"
            applicationId = "app-1"

    assert storage.shared_folder(Session) == storage.shared_folder(Session)
    Session.sparkContext.master = "spark://host:7077"
    with pytest.raises(SluicewayError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session)


def test_swap_restores_the_old_folder_on_failure(spark, people, tmp_path):
    people.write.parquet(f"{tmp_path}/kept")
    with pytest.raises(SluicewayError):
        storage.swap_in(spark, f"{tmp_path}/never_staged", f"{tmp_path}/kept")
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["kept"]


def test_distinct_sketches_of_parts_merge(spark):
    frame = spark.range(40_000).selectExpr("id % 5 AS part", "id % 9000 AS a", "if(id % 2 = 0, NULL, 'x') AS b", "id AS c")
    sketches = inventory.distinct_sketches(frame, ["a", "b", "c"], [F.col("part")])
    assert sketches.columns == ["part", "column_name", "sketch"] and sketches.count() == 15
    found = {r.column_name: r.estimate for r in inventory.merged_estimates(sketches).collect()}
    for name, exact in (("a", 9_000), ("b", 1), ("c", 40_000)):
        assert abs(found[name] - exact) <= max(1, exact * inventory.ERROR)
