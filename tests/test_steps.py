import pytest
from pyspark.sql import functions as F

from sluiceway.errors import StepError
from sluiceway.functions import columns
from sluiceway.operators.filters import by_threshold
from sluiceway.plans import steps
from sluiceway.plans.steps import apply_step, chain, prepare


def step(kind, inputs=("people",), **rest):
    return {"name": "s", "type": kind, "inputs": list(inputs), "output": "out", **rest}


def test_filter(spark, people):
    assert apply_step(spark, {"people": people}, step("filter", condition="age >= 30")).count() == 3


def test_sql(spark, people):
    found = apply_step(spark, {"people": people}, step("sql", sql="SELECT * FROM people WHERE salary > 60000"))
    assert found.count() == 2


def test_sql_views_do_not_outlive_the_step(spark, people):
    people.limit(1).createOrReplaceTempView("people")
    found = apply_step(spark, {"people": people, "others": people}, step("sql", sql="SELECT * FROM people, others"))
    assert found.count() == 25
    assert spark.table("people").count() == 1
    assert not spark.catalog.tableExists("others")
    spark.catalog.dropTempView("people")


def test_sql_error_is_a_step_error(spark, people):
    with pytest.raises(StepError):
        apply_step(spark, {"people": people}, step("sql", sql="SELECT nothing FROM people"))
    assert not spark.catalog.tableExists("people")


@pytest.mark.parametrize(("how", "rows"), [(None, 3), ("left", 4), ("right", 4), ("outer", 5), ("left_semi", 3), ("left_anti", 1)])
def test_join(spark, how, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], ["id", "name"])
    right = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (9, "w")], ["id", "department"])
    wanted = step("join", ["l", "r"], on="id", **({"how": how} if how else {}))
    found = apply_step(spark, {"l": left, "r": right}, wanted)
    assert found.count() == rows and found.columns.count("id") == 1


@pytest.mark.parametrize("key", ["on", "keys", True])
def test_join_key_spellings(spark, people, key):
    wanted = {**step("join", ["people", "people2"]), key: ["id", "name"]}
    found = apply_step(spark, {"people": people, "people2": people.select("id", "name")}, wanted)
    assert found.count() == 5 and len(found.columns) == 5


def test_semi_join_counts_a_row_once(spark):
    left = spark.createDataFrame([(1,), (2,)], ["id"])
    right = spark.createDataFrame([(1,), (1,), (1,)], ["id"])
    assert apply_step(spark, {"l": left, "r": right}, step("join", ["l", "r"], on="id", how="left_semi")).count() == 1


def test_aggregate(spark, people):
    wanted = step("aggregate", group_by=["date"], aggregations={"salary": "avg", "id": "count"})
    found = apply_step(spark, {"people": people}, wanted)
    assert found.count() == 3 and set(found.columns) == {"date", "salary_avg", "id_count"}


def test_aggregate_without_groups_and_with_nulls(spark):
    frame = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    wanted = step("aggregate", ["f"], aggregations={"x": "count"})
    assert apply_step(spark, {"f": frame}, wanted).collect() == [(2,)]
    assert apply_step(spark, {"f": frame.limit(0)}, wanted).collect() == [(0,)]


def test_python(spark, people):
    path = "sluiceway.operators.filters.by_threshold"
    wanted = step("python", function=path, params={"column": "age", "threshold": 30, "operator": "less"})
    assert apply_step(spark, {"people": people}, wanted).count() == 2
    assert apply_step(spark, {"people": people}, step("python", function=lambda df: df.limit(1))).count() == 1


def test_python_takes_inputs_in_order(spark, people):
    wanted = step("python", ["b", "a"], function=lambda first, second: first)
    assert apply_step(spark, {"a": people.limit(1), "b": people}, wanted).count() == 5


@pytest.mark.parametrize(
    "wrong",
    [
        step("filter"),
        step("filter", ["a", "b"], condition="true"),
        step("join", ["a", "b"]),
        step("join", ["a"], on="id"),
        step("aggregate"),
        step("aggregate", aggregations={}),
        step("aggregate", aggregations={"a": "median"}),
        step("aggregate", ["a", "b"], aggregations={"a": "sum"}),
        step("sql"),
        step("python"),
        step("python", function="no.such.function"),
        step("python", function="sluiceway.operators.filters.nothing"),
        step("python", function="plain"),
        step("unknown"),
        {"name": "s", "type": "filter", "inputs": ["a"], "condition": "true"},
    ],
)
def test_wrong_steps_are_reported_before_the_plan(wrong):
    with pytest.raises(StepError):
        prepare(wrong)


def test_python_failures(spark, people):
    with pytest.raises(StepError, match="not a DataFrame"):
        apply_step(spark, {"people": people}, step("python", function=lambda df: 1))
    with pytest.raises(StepError, match="division"):
        apply_step(spark, {"people": people}, step("python", function=lambda df: 1 / 0))
    with pytest.raises(StepError, match="no frame"):
        apply_step(spark, {}, step("filter", condition="true"))


def test_chain_keeps_every_frame(spark, people, jobs):
    wanted = [
        {"name": "1", "type": "filter", "inputs": ["people"], "output": "rich", "condition": "salary > 50000"},
        {"name": "2", "type": "sql", "inputs": ["rich"], "output": "names", "sql": "SELECT id, name FROM rich"},
    ]
    frames = {}
    assert jobs(lambda: frames.update(chain(spark, {"people": people}, wanted))) == 0
    assert frames["rich"].count() == 4 and frames["names"].columns == ["id", "name"]


def test_registry(spark, people):
    before = dict(steps._TYPES)
    try:
        steps.register_step("first_rows", lambda s: lambda spark, frames: frames[s["inputs"][0]].limit(s["rows"]))
        assert "first_rows" in steps.step_types()
        assert apply_step(spark, {"people": people}, step("first_rows", rows=2)).count() == 2
        steps.clear_steps()
        assert steps.step_types() == []
    finally:
        steps._TYPES.update(before)
    assert {"sql", "python", "filter", "join", "aggregate"} <= set(steps.step_types())


def test_threshold_words(spark):
    frame = spark.createDataFrame([(v,) for v in (50, 150, 300, 600, 1000)], ["value"])
    assert [by_threshold(frame, "value", t).count() for t in (0, 100, 500)] == [5, 4, 2]
    assert by_threshold(frame, "value", 300, "whatever").count() == 1


def test_scalar_functions(spark):
    row = spark.sql(
        "SELECT 0 AS none, 4 AS some, 3 AS part, 12 AS purchases, 1200.5 AS revenue, '2024-01-01' AS start,"
        " date'2024-02-01' AS end, timestamp_ntz'2024-01-07 10:00:00.9' AS a, timestamp_ntz'2024-01-07 10:01:30.1' AS b"
    )
    found = row.select(
        columns.ratio(F.col("part"), F.col("none")).alias("no_ratio"),
        columns.ratio(F.col("part"), F.col("some")).alias("ratio"),
        columns.percent(F.col("part"), F.col("none")).alias("no_percent"),
        columns.percent(F.lit(1), F.lit(3)).alias("percent"),
        columns.customer_class().alias("class"),
        columns.days_between("start", "end").alias("days"),
        columns.minutes_between("a", "b").alias("minutes"),
        columns.dollars(F.lit(1234.5)).alias("price"),
        F.dayofweek("a").alias("weekday"),
    ).first()
    assert found.asDict() == {
        "no_ratio": 0.0,
        "ratio": 0.75,
        "no_percent": 0.0,
        "percent": 33.33,
        "class": "VIP",
        "days": 31,
        "minutes": 1.5,
        "price": "$1234.50",
        "weekday": 1,
    }


def test_scores(spark):
    frame = spark.createDataFrame([(10, 5, 2), (20, 10, 1)], ["page_views", "clicks", "purchases"])
    from sluiceway.plans.user_engagement import SCORE

    assert [row[0] for row in frame.select(columns.weighted(SCORE)).collect()] == [40, 50]


@pytest.mark.parametrize(("purchases", "revenue", "name"), [(11, 1001, "VIP"), (11, 10, "Active"), (0, 501, "Active"), (5, 500, "Casual")])
def test_customer_classes(spark, purchases, revenue, name):
    frame = spark.createDataFrame([(purchases, revenue)], ["purchases", "revenue"])
    assert frame.select(columns.customer_class()).first()[0] == name


def test_runs_in_threads_see_their_own_names(spark):
    """Each thread names its frame alike and must get its own."""
    from concurrent.futures import ThreadPoolExecutor

    def counted(n):
        step = {"name": "s", "type": "sql", "inputs": ["t"], "output": "o", "sql": "SELECT count(*) AS n FROM t"}
        return [apply_step(spark, {"t": spark.range(n)}, step).first()["n"] for _ in range(5)]

    with ThreadPoolExecutor(6) as threads:
        assert list(threads.map(counted, range(6))) == [[n] * 5 for n in range(6)]
    assert not spark.catalog.tableExists("t")
