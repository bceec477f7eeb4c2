import random
from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluiceway import storage
from sluiceway.operators import aggregates, filters, joins, partitioning, ranking
from sluiceway.plans import product_performance, segment_performance, user_engagement


def rows(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture
def sides(spark):
    """One key holds a third of the rows on both sides, and some keys are null."""
    rng = random.Random(7)

    def make(n):
        return [(rng.choice([None, 0, 0, 0, *range(1, 8)]), i) for i in range(n)]

    return spark.createDataFrame(make(60), "k int, a int"), spark.createDataFrame(make(50), "k int, b int")


def test_split_outer_is_the_outer_join(sides):
    left, right = sides
    assert rows(joins.split_outer(left, right, "k")) == rows(left.join(right, "k", "outer").select("k", "a", "b"))


def test_split_outer_on_two_keys_and_empty_sides(sides):
    left, right = (side.withColumn("j", F.col("k") % 2) for side in sides)
    wanted = left.join(right, ["k", "j"], "outer").select("k", "j", "a", "b")
    assert rows(joins.split_outer(left, right, ["k", "j"])) == rows(wanted)
    empty = right.limit(0)
    assert joins.split_outer(left, empty, ["k", "j"]).count() == 60
    assert joins.split_outer(empty, left, ["k", "j"]).count() == 60


@pytest.mark.parametrize("how", ["inner", "left", "left_outer", "right", "rightouter", "outer", "full", "full_outer", "fullouter"])
@pytest.mark.parametrize("split", [False, True])
def test_join_words(sides, how, split):
    left, right = sides
    wanted = left.join(right, "k", how).select("k", "a", "b")
    assert rows(joins.join(left, right, "k", how, split).select("k", "a", "b")) == rows(wanted)


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "semi", "anti", "leftanti"])
def test_reduced_semi_and_anti_joins(sides, how):
    left, right = sides
    assert rows(joins.join(left, right, "k", how)) == rows(left.join(right, "k", how))


def test_broadcast_only_within_the_bound(spark):
    small, large = spark.range(10), spark.range(11)
    assert "ResolvedHint" in joins.broadcast_if_small(small, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in joins.broadcast_if_small(large, 10)._jdf.queryExecution().analyzed().toString()


def brute_cross(left, right, k):
    sums, users, counts = defaultdict(list), defaultdict(set), Counter(c for c, in right)
    for group, user, amount in left:
        sums[group].append(amount)
        users[group].add(user)
    pairs = []
    for group in sums:
        for category, times in counts.items():
            known = [a for a in sums[group] if a is not None]
            pairs.append((group, category, len(users[group]), sum(known) * times if known else None))
    first = lambda name: (name is not None, name or "")
    pairs.sort(key=lambda p: (p[3] is None, -(p[3] or 0), first(p[0]), first(p[1])))
    return pairs[:k]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("k", [1, 4, 15, 400])
def test_top_cross_totals(spark, seed, k):
    rng = random.Random(seed)
    amounts = [[5, 7, 0], [-3, -8, -1], [0, 0, 0], [None, None, None], [4, -4, None], [9, 1, 2]]
    left = [
        (f"s{rng.randrange(9)}", rng.randrange(20), rng.choice(amounts[rng.randrange(6) if seed % 2 else seed % 6]))
        for _ in range(60)
    ]
    right = [(rng.choice([None, *"abcdefghijkl"]),) for _ in range(80)]
    found = joins.top_cross_totals(
        spark.createDataFrame(left, "segment string, user_id int, paid int"),
        spark.createDataFrame(right, "category string"),
        "segment",
        "category",
        "user_id",
        "paid",
        k,
    )
    assert [tuple(row) for row in found.collect()] == brute_cross(left, right, k)


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.75, 1.0])
def test_exact_percentile(spark, fraction):
    rng = random.Random(3)
    data = [("hot", rng.choice([rng.gauss(0, 1), 0.25])) for _ in range(5_000)]
    data += [(f"k{rng.randrange(30)}", rng.uniform(-5, 5)) for _ in range(400)] + [(None, 4.0), (None, 5.0), ("one", 1.0), ("one", None)]
    frame = spark.createDataFrame(data, "k string, v double").repartition(6)
    wanted = dict(frame.groupBy("k").agg(F.percentile("v", fraction)).collect())
    for accuracy in (100_000, 200):
        found = dict(aggregates.exact_percentile(frame, ["k"], "v", fraction, "p", accuracy).collect())
        assert found.keys() == wanted.keys()
        assert all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)


@pytest.mark.parametrize("fraction", [0.0, 0.3, 0.5, 1.0])
def test_exact_percentile_of_crowded_brackets(spark, fraction):
    """A coarse sketch and a small bound, so that rank selection is repeated; ties at both ends of a bracket stay whole."""
    rng = random.Random(4)
    data = [("hot", rng.choice([rng.gauss(0, 1), 0.25, -0.25])) for _ in range(6_000)] + [("b", float(i)) for i in range(3_000)]
    data += [("two", float(i % 2)) for i in range(2_000)] + [(None, rng.random()) for _ in range(900)] + [("one", 7.0)]
    frame = spark.createDataFrame(data, "k string, v double").repartition(5)
    wanted = dict(frame.groupBy("k").agg(F.percentile("v", fraction)).collect())
    found = dict(aggregates.exact_percentile(frame, ["k"], "v", fraction, "p", accuracy=20, within=15).collect())
    assert found.keys() == wanted.keys()
    assert all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)
    left = aggregates._around_rank(frame, ["k"], "v", fraction, accuracy=20, within=15)
    assert left.groupBy("k").agg(F.count("_v").alias("n")).agg(F.max("n")).first()[0] <= 15


def test_percentile_of_one_key_of_five_million_values(spark):
    """No task sorts more than a thousand of them."""
    frame = spark.range(5_000_000).select(F.lit(1).alias("k"), (F.xxhash64("id") / 2**40).alias("v"))
    left = aggregates._around_rank(frame, ["k"], "v", 0.5, 1_000, 1_000)
    assert left.count() <= 1_001
    found = aggregates.exact_percentile(frame, ["k"], "v", 0.5, "p", 1_000, 1_000).first()["p"]
    below, upto = frame.agg(F.count_if(F.col("v") < found), F.count_if(F.col("v") <= found)).first()
    assert below <= 2_500_000 <= upto


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_totals_run_their_plan_once(spark, threshold):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = spark.range(1_000).selectExpr("id % 7 AS k", "CAST(id AS double) AS v").mapInPandas(count, "k bigint, v double")
    sums = rows.groupBy("k").agg(F.sum("v").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        shares = aggregates.with_share_of_total(sums, "v", "share", 6).collect()
        assert read.value == 1_000 and abs(sum(r.share for r in shares) - 100) < 1e-4
        totals = aggregates.with_column_total(sums, "v", "total").collect()
        assert read.value == 2_000 and {r.total for r in totals} == {499_500.0}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_collect_values_are_slices(spark):
    data = [("hot", i, i % 7) for i in range(1_000)] + [("cold", i, i) for i in range(3)] + [(None, 1, 5), ("cold", 9, None)]
    frame = spark.createDataFrame(data, "k string, id int, v int")
    found = aggregates.collect_values(frame, ["k"], "v", "id", 100).collect()
    chunks = {(row.k, row.chunk): row["items"] for row in found}
    hot = sorted(i % 7 for i in range(1_000))
    assert chunks == {**{("hot", n): hot[100 * n : 100 * n + 100] for n in range(10)}, ("cold", 0): [0, 1, 2], (None, 0): [5]}


def test_numbering_by_ranges_is_the_plain_numbering(spark):
    rng = random.Random(5)
    data = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.choice([None, *range(40)]), i) for i in range(900)]
    frame = spark.createDataFrame(data, "k string, t int, id int")
    texts = F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd HH:mm:ss")
    for column in (F.col("t"), F.timestamp_seconds("t"), F.lit(1), texts):
        timed = frame.withColumn("t", column)
        plain = ranking.number_newest_first(timed, ["k"], "t", "id", "n")
        ranged = ranking.number_newest_first(timed, ["k"], "t", "id", "n", rows_per_task=100)
        assert rows(plain.select("id", "n")) == rows(ranged.select("id", "n")) and ranged.columns == plain.columns


def test_numbering_cuts_equal_times_and_texts(spark, monkeypatch):
    kept = []
    stored = storage.stored
    monkeypatch.setattr(ranking.storage, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    frame = spark.range(20_000).withColumn("k", F.when(F.col("id") < 19_000, "hot").otherwise(F.col("id").cast("string")))
    same_day = frame.withColumn("t", F.lit("2024-05-01T00:00:00"))
    ranking.number_newest_first(same_day, ["k"], "t", "id", "n", rows_per_task=1_000)
    sizes = [row["count"] for row in kept[1].groupBy("_range").count().collect()]
    assert sum(sizes) == 19_000 and len(sizes) == 19 and max(sizes) < 2_500


def test_gathered_and_reused_frames(spark):
    frame = spark.range(1_000).withColumn("k", F.col("id") % 4)
    assert partitioning.gathered(frame, "k", partitions=3).rdd.getNumPartitions() == 3
    placed = partitioning.gathered(frame, "k").withColumn("place", F.spark_partition_id())
    assert placed.select("k", "place").distinct().count() == 4
    kept = partitioning.reused(frame)
    assert kept.storageLevel.useMemory and kept.storageLevel.useDisk and kept.count() == 1_000
    kept.unpersist()


def test_latest(spark):
    frame = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, 5, "d"), (None, 1, "e")], "k int, t int, v string")
    found = ranking.latest(frame, ["k"], [F.desc("t"), F.desc("v")])
    assert {row.v for row in found.collect()} == {"c", "d", "e"} and found.columns == ["k", "t", "v"]


def test_share_of_total(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    assert rows(aggregates.with_share_of_total(frame, "v", "share").select("k", "share")) == {("a", 25.0): 1, ("b", 75.0): 1}


def test_pivot_has_null_for_absent_values(spark):
    frame = spark.createDataFrame([("u", "x"), ("u", "x"), ("u", "other")], "k string, c string")
    assert aggregates.pivot_counts(frame, ["k"], "c", ["x", "y"]).collect() == [("u", 2, None)]


def test_samples(spark):
    frame = spark.range(20_000).withColumn("user", F.col("id") % 2_000)
    keyed = filters.sample(frame, 0.1, "user")
    assert 140 < keyed.select("user").distinct().count() < 260
    assert keyed.count() == 10 * keyed.select("user").distinct().count()
    assert rows(keyed) == rows(filters.sample(frame.repartition(7), 0.1, "user"))
    assert filters.sample(frame, 1.0, "user").count() == 20_000 and filters.sample(frame, 0.0, "user").count() == 0
    assert 1_700 < filters.sample(frame, 0.1).count() < 2_300


def events_of(spark, data):
    schema = "user_id int, event_type string, product_id int, timestamp timestamp_ntz, revenue double"
    texts = "user_id int, event_type string, product_id int, timestamp string, revenue double"
    frame = spark.createDataFrame(data, texts)
    return frame.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).to(spark.createDataFrame([], schema).schema)


def test_daily_metrics(spark):
    events = events_of(
        spark,
        [
            (1, "page_view", None, "2024-01-01 10:00:00.9", None),
            (1, "purchase", 5, "2024-01-01 10:30:00.1", 20.5),
            (1, "purchase", 5, "2024-01-01 10:10:00", None),
            (1, None, None, "2024-01-02 00:00:00", None),
        ],
    )
    days = {str(row.date): row for row in user_engagement.daily_metrics(events, revenue=True).collect()}
    first, second = days["2024-01-01"], days["2024-01-02"]
    assert (first.total_events, first.unique_event_types, first.page_views, first.clicks, first.purchases) == (3, 2, 1, 0, 2)
    assert first.total_revenue == 20.5 and first.session_duration_minutes == 30.0
    assert (second.total_events, second.unique_event_types, second.total_revenue) == (1, 0, 0.0)
    assert user_engagement.daily_metrics(events.limit(0)).count() == 0


def test_products_without_events_and_listed_twice(spark):
    products = spark.createDataFrame(
        [(1, "a", "x", 1.0), (2, "b", "x", 2.0), (2, "b", "x", 2.0), (3, "c", "y", 3.0)],
        "product_id int, product_name string, category string, price double",
    )
    events = events_of(
        spark,
        [(7, "click", 2, "2024-01-01 00:00:00", None), (8, "click", 2, "2024-01-01 00:00:00", None),
         (8, "add_to_cart", 2, "2024-01-01 00:00:00", None), (9, "click", None, "2024-01-01 00:00:00", None)],
    )
    sales = spark.createDataFrame(
        [(2, 3.0, 30.0, "completed"), (2, 9.0, 90.0, "pending"), (3, 1.0, 5.0, "completed")],
        "product_id int, quantity double, total_amount double, status string",
    )
    found = {row.product_id: row for row in product_performance.product_performance(products, events, sales).collect()}
    twice = found[2]
    assert len(found) == 3
    assert (twice.unique_viewers, twice.clicks, twice.add_to_carts, twice.total_quantity_sold) == (2, 4, 2, 3.0)
    assert (twice.click_to_cart_rate, twice.cart_to_purchase_rate, twice.avg_revenue_per_unit) == (50.0, 50.0, 10.0)
    assert (found[1].clicks, found[1].total_revenue, found[1].click_to_cart_rate) == (0, 0.0, 0.0)
    assert (found[3].cart_to_purchase_rate, found[3].avg_revenue_per_unit) == (0.0, 5.0)


def test_segments_count_users_without_activity(spark):
    users = spark.createDataFrame(
        [(1, "a", "free", "US", 20), (2, "b", "free", "US", 30)], "user_id int, name string, segment string, country string, age int"
    )
    events = events_of(spark, [(1, "purchase", 5, "2024-01-01 00:00:00", 10.0), (1, "click", 5, "2024-01-02 00:00:00", None)])
    sales = spark.createDataFrame([(1, 200.0, "completed"), (1, 99.0, "pending")], "user_id int, total_amount double, status string")
    row = segment_performance.segment_performance(users, events, sales).first()
    assert (row.total_users, row.total_events, row.avg_events_per_user, row.total_active_days) == (2, 2, 1.0, 2)
    assert (row.total_revenue, row.avg_revenue_per_user, row.avg_transaction_value) == (200.0, 100.0, 100.0)
    assert row.engagement_score == round(1.0 * 0.3 + 0.5 * 0.4 + 100.0 * 0.3 / 100, 2)


def test_missed_percentile_bracket_is_an_error(spark, monkeypatch):
    frame = spark.range(1_000).select(F.lit("k").alias("k"), F.rand(1).alias("v"))
    outside = F.first(F.array(F.lit(2.0), F.lit(3.0)))
    monkeypatch.setattr(aggregates.F, "percentile_approx", lambda *arguments: outside)
    with pytest.raises(PySparkException, match="missed"):
        aggregates.exact_percentile(frame, ["k"], "v", 0.5, "p", accuracy=100).collect()


def test_sketches_of_parts_merge(spark):
    frame = spark.range(60_000).selectExpr("id % 3 AS k", "id % 10 AS part", "CAST(pmod(xxhash64(id), 5000) AS double) AS v")
    frame = frame.unionByName(spark.sql("SELECT 9L AS k, 0L AS part, CAST(NULL AS double) AS v"))
    sketches = aggregates.quantile_sketches(frame, ["k", "part"], "v")
    assert sketches.count() == 30
    for fraction in (0.0, 0.25, 0.5, 1.0):
        answers = aggregates.sketched_quantile(sketches, ["k"], fraction, "q")
        checked = aggregates.with_rank_check(frame, answers, ["k"], "v", "q", fraction).collect()
        assert {(r.k, r.rows, r.within_bound) for r in checked} == {(k, 20_000, True) for k in range(3)}
    wrong = answers.withColumn("q", F.lit(100.0))
    assert not any(r.within_bound for r in aggregates.with_rank_check(frame, wrong, ["k"], "v", "q", 0.5).collect())


def test_sample_of_a_size(spark):
    frame = spark.range(3_000).selectExpr("if(id % 100 = 0, NULL, id % 200) AS k", "id")
    small, large = (filters.sample_of_size(frame, n, "k") for n in (7, 20))
    keys = {r.k for r in small.collect()}
    assert len(keys) == 7 and None not in keys and keys < {r.k for r in large.collect()}
    assert small.count() == frame.where(F.col("k").isin(list(keys))).count()
    assert filters.sample_of_size(frame, 500, "k").count() == 2_970
    assert {r.k for r in filters.sample_of_size(frame, 7, "k", seed=1).collect()} != keys


def test_stored_frames_are_removed(spark):
    storage.remove_stored(spark)
    frame = storage.stored(spark.range(3))
    path = frame.inputFiles()[0].rpartition("/")[0]
    assert storage.exists(spark, path)
    assert storage.remove_stored(spark) == 1 and not storage.exists(spark, path) and storage.remove_stored(spark) == 0


def test_many_ranges_are_sampled_by_few_rows_each(spark, monkeypatch):
    """What the driver samples for ranges grows by few rows a range, and the numbers stay the plain ones."""
    sampled = []
    stored = storage.stored
    monkeypatch.setattr(ranking.storage, "stored", lambda df: sampled.append(spark.conf.get(ranking.SAMPLE_SETTING)) or stored(df))
    before = spark.conf.get(ranking.SAMPLE_SETTING)
    monkeypatch.setattr(ranking, "SAMPLED", 400)
    frame = spark.range(4_000).select("id", F.lit("hot").alias("k"), (F.col("id") * 7 % 4_000).alias("t"))
    found = ranking.number_newest_first(frame, ["k"], "t", "id", "n", rows_per_task=100)
    assert found.where("n = 4000 - t").count() == 4_000
    assert sampled == [before, "10"] and spark.conf.get(ranking.SAMPLE_SETTING) == before
