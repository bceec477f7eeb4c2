"""Data-quality rules and row expectations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from sluiceway import entities as e
from sluiceway.plans import user_engagement
from sluiceway.quality.expectations import keep_valid, set_aside
from sluiceway.quality.suite import report_frame


def daily(spark, folder):
    return user_engagement.user_daily(e.user_events(spark, folder), e.user_profiles(spark, folder))


def verdict(name: str, kind: str, rows: str, violations: str, observed: str, passed: str, source: str) -> str:
    """SQL of one report row; rules of zero tolerance observe their violations."""
    return (
        f"SELECT '{name}' AS rule, '{kind}' AS type, {rows} AS rows, {violations} AS violations, "
        f"round(CAST({observed} AS DOUBLE), 4) AS observed, {passed} AS passed FROM {source}"
    )


def strict(name: str, kind: str, violated: str, rows: str, source: str) -> str:
    found = f"count(*) FILTER (WHERE {violated})"
    return verdict(name, kind, rows, found, found, f"{found} = 0", source)


def nulls(name: str, column: str, threshold: float, source: str) -> str:
    found = f"(count(*) - count({column}))"
    share = f"{found} * 100.0 / count(*)"
    return verdict(name, "null_check", "count(*)", found, share, f"{share} <= {threshold}", source)


def report(df, rules):
    return report_frame(df, rules).withColumn("observed", F.round("observed", 4))


@query(
    "q1_null_check",
    nulls("few_products_missing", "product_id", 50, "user_events")
    + " UNION ALL "
    + nulls("no_revenue_missing", "revenue", 0, "user_events"),
    ["user_events"],
)
def null_check(spark, folder):
    rules = [
        {"name": "few_products_missing", "type": "null_check", "column": "product_id", "threshold": 50},
        {"name": "no_revenue_missing", "type": "null_check", "column": "revenue"},
    ]
    return report(e.user_events(spark, folder), rules)


@query(
    "q2_range_check",
    " UNION ALL ".join(
        [
            strict("both", "range_check", "revenue < 10 OR revenue > 90", "count(revenue)", "user_events"),
            strict("low", "range_check", "revenue < 0", "count(revenue)", "user_events"),
            strict("high", "range_check", "product_id > 98", "count(product_id)", "user_events"),
        ]
    ),
    ["user_events"],
)
def range_check(spark, folder):
    rules = [
        {"name": "both", "type": "range_check", "column": "revenue", "min_value": 10, "max_value": 90},
        {"name": "low", "type": "range_check", "column": "revenue", "min_value": 0},
        {"name": "high", "type": "range_check", "column": "product_id", "max_value": 98},
    ]
    return report(e.user_events(spark, folder), rules)


@query(
    "q3_row_count",
    " UNION ALL ".join(
        verdict(name, "row_count", "count(*)", f"CASE WHEN {test} THEN 0 ELSE 1 END", "count(*)", test, "orders")
        for name, test in [("enough", "count(*) >= 1"), ("few", "count(*) BETWEEN 1 AND 10")]
    ),
)
def row_count(spark, folder):
    rules = [
        {"name": "enough", "type": "row_count", "min_count": 1},
        {"name": "few", "type": "row_count", "min_count": 1, "max_count": 10},
    ]
    return report(e.table(spark, folder, "orders"), rules)


@query(
    "q4_suite",
    " UNION ALL ".join(
        [
            nulls("check_user_id_not_null", "user_id", 0, "user_daily"),
            strict("check_positive_events", "range_check", "total_events < 1", "count(total_events)", "user_daily"),
            strict(
                "check_engagement_score_range",
                "range_check",
                "engagement_score < 0 OR engagement_score > 100000",
                "count(engagement_score)",
                "user_daily",
            ),
            verdict("check_minimum_records", "row_count", "count(*)", "0", "count(*)", "count(*) >= 1", "user_daily"),
            "SELECT 'no_such_column', 'null_check', NULL, NULL, NULL, false",
        ]
    ),
    ["user_daily"],
)
def suite(spark, folder):
    """All rules in one pass; the rule on a missing column fails without harm to the others."""
    broken = {"name": "no_such_column", "type": "null_check", "column": "nowhere"}
    return report(daily(spark, folder), [*user_engagement.RULES, broken])


EXPECTED = [
    {"name": "product_known", "type": "null_check", "column": "product_id"},
    {"name": "product_listed", "type": "range_check", "column": "product_id", "min_value": 10, "max_value": 79},
    {"name": "paid", "type": "range_check", "column": "revenue", "min_value": 5},
    {"name": "any", "type": "row_count", "min_count": 1},
]


@query(
    "q8_keep_valid",
    """
    SELECT event_id, event_type, product_id, revenue FROM user_events
    WHERE product_id IS NOT NULL AND product_id BETWEEN 10 AND 79 AND (revenue IS NULL OR revenue >= 5)
    """,
    ["user_events"],
)
def keep(spark, folder):
    events = e.user_events(spark, folder).select("event_id", "event_type", "product_id", "revenue")
    return keep_valid(events, EXPECTED)


@query(
    "q8_set_aside",
    """
    SELECT * FROM (
        SELECT event_id, product_id, revenue,
               concat_ws(',', CASE WHEN product_id IS NULL THEN 'product_known' END,
                              CASE WHEN product_id < 10 OR product_id > 79 THEN 'product_listed' END,
                              CASE WHEN revenue < 5 THEN 'paid' END) AS failed_rules
        FROM user_events)
    WHERE failed_rules <> ''
    """,
    ["user_events"],
)
def rejected(spark, folder):
    events = e.user_events(spark, folder).select("event_id", "product_id", "revenue")
    return set_aside(events, EXPECTED).withColumn("failed_rules", F.array_join("failed_rules", ","))


@query(
    "q9_allowed_values",
    strict("segments", "allowed_values", "segment NOT IN ('BUILDING', 'MACHINERY')", "count(segment)", "user_profiles"),
    ["user_profiles"],
)
def allowed_values(spark, folder):
    rule = {"name": "segments", "type": "allowed_values", "column": "segment", "values": ["BUILDING", "MACHINERY"]}
    return report(e.user_profiles(spark, folder), [rule])


@query(
    "q10_no_future_dates",
    " UNION ALL ".join(
        strict(name, "not_after", f"\"date\" > DATE '{day}'", 'count("date")', "user_daily")
        for name, day in [("past", "2024-12-31"), ("first_half", "2024-01-15")]
    ),
    ["user_daily"],
)
def no_future_dates(spark, folder):
    rules = [
        {"name": "past", "type": "not_after", "column": "date", "as_of": "2024-12-31"},
        {"name": "first_half", "type": "not_after", "column": "date", "as_of": "2024-01-15"},
    ]
    return report(daily(spark, folder), rules)


@query(
    "q11_session_duration",
    strict(
        "day_long",
        "range_check",
        "session_duration_minutes < 0 OR session_duration_minutes > 1440",
        "count(session_duration_minutes)",
        "user_daily",
    ),
    ["user_daily"],
)
def session_duration(spark, folder):
    rule = {"name": "day_long", "type": "range_check", "column": "session_duration_minutes"}
    return report(daily(spark, folder), [{**rule, "min_value": 0, "max_value": 1440}])


@query(
    "q12_id_consistency",
    strict("ids", "positive_id", "user_id IS NULL OR user_id <= 0", "count(*)", "user_daily"),
    ["user_daily"],
)
def id_consistency(spark, folder):
    """The test tables count users from 0, so this rule finds violations."""
    return report(daily(spark, folder), [{"name": "ids", "type": "positive_id", "column": "user_id"}])


@query(
    "q13_score_formula",
    " UNION ALL ".join(
        [
            strict("as_defined", "formula", "engagement_score <> page_views + 2 * clicks + 10 * purchases",
                   "count(engagement_score)", "user_daily"),
            strict("other", "formula", "engagement_score <> page_views + clicks", "count(engagement_score)", "user_daily"),
        ]
    ),
    ["user_daily"],
)
def score_formula(spark, folder):
    rule = {"type": "formula", "column": "engagement_score"}
    rules = [
        {**rule, "name": "as_defined", "expression": "page_views + 2 * clicks + 10 * purchases"},
        {**rule, "name": "other", "expression": "page_views + clicks"},
    ]
    return report(daily(spark, folder), rules)


@query(
    "q14_revenue_not_negative",
    strict("paid", "range_check", "total_revenue < 0", "count(total_revenue)", "user_daily"),
    ["user_daily"],
)
def revenue_not_negative(spark, folder):
    rule = {"name": "paid", "type": "range_check", "column": "total_revenue", "min_value": 0}
    return report(daily(spark, folder), [rule])
