"""Sample entities made from a column of ids.

Every value is arithmetic on the id, so rows are made where the ids are, a retried task makes the
same rows again, and any number of rows costs the driver nothing. ``spark.range(n)`` will do for ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Vocabularies of the sample entities.
EVENT_TYPES = ["page_view", "click", "search", "add_to_cart", "purchase"]
FIRST_NAMES = ["Alice", "Bob", "Charlie", "David", "Eve", "Frank", "Grace", "Henry", "Ivy", "Jack"]
LAST_NAMES = ["Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis", "Rodriguez", "Martinez"]
SEGMENTS = ["free", "premium", "enterprise"]
COUNTRIES = ["US", "UK", "CA", "AU", "DE", "FR", "JP", "BR", "IN", "MX"]
CATEGORIES = ["Electronics", "Clothing", "Books", "Home", "Sports", "Toys", "Food", "Beauty"]
ADJECTIVES = ["Premium", "Essential", "Deluxe", "Basic", "Pro", "Ultra", "Mini", "Mega"]
NOUNS = ["Widget", "Gadget", "Tool", "Kit", "Set", "Bundle", "Pack", "Collection"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay", "google_pay"]
STATUSES = ["completed", "pending", "cancelled", "refunded"]

# First day of the sample events and of the sign-ups.
FIRST_DAY = "2024-01-01"
FIRST_SIGNUP = "2023-01-01"

# A linear congruential step; both factors stay far below the range of a bigint.
FOLD = 1_000_003
MODULUS = 2_147_483_647
MULTIPLIER = 48_271
STRIDE = 7_919
# Ids beyond the first FOLD shift each stream by a step of its own, so that rows do not repeat.
SHIFT = 7_368_787
STEP = 104_729


def draw(id: Column, stream: int, n: int) -> Column:
    """Number from 0 to ``n - 1`` for an id; each stream number is a sequence of its own."""
    beyond = F.pmod(F.floor(id / F.lit(FOLD)).cast("bigint"), F.lit(FOLD)) * F.lit(SHIFT + stream * STEP)
    folded = F.pmod(F.pmod(id, F.lit(FOLD)) + F.lit(1 + stream * STRIDE) + beyond, F.lit(MODULUS))
    once = F.pmod(folded * MULTIPLIER, F.lit(MODULUS))
    twice = F.pmod(once * MULTIPLIER, F.lit(MODULUS))
    return F.pmod(F.floor(twice / 1024).cast("bigint"), F.lit(n))


def pick(words: list[str], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(word) for word in words]), (place + 1).cast("int"))


def _cents(id: Column, stream: int, low: int, high: int) -> Column:
    """Amount from ``low`` to ``high`` cents, as a double in whole units."""
    return (draw(id, stream, high - low + 1) + low) / 100


def sample_events(ids: DataFrame, id: str = "id", users: int = 100, products: int = 50, days: int = 30) -> DataFrame:
    """Events of five types; products only on three of them, revenue only on purchases."""
    key = F.col(id)
    seconds = draw(key, 3, days) * 86400 + draw(key, 4, 86400)
    return ids.select(
        key.alias("event_id"),
        (draw(key, 1, users) + 1).alias("user_id"),
        pick(EVENT_TYPES, draw(key, 2, len(EVENT_TYPES))).alias("event_type"),
        (F.lit(FIRST_DAY).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).alias("timestamp"),
        (draw(key, 5, products) + 1).alias("_product"),
        _cents(key, 6, 1000, 50000).alias("_revenue"),
    ).select(
        "event_id",
        "user_id",
        "event_type",
        F.when(F.col("event_type").isin("click", "add_to_cart", "purchase"), F.col("_product")).alias("product_id"),
        "timestamp",
        F.when(F.col("event_type") == "purchase", F.col("_revenue")).alias("revenue"),
    )


def sample_profiles(ids: DataFrame, id: str = "id", days: int = 731) -> DataFrame:
    """User profiles; the sign-up day is text, as in the files users bring along."""
    key = F.col(id)
    first = pick(FIRST_NAMES, draw(key, 11, len(FIRST_NAMES)))
    last = pick(LAST_NAMES, draw(key, 12, len(LAST_NAMES)))
    signup = F.date_add(F.lit(FIRST_SIGNUP).cast("date"), draw(key, 16, days).cast("int"))
    return ids.select(
        key.alias("user_id"),
        F.concat_ws(" ", first, last).alias("name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), key.cast("string"), F.lit("@example.com")).alias("email"),
        (draw(key, 13, 48) + 18).alias("age"),
        pick(SEGMENTS, draw(key, 14, len(SEGMENTS))).alias("segment"),
        pick(COUNTRIES, draw(key, 15, len(COUNTRIES))).alias("country"),
        F.date_format(signup, "yyyy-MM-dd").alias("signup_date"),
    )


def sample_products(ids: DataFrame, id: str = "id") -> DataFrame:
    key = F.col(id)
    words = [pick(ADJECTIVES, draw(key, 22, len(ADJECTIVES))), pick(NOUNS, draw(key, 23, len(NOUNS)))]
    return ids.select(
        key.alias("product_id"),
        F.concat_ws(" ", *words, key.cast("string")).alias("product_name"),
        pick(CATEGORIES, draw(key, 21, len(CATEGORIES))).alias("category"),
        _cents(key, 24, 999, 99999).alias("price"),
        draw(key, 25, 1001).alias("stock_quantity"),
        ((draw(key, 26, 21) + 30) / 10).alias("rating"),
    )


def sample_transactions(ids: DataFrame, id: str = "id", users: int = 100, products: int = 50, days: int = 30) -> DataFrame:
    """Transactions of which 95 in 100 are completed at once and the rest take any status."""
    key = F.col(id)
    quantity = draw(key, 33, 5) + 1
    cents = draw(key, 34, 99999 - 999 + 1) + 999
    seconds = draw(key, 38, days) * 86400 + draw(key, 39, 1440) * 60
    any_status = pick(STATUSES, draw(key, 37, len(STATUSES)))
    return ids.select(
        key.alias("transaction_id"),
        (draw(key, 31, users) + 1).alias("user_id"),
        (draw(key, 32, products) + 1).alias("product_id"),
        quantity.alias("quantity"),
        (cents / 100).alias("unit_price"),
        (cents * quantity / 100).alias("total_amount"),
        pick(PAYMENT_METHODS, draw(key, 35, len(PAYMENT_METHODS))).alias("payment_method"),
        F.when(draw(key, 36, 100) >= 95, any_status).otherwise(F.lit("completed")).alias("status"),
        (F.lit(FIRST_DAY).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).alias("transaction_date"),
    )
