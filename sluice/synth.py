"""Made-up rows for trials of a job: the benchmark file and the change feed.

Every value is drawn from the row's id and a seed by whole-number arithmetic alone, so a task that
runs again after a lost executor makes the same rows again, and any SQL engine can state them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the generated rows.
START = "2025-01-01 00:00:00"
STATUSES = ("delivered", "pending", "shipped")

#: Draws are whole numbers below this prime; no product of two of them leaves 63 bits.
PRIME = 2**31 - 1
#: Multipliers of the rounds, and what a seed adds.
ROUNDS = (48271, 69621, 40692)
STEP = 44485709


def draw(seed: int) -> Column:
    """A whole number in [0, PRIME) that depends on id and seed alone.

    Two linear and two squaring rounds over the id's low and high part: neighbouring ids and seeds
    give unlike numbers. ``draw_sql`` states the same in SQL.
    """
    number = F.col("id").cast("bigint")
    low = F.pmod(number, F.lit(PRIME))
    high = F.pmod((number - low) / F.lit(PRIME), F.lit(PRIME)).cast("bigint")
    a = (low * ROUNDS[0] + high * ROUNDS[2] + F.lit((seed + 1) * STEP)) % PRIME
    b = (a * a + low + F.lit(seed)) % PRIME
    c = (b * ROUNDS[1] + a) % PRIME
    return (c * c + b) % PRIME


def draw_sql(number: str, seed: int) -> str:
    """``draw`` as SQL over a column or expression that is not negative."""
    low, high = f"({number} % {PRIME})", f"(({number} // {PRIME}) % {PRIME})"
    a = f"(({low} * {ROUNDS[0]} + {high} * {ROUNDS[2]} + {(seed + 1) * STEP}) % {PRIME})"
    b = f"(({a} * {a} + {low} + {seed}) % {PRIME})"
    c = f"(({b} * {ROUNDS[1]} + {a}) % {PRIME})"
    return f"(({c} * {c} + {b}) % {PRIME})"


def _between(low: int, high: int, seed: int) -> Column:
    """A whole number from low to high, both included."""
    scaled = draw(seed) * (high - low + 1)
    return ((scaled - scaled % PRIME) / PRIME + low).cast("int")


def between_sql(low: int, high: int, number: str, seed: int) -> str:
    return f"CAST({draw_sql(number, seed)} * {high - low + 1} // {PRIME} + {low} AS INTEGER)"


def _cents(low: int, high: int, seed: int) -> Column:
    """An amount from low to high with two decimals."""
    return _between(low * 100, high * 100, seed) / F.lit(100.0)


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def benchmark_columns(ids: DataFrame, seed: int = 0) -> DataFrame:
    """Product rows for every ``id``: one second apart, 50 products, 10 categories."""
    moment = F.timestamp_add("SECOND", F.col("id"), F.lit(START).cast("timestamp_ntz"))
    return ids.select(
        "id",
        _text("Product_", F.pmod("id", F.lit(50))).alias("product"),
        (draw(seed) * 490 / F.lit(PRIME) + 10).alias("price"),
        _text("Category_", F.pmod("id", F.lit(10))).alias("category"),
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )


def benchmark_rows(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """The benchmark file of n rows, made in parallel."""
    return benchmark_columns(spark.range(n), seed)


def feed_users(ids: DataFrame, seed: int = 0) -> DataFrame:
    name = _text("User_", _between(1000, 9999, seed))
    email = F.concat(F.lower(name), F.lit("@example.com"))
    return ids.select("id", name.alias("name"), email.alias("email"))


def feed_orders(ids: DataFrame, updated_at: Column, seed: int = 0) -> DataFrame:
    known = F.array(*[F.lit(s) for s in STATUSES])
    status = F.element_at(known, _between(1, len(STATUSES), seed + 2))
    return ids.select(
        _between(10000, 99999, seed).cast("string").alias("order_id"),
        _cents(10, 1000, seed + 1).alias("amount"),
        status.alias("status"),
        updated_at.alias("updated_at"),
    )


def feed_products(ids: DataFrame, moment: Column, seed: int = 0) -> DataFrame:
    return ids.select(
        _between(1, 1000, seed).alias("id"),
        _text("Product_", _between(1, 50, seed + 1)).alias("product"),
        _between(10, 500, seed + 2).alias("price"),
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )


def stream_ids(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """An endless stream of ids and times for the feeds above."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select(F.col("value").alias("id"), "timestamp")
