"""Deterministic test-data generators: rows follow from a counter column, so any partition can be redone alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the scrambler: a prime and two multipliers that keep products inside 64 bits.
PRIME, FIRST, SECOND = 2147483647, 48271, 69621


def scramble(key: Column, salt: int = 0) -> Column:
    """A repeatable number in [0, PRIME) that stands in for random(); arithmetic only, so SQL twins can repeat it."""
    return ((key % PRIME + salt) * FIRST % PRIME) * SECOND % PRIME


def sql_scramble(key: str, salt: int = 0) -> str:
    return f"((({key} % {PRIME} + {salt}) * {FIRST} % {PRIME}) * {SECOND} % {PRIME})"


def chance(key: Column, salt: int, percent: int) -> Column:
    return scramble(key, salt) % 100 < percent


def sql_chance(key: str, salt: int, percent: int) -> str:
    return f"{sql_scramble(key, salt)} % 100 < {percent}"


def series(spark: SparkSession, first: int, last: int) -> DataFrame:
    """generate_series(first, last) as the column ``g``."""
    return spark.range(first, last + 1).withColumnRenamed("id", "g")


def days(bounds: DataFrame, low: Column, high: Column) -> DataFrame:
    """Every day between two computed bounds, as the column ``day``."""
    return bounds.select(F.explode(F.sequence(low.cast("date"), high.cast("date"), F.expr("interval 1 day"))).alias("day"))


def pick(values: Sequence[str], position: Column) -> Column:
    """Zero-based pick from a constant array."""
    return F.element_at(F.array(*[F.lit(item) for item in values]), (position % len(values) + 1).cast("int"))


def skewed_position(key: Column, count: Column, percent: int = 70, tenth: int = 10) -> Column:
    """A position in [0, count): ``percent`` of the keys fall on the first tenth of the positions."""
    few = F.greatest(F.lit(1), F.floor(count / tenth))
    return F.when(chance(key, 1, percent), scramble(key, 2) % few).otherwise(scramble(key, 3) % count)


def cents(g: Column, step: int, modulo: int) -> Column:
    return (((g * step) % modulo).cast("decimal(18,0)") / 100).cast("decimal(10,2)")


def moment(start: str, day: Column, second: Column) -> Column:
    """A timestamp so many days and seconds after ``start``."""
    return F.timestamp_add("SECOND", second, F.timestamp_add("DAY", day, F.lit(start).cast("timestamp_ntz")))


def store_checks(counter: DataFrame) -> DataFrame:
    """Shop receipts from the counter column ``g``."""
    # Fixed values here and in club_members and club_visits: the steps, moduli, codes and start times.
    g = F.col("g")
    kind = F.when(g % 8 == 0, "cash").when(g % 3 == 0, "card").otherwise("qr")
    return counter.select(
        g.alias("id"),
        (g * 23 % 800 + 1).cast("int").alias("shop_id"),
        kind.alias("payment_type"),
        cents(g, 41, 250000).alias("total_sum"),
        moment("2025-01-01 00:00:00", g % 75, g * 19 % 86400).alias("sold_at"),
        F.concat(F.lit("check-"), g.cast("string")).alias("cashier_note"),
    )


# Receipts planted among the generated ones, of which three lie inside the searched day.
PLANTED_CHECKS = [
    (77, "card", "450.30", "2025-02-14 08:10:00", "target-1"),
    (77, "cash", "180.00", "2025-02-14 11:45:00", "target-2"),
    (77, "qr", "990.90", "2025-02-14 18:20:00", "target-3"),
    (77, "card", "120.00", "2025-02-20 10:05:00", "outside-range"),
]


def planted_checks(spark: SparkSession, first_id: int) -> DataFrame:
    rows = spark.createDataFrame(
        [(first_id + i, *row) for i, row in enumerate(PLANTED_CHECKS)],
        "id bigint, shop_id int, payment_type string, total_sum string, sold_at string, cashier_note string",
    )
    return rows.withColumns(
        {"total_sum": F.col("total_sum").cast("decimal(10,2)"), "sold_at": F.col("sold_at").cast("timestamp_ntz")}
    )


def club_members(counter: DataFrame) -> DataFrame:
    g = F.col("g")
    return counter.select(
        g.alias("id"),
        F.concat(F.lit("Member "), g.cast("string")).alias("full_name"),
        F.when(g % 15 == 0, "premium").when(g % 4 == 0, "plus").otherwise("base").alias("member_level"),
        F.when(g % 8 == 0, "KZN").when(g % 5 == 0, "MSK").otherwise("NNV").alias("city_code"),
    )


def club_visits(counter: DataFrame, members: int = 22000) -> DataFrame:
    g = F.col("g")
    return counter.select(
        g.alias("id"),
        (g * 17 % members + 1).alias("member_id"),
        cents(g, 13, 150000).alias("spend"),
        F.when(g % 6 == 0, "gym").when(g % 5 == 0, "pool").otherwise("group").alias("visit_type"),
        moment("2025-01-01 00:00:00", g % 90, g * 43 % 86400).alias("visit_at"),
    )


# Fixed values per region: rows, days, first package count, package modulo, weight step, weight modulo.
SHIPMENTS = {
    "north": (900, 20, 10, 150, 9, 3000),
    "south": (900, 20, 20, 170, 11, 3500),
    "west": (900, 20, 15, 160, 7, 2800),
    "east": (120, 10, 30, 90, 5, 2200),
}


def shipments(spark: SparkSession) -> DataFrame:
    g = F.col("g")
    parts = [
        series(spark, 1, rows).select(
            F.lit(region).alias("region_code"),
            F.date_add(F.lit("2025-02-01").cast("date"), (g % span).cast("int")).alias("shipped_on"),
            (g % modulo + first).cast("int").alias("packages"),
            cents(g, step, weights).cast("decimal(8,2)").alias("avg_weight"),
        )
        for region, (rows, span, first, modulo, step, weights) in SHIPMENTS.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


CITIES = ("Lisbon", "Oslo", "Quito", "Hanoi", "Perth")


def trips(counter: DataFrame, as_of: str) -> DataFrame:
    """Taxi trips of the 30 days before ``as_of``, from the zero-based counter column ``g``."""
    g = F.col("g")
    started = F.timestamp_add("SECOND", -(scramble(g, 11) % 2592000), F.lit(as_of).cast("timestamp_ntz"))
    lasted = scramble(g, 12) % 7200
    return counter.select(
        (g + 1).alias("trip_id"),
        started.alias("start_time"),
        F.timestamp_add("SECOND", lasted, started).alias("end_time"),
        ((scramble(g, 13) % 4901 + 100).cast("decimal(10,0)") / 100).cast("decimal(10,2)").alias("distance_km"),
        pick(CITIES, scramble(g, 14)).alias("city"),
    )


def test_ads(sellers: DataFrame, seller: str, count: int) -> DataFrame:
    """``count`` numbered ads for every seller, with the vehicle each of them offers."""
    n = F.col("n")
    numbered = sellers.select(F.col(seller).alias("seller_id"), F.explode(F.sequence(F.lit(1), F.lit(count))).alias("n"))
    return numbered.select(
        "seller_id",
        "n",
        (n + 2020).alias("year_of_manufacture"),
        F.concat(F.lit("TEST"), F.lpad(n.cast("string"), 13, "0")).alias("vin"),
        F.concat(F.lit("Test ad #"), n.cast("string")).alias("header_text"),
        (n * 100000 + 1000000).alias("price"),
    )
