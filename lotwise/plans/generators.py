"""Generators, driven by the keys and bounds of the given tables so that their output grows with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.plans.registry import query
from lotwise.sources import generate as g
from lotwise.sources.generate import sql_chance, sql_scramble


def _counter(df, key, shift=0):
    return df.select((F.col(key) + shift).alias("g"))


@query(
    "GEN-1",
    """SELECT n, l_orderkey IS NOT NULL AS used
       FROM (SELECT unnest(generate_series(0, (SELECT max(o_orderkey) FROM orders))) AS n)
       LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = n""",
)
def number_series(t):
    last = t.orders.agg(F.max("o_orderkey")).first()[0]
    numbers = g.series(t.spark, 0, -1 if last is None else last).withColumnRenamed("g", "n")  # no order, no number
    used = t.lineitem.select("l_orderkey").distinct()
    joined = numbers.join(used, F.col("l_orderkey") == F.col("n"), "left")
    return joined.select("n", F.col("l_orderkey").isNotNull().alias("used"))


@query(
    "GEN-2",
    """SELECT strftime(d, '%Y-%m-%d') AS day, count(o_orderkey) AS orders
       FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) - INTERVAL 1 YEAR FROM orders),
                                           (SELECT max(o_orderdate) + INTERVAL 1 YEAR FROM orders), INTERVAL 1 DAY)) AS d)
       LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY d""",
)
def day_series(t):
    bounds = t.orders.agg(F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
    days = g.days(bounds, F.expr("low - interval 1 year"), F.expr("high + interval 1 year"))
    counts = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("_n"))
    joined = days.join(counts, "day", "left")
    return joined.select(F.col("day").cast("string").alias("day"), F.coalesce("_n", F.lit(0)).alias("orders"))


@query(
    "GEN-3",
    """SELECT g AS id, CAST(g * 23 % 800 + 1 AS INTEGER) AS shop_id,
              CASE WHEN g % 8 = 0 THEN 'cash' WHEN g % 3 = 0 THEN 'card' ELSE 'qr' END AS payment_type,
              CAST((g * 41 % 250000) / 100.0 AS DECIMAL(10,2)) AS total_sum,
              epoch_us(TIMESTAMP '2025-01-01' + to_days(CAST(g % 75 AS INTEGER)) + to_seconds(g * 19 % 86400)) AS sold_at,
              'check-' || g AS cashier_note
       FROM (SELECT o_orderkey + 1 AS g FROM orders)""",
)
def modulo_rows(t):
    checks = g.store_checks(_counter(t.orders, "o_orderkey", 1))
    return checks.withColumn("sold_at", F.unix_micros(F.col("sold_at").cast("timestamp")))


@query(
    "GEN-3-members",
    """SELECT g AS id, 'Member ' || g AS full_name,
              CASE WHEN g % 15 = 0 THEN 'premium' WHEN g % 4 = 0 THEN 'plus' ELSE 'base' END AS member_level,
              CASE WHEN g % 8 = 0 THEN 'KZN' WHEN g % 5 = 0 THEN 'MSK' ELSE 'NNV' END AS city_code
       FROM (SELECT c_custkey + 1 AS g FROM customer)""",
)
def members(t):
    return g.club_members(_counter(t.customer, "c_custkey", 1))


@query(
    "GEN-3-visits",
    """SELECT g AS id, g * 17 % 22000 + 1 AS member_id, CAST((g * 13 % 150000) / 100.0 AS DECIMAL(10,2)) AS spend,
              CASE WHEN g % 6 = 0 THEN 'gym' WHEN g % 5 = 0 THEN 'pool' ELSE 'group' END AS visit_type,
              epoch_us(TIMESTAMP '2025-01-01' + to_days(CAST(g % 90 AS INTEGER)) + to_seconds(g * 43 % 86400)) AS visit_at
       FROM (SELECT event_id + 1 AS g FROM events)""",
)
def visits(t):
    made = g.club_visits(_counter(t.events, "event_id", 1))
    return made.withColumn("visit_at", F.unix_micros(F.col("visit_at").cast("timestamp")))


@query(
    "GEN-4",
    f"""SELECT o_orderkey, CASE WHEN {sql_chance("o_orderkey", 1, 70)}
               THEN {sql_scramble("o_orderkey", 2)} % greatest(1, n // 10) ELSE {sql_scramble("o_orderkey", 3)} % n END AS seller
        FROM orders, (SELECT count(*) AS n FROM supplier)""",
)
def skewed_keys(t):
    sellers = t.supplier.agg(F.count("*")).scalar()
    return t.orders.select("o_orderkey", g.skewed_position(F.col("o_orderkey"), sellers).alias("seller"))


@query(
    "GEN-5",
    f"""SELECT c_custkey, CASE WHEN {sql_chance("c_custkey", 4, 12)} THEN NULL
               ELSE '+7' || lpad(CAST({sql_scramble("c_custkey", 5)} AS VARCHAR), 10, '0') END AS phone FROM customer""",
)
def nulls_at_a_rate(t):
    key = F.col("c_custkey")
    phone = F.concat(F.lit("+7"), F.lpad(g.scramble(key, 5).cast("string"), 10, "0"))
    return t.customer.select("c_custkey", F.when(~g.chance(key, 4, 12), phone).alias("phone"))


@query(
    "GEN-6",
    f"""SELECT event_id, ['Lisbon', 'Oslo', 'Quito', 'Hanoi', 'Perth'][{sql_scramble("event_id", 6)} % 5 + 1] AS city
        FROM events""",
)
def array_pick(t):
    return t.events.select("event_id", g.pick(g.CITIES, g.scramble(F.col("event_id"), 6)).alias("city"))


@query(
    "GEN-7",
    """SELECT c_custkey, '{"rating":' || (c_custkey % 100) || ',"settings":{"lang":"' ||
              CASE WHEN c_custkey % 2 = 0 THEN 'ru' ELSE 'en' END || '","dark":' ||
              CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END || '},"badges":[{"id":' || (c_custkey % 7) ||
              ',"name":"badge ' || (c_custkey % 7) || '"},{"id":' || (c_custkey % 5) || ',"name":"badge ' || (c_custkey % 5) ||
              '"}]}' AS profile FROM customer""",
)
def nested_json(t):
    key = F.col("c_custkey")

    def badge(number):
        return F.struct(number.alias("id"), F.concat(F.lit("badge "), number.cast("string")).alias("name"))

    profile = F.struct(
        (key % 100).alias("rating"),
        F.struct(
            F.when(key % 2 == 0, "ru").otherwise("en").alias("lang"), (key % 3 == 0).alias("dark")
        ).alias("settings"),
        F.transform(F.array(key % 7, key % 5), badge).alias("badges"),
    )
    return t.customer.select("c_custkey", F.to_json(profile).alias("profile"))


INTERESTS = ("sailing", "chess", "gardens", "pottery", "choir", "maps", "robots", "cycling", "baking", "stars", "birds", "dance")


@query(
    "GEN-8",
    f"""SELECT c_custkey, array_to_string(list_slice({list(INTERESTS)}, {sql_scramble("c_custkey", 7)} % 6 + 1,
               {sql_scramble("c_custkey", 7)} % 6 + 6), ',') AS interests FROM customer""",
)
def array_slice(t):
    start = (g.scramble(F.col("c_custkey"), 7) % 6 + 1).cast("int")
    interests = F.slice(F.array(*[F.lit(item) for item in INTERESTS]), start, 6)
    return t.customer.select("c_custkey", F.array_join(interests, ",").alias("interests"))


@query(
    "GEN-9",
    """SELECT s_suppkey AS seller_id, CAST(n AS INTEGER) AS n, CAST(2020 + n AS INTEGER) AS year_of_manufacture,
              'TEST' || lpad(CAST(n AS VARCHAR), 13, '0') AS vin, 'Test ad #' || n AS header_text,
              CAST(1000000 + n * 100000 AS INTEGER) AS price
       FROM supplier, (SELECT unnest(generate_series(1, 20)) AS n)""",
)
def templated_ads(t):
    return g.test_ads(t.supplier, "s_suppkey", 20)


@query(
    "GEN-10",
    f"""SELECT event_id + 1 AS trip_id, epoch(TIMESTAMP '2024-02-01') - {sql_scramble("event_id", 11)} % 2592000 AS start_second,
               {sql_scramble("event_id", 12)} % 7200 AS duration,
               CAST(({sql_scramble("event_id", 13)} % 4901 + 100) / 100.0 AS DECIMAL(10,2)) AS distance_km,
               ['Lisbon', 'Oslo', 'Quito', 'Hanoi', 'Perth'][{sql_scramble("event_id", 14)} % 5 + 1] AS city
        FROM events""",
)
def trip_table(t):
    trips = g.trips(_counter(t.events, "event_id"), "2024-02-01 00:00:00")
    return trips.select(
        "trip_id",
        F.unix_timestamp(F.col("start_time").cast("timestamp")).cast("double").alias("start_second"),
        F.expr("timestampdiff(SECOND, start_time, end_time)").alias("duration"),
        "distance_km",
        "city",
    )
