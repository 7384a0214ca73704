"""Joins. No side is broadcast by hand: Spark does it after its own size check, and splits skewed partitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.money import mean, mean_rounded, money, sql_mean, sql_mean_rounded, sql_total, total
from lotwise.operators.joins import left_join_many
from lotwise.operators.subqueries import with_each_entry
from lotwise.plans.registry import query


@query(
    "JOIN-1",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, p_brand, p_name
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def inner(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "p_brand", "p_name")


@query(
    "JOIN-2",
    """SELECT o_orderkey, c_name AS buyer, s_suppkey, p_brand, p_name, l_extendedprice
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
)
def inner_chain(t):
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", F.col("c_name").alias("buyer"), "s_suppkey", "p_brand", "p_name", "l_extendedprice"
    )


@query(
    "JOIN-3",
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey""",
)
def left_outer(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    joined = left_join_many(t.customer.select("c_custkey", "c_name"), orders, "c_custkey", "o_custkey")
    return joined.drop("o_custkey")


@query(
    "JOIN-4",
    """SELECT event_id, value, c_custkey, c_name FROM events RIGHT JOIN customer ON user_id = c_custkey""",
)
def right_outer(t):
    readings = t.events.select("user_id", "event_id", "value")
    return left_join_many(t.customer.select("c_custkey", "c_name"), readings, "c_custkey", "user_id").drop("user_id")


@query("JOIN-5", "SELECT s_suppkey, r_name AS region FROM supplier CROSS JOIN region")
def every_dictionary_entry(t):
    regions = t.region.select(F.col("r_name").alias("region"))
    return with_each_entry(t.supplier.select("s_suppkey"), regions)


@query(
    "JOIN-6",
    """SELECT s_suppkey, s_name, count(l_orderkey) AS active_ads
       FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey AND l_returnflag = 'A'
       GROUP BY s_suppkey, s_name""",
)
def filter_inside_on(t):
    active = t.lineitem.where("l_returnflag = 'A'")
    counts = active.groupBy("l_suppkey").agg(F.count("*").alias("_n"))
    joined = t.supplier.join(counts, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return joined.select("s_suppkey", "s_name", F.coalesce("_n", F.lit(0)).alias("active_ads"))


@query(
    "JOIN-7",
    """SELECT o_orderkey, c_name, n_name AS nation, r_name AS region
       FROM orders JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def fact_with_dictionaries(t):
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    joined = t.orders.join(named, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "o_orderkey", "c_name", F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )


@query(
    "JOIN-8",
    """SELECT p_partkey, p_brand, p_size FROM part
       JOIN (SELECT sum(51 - p_size) / count(*) AS avg_age FROM part) ON 51 - p_size > avg_age""",
)
def above_mean(t):
    age = F.lit(51) - F.col("p_size")
    mean_age = t.part.agg(F.sum(age).cast("double") / F.count("*")).scalar()
    return t.part.where(age > mean_age).select("p_partkey", "p_brand", "p_size")


@query(
    "JOIN-9",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)",
)
def semi(t):
    users = t.events.select("user_id").distinct()
    return t.customer.join(users, F.col("c_custkey") == F.col("user_id"), "left_semi").select("c_custkey", "c_name")


@query(
    "JOIN-10",
    "SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_tax > 0.07)",
)
def anti(t):
    taxed = t.lineitem.where("l_tax > 0.07").select("l_partkey").distinct()
    return t.part.join(taxed, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_name")


@query(
    "JOIN-11",
    """SELECT c_custkey, c_mktsegment, o_totalprice, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey
       WHERE c_mktsegment = 'BUILDING' AND o_orderdate >= TIMESTAMP '1996-02-01' AND o_orderdate < TIMESTAMP '1996-05-01'""",
)
def selective_both_sides(t):
    members = t.customer.where("c_mktsegment = 'BUILDING'")
    visits = t.orders.where(
        "o_orderdate >= timestamp_ntz'1996-02-01 00:00:00' AND o_orderdate < timestamp_ntz'1996-05-01 00:00:00'"
    )
    joined = members.join(visits, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("c_custkey", "c_mktsegment", "o_totalprice", "o_orderkey")


@query(
    "JOIN-12",
    f"""SELECT c_custkey, c_name, count(o_orderkey) AS orders_count, max(o_totalprice) AS max_price,
               {sql_mean("o_totalprice")} AS avg_price
        FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""",
)
def join_then_aggregate(t):
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("orders_count"),
        F.max("o_totalprice").alias("max_price"),
        mean("o_totalprice").alias("avg_price"),
    )
    joined = t.customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select("c_custkey", "c_name", "orders_count", "max_price", "avg_price")


@query(
    "JOIN-13",
    f"""SELECT c_custkey, c_name,
               coalesce((SELECT {sql_mean_rounded("value")} FROM events WHERE user_id = c_custkey), 0.0) AS avg_rating,
               (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_custkey = c_custkey) AS contracts_count
        FROM customer""",
)
def two_many_sides(t):
    # Each many-side is summed up before the join, so its rows are not multiplied by those of the other.
    ratings = t.events.groupBy("user_id").agg(mean_rounded("value").alias("_rating"))
    contracts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("_contracts"))
    joined = t.customer.join(ratings, F.col("c_custkey") == F.col("user_id"), "left").join(
        contracts, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    return joined.select(
        "c_custkey",
        "c_name",
        F.coalesce("_rating", F.lit(0.0)).alias("avg_rating"),
        F.coalesce("_contracts", F.lit(0)).alias("contracts_count"),
    )


@query(
    "JOIN-14",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CAST(l_extendedprice + CASE WHEN p.p_partkey IS NOT NULL THEN 100 ELSE 0 END AS DECIMAL(18,2)) AS price
       FROM lineitem LEFT JOIN (SELECT DISTINCT p_partkey FROM part WHERE p_type = 'STANDARD') p ON l_partkey = p.p_partkey""",
)
def update_from_join(t):
    untaxed = t.part.where("p_type = 'STANDARD'").select("p_partkey").distinct()
    joined = t.lineitem.join(untaxed, F.col("l_partkey") == F.col("p_partkey"), "left")
    raised = money("l_extendedprice") + F.when(F.col("p_partkey").isNotNull(), 100).otherwise(0)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", raised.cast("decimal(18,2)").alias("price"))
