"""The named functions of the marketplace."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.bands import price_band_sql
from lotwise.functions.money import sql_mean_rounded
from lotwise.operators.market import active_ads, average_rating, vehicle_text
from lotwise.plans.registry import query


@query(
    "UDF-1",
    f"""SELECT c_custkey, coalesce((SELECT {sql_mean_rounded("value")} FROM events WHERE user_id = c_custkey), 0.0) AS avg_rating
        FROM customer""",
)
def seller_average_rating(t):
    return average_rating(t.customer, "c_custkey", t.events, "user_id", "value")


def _active(t):
    return active_ads(t.supplier, "s_suppkey", t.lineitem, "l_suppkey", F.col("l_returnflag") == "A", "l_extendedprice")


@query(
    "UDF-2",
    """SELECT s_suppkey, (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'A') AS active_ads
       FROM supplier""",
)
def count_active_ads(t):
    return _active(t).drop("total_price")


@query(
    "UDF-3",
    """SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') AS is_active
       FROM orders""",
)
def is_active(t):
    active = t.lineitem.where("l_returnflag = 'A'").select("l_orderkey").distinct()
    joined = t.orders.join(active, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select("o_orderkey", F.col("l_orderkey").isNotNull().alias("is_active"))


@query(
    "UDF-4",
    """SELECT s_suppkey, CAST(coalesce((SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem
              WHERE l_suppkey = s_suppkey AND l_returnflag = 'A'), 0) AS DECIMAL(28,2)) AS total_price FROM supplier""",
)
def seller_total_price(t):
    return _active(t).drop("active_ads")


@query(
    "UDF-5",
    """SELECT p_partkey, concat(p_brand, ' ', p_name, ' ', p_size, ', ', coalesce(nullif(p_type, 'SMALL'), 'no colour'), ', VIN: ',
              lpad(CAST(p_partkey AS VARCHAR), 17, 'V')) AS info FROM part""",
)
def vehicle_info(t):
    info = vehicle_text(
        F.col("p_brand"), F.col("p_name"), F.col("p_size"), F.expr("nullif(p_type, 'SMALL')"),
        F.lpad(F.col("p_partkey").cast("string"), 17, "V"),
    )
    return t.part.select("p_partkey", info.alias("info"))


@query(
    "UDF-6",
    f"""SELECT l_orderkey, l_linenumber, price, {price_band_sql(0.02)} AS category
        FROM (SELECT l_orderkey, l_linenumber, l_extendedprice AS price FROM lineitem)""",
)
def price_category(t):
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION price_category(price DOUBLE) RETURNS STRING "
        f"RETURN {price_band_sql(0.02)}"
    )
    priced = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    return priced.withColumn("category", F.expr("price_category(price)"))
