"""CTEs and subqueries. One-row subqueries stay scalar, correlated ones become grouped joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.money import mean, mean_of, mean_rounded, sql_mean, sql_mean_rounded
from lotwise.operators.subqueries import greater_than_all, greater_than_any, less_than_any
from lotwise.plans.aggregates import price_sums
from lotwise.plans.registry import query


@query(
    "SUB-1",
    f"""WITH seller_stats AS (
          SELECT s_suppkey, s_name, count(l_orderkey) AS n, coalesce({sql_mean("l_quantity")}, 0.0) AS rating
          FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey, s_name)
        SELECT s_name, n, rating FROM seller_stats WHERE n > 0""",
)
def single_cte(t):
    stats = t.lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), mean("l_quantity").alias("rating")
    )
    joined = t.supplier.join(stats, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.where("n > 0").select("s_name", "n", "rating")


@query(
    "SUB-2",
    f"""WITH named AS (SELECT o_orderkey, o_totalprice, c_custkey, c_name, c_mktsegment
                       FROM orders JOIN customer ON o_custkey = c_custkey),
             info AS (SELECT l_orderkey, {sql_mean_rounded("l_extendedprice")} AS average_price
                      FROM lineitem GROUP BY l_orderkey)
        SELECT c_custkey, c_name, c_mktsegment, o_orderkey, o_totalprice, average_price
        FROM named JOIN info ON o_orderkey = l_orderkey""",
)
def two_ctes(t):
    named = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    info = t.lineitem.groupBy("l_orderkey").agg(mean_rounded("l_extendedprice").alias("average_price"))
    return named.join(info, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "c_custkey", "c_name", "c_mktsegment", "o_orderkey", "o_totalprice", "average_price"
    )


@query(
    "SUB-3",
    f"""WITH stats AS (SELECT p_brand, count(*) AS n, {sql_mean("l_extendedprice")} AS avg_price
                       FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_brand),
             categories AS (SELECT p_brand, avg_price, CASE WHEN avg_price > 52500 THEN 'premium'
                            WHEN avg_price > 51500 THEN 'middle' ELSE 'budget' END AS category FROM stats WHERE n > 0)
        SELECT p_brand, avg_price, category FROM categories""",
)
def cte_chain(t):
    stats = price_sums(t).groupBy("p_brand").agg(F.sum("rows").alias("n"), mean_of("price", "n").alias("avg_price"))
    category = F.when(F.col("avg_price") > 52500, "premium").when(F.col("avg_price") > 51500, "middle")
    return stats.where("n > 0").select("p_brand", "avg_price", category.otherwise("budget").alias("category"))


@query(
    "SUB-4",
    "SELECT c_custkey, (SELECT count(*) FROM events WHERE user_id = c_custkey) AS events_count FROM customer",
)
def scalar_per_row(t):
    counts = t.events.groupBy("user_id").agg(F.count("*").alias("_n"))
    joined = t.customer.join(counts, F.col("user_id") == F.col("c_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("_n", F.lit(0)).alias("events_count"))


@query(
    "SUB-5",
    f"""SELECT o_orderkey, o_totalprice, o_totalprice * 100.0 / (SELECT {sql_mean("o_totalprice")} FROM orders) AS percent_of_avg,
               (SELECT max(year(o_orderdate)) FROM orders) AS newest_year
        FROM orders""",
)
def scalar_for_all(t):
    average = t.orders.agg(mean("o_totalprice")).scalar()
    newest = t.orders.agg(F.max(F.year("o_orderdate")).cast("bigint")).scalar()
    return t.orders.select(
        "o_orderkey",
        "o_totalprice",
        (F.col("o_totalprice") * 100.0 / average).alias("percent_of_avg"),
        newest.alias("newest_year"),
    )


@query(
    "SUB-6",
    f"""SELECT s_suppkey, d.avg_quantity FROM supplier
        LEFT JOIN (SELECT l_suppkey, {sql_mean_rounded("l_quantity")} AS avg_quantity FROM lineitem GROUP BY l_suppkey) d ON d.l_suppkey = s_suppkey""",
)
def derived_table(t):
    derived = t.lineitem.groupBy("l_suppkey").agg(
        mean_rounded("l_quantity").alias("avg_quantity")
    )
    joined = t.supplier.join(derived, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return joined.select("s_suppkey", "avg_quantity")


@query(
    "SUB-7",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT {sql_mean('o_totalprice')} FROM orders)",
)
def scalar_in_where(t):
    average = t.orders.agg(mean("o_totalprice")).scalar()
    return t.orders.where(F.col("o_totalprice") > average).select("o_orderkey", "o_totalprice")


@query(
    "SUB-8",
    """SELECT l_suppkey, count(*) AS ads_count FROM lineitem GROUP BY l_suppkey
       HAVING count(*) > (SELECT sum(n) / count(*) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey))""",
)
def scalar_in_having(t):
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("ads_count"))
    average = counts.agg(F.sum("ads_count").cast("double") / F.count("*")).scalar()
    return counts.where(F.col("ads_count") > average)


@query(
    "SUB-9",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice > ALL (SELECT o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW')""",
)
def greater_all(t):
    pending = t.orders.where("o_orderstatus = 'P' AND o_orderpriority = '5-LOW'").select("o_totalprice")
    found = t.orders.where(greater_than_all(F.col("o_totalprice"), pending))
    return found.select("o_orderkey", "o_totalprice")


@query(
    "SUB-10",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice > ANY (SELECT o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 200000)
         AND o_totalprice < ANY (SELECT o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice < 400000)""",
)
def greater_any_less_any(t):
    low = t.orders.where("o_orderpriority = '1-URGENT' AND o_totalprice > 200000").select("o_totalprice")
    high = t.orders.where("o_orderstatus = 'P' AND o_totalprice < 400000").select("o_totalprice")
    price = F.col("o_totalprice")
    found = t.orders.where(greater_than_any(price, low) & less_than_any(price, high))
    return found.select("o_orderkey", "o_totalprice")


@query("SUB-11", "SELECT c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
def in_query(t):
    users = t.events.select("user_id").distinct()
    return t.customer.join(users, F.col("c_custkey") == F.col("user_id"), "left_semi").select("c_name", "c_mktsegment")


@query(
    "SUB-12",
    """SELECT p_partkey, p_name FROM part
       WHERE p_brand IN (SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) > (SELECT count(*) / count(DISTINCT p_brand) FROM part WHERE p_brand IS NOT NULL))""",
)
def in_grouped(t):
    counts = t.part.where("p_brand IS NOT NULL").groupBy("p_brand").agg(F.count("*").alias("n"))
    common = counts.where(F.col("n") > counts.agg(F.avg("n")).scalar())
    return t.part.join(common, "p_brand", "left_semi").select("p_partkey", "p_name")


@query(
    "SUB-13",
    """SELECT l_orderkey, l_linenumber, p_type, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE (p_type, l_returnflag) IN (
         SELECT p_type, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey
         GROUP BY p_type, l_returnflag
         HAVING count(*) > (SELECT avg(n) FROM (SELECT count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, l_returnflag)))""",
)
def row_value_in(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    # Lines are counted per part and status before they meet the parts.
    per_part = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(F.count("*").alias("n"))
    counts = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_type", "l_returnflag").agg(F.sum("n").alias("n"))
    common = counts.where(F.col("n") > counts.agg(F.avg("n")).scalar())
    return joined.join(common, ["p_type", "l_returnflag"], "left_semi").select(
        "l_orderkey", "l_linenumber", "p_type", "l_returnflag"
    )


@query(
    "SUB-14",
    """SELECT c_custkey, c_name FROM customer WHERE EXISTS (
         SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
         WHERE o_custkey = c_custkey AND l_returnflag = 'R' AND o_orderstatus = 'P')""",
)
def exists_through_join(t):
    returned = t.lineitem.where("l_returnflag = 'R'")
    pending = t.orders.where("o_orderstatus = 'P'")
    sold = pending.join(returned, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_custkey").distinct()
    return t.customer.join(sold, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "SUB-15",
    f"""SELECT s_suppkey, s_name FROM supplier
        WHERE (SELECT {sql_mean("l_extendedprice")} FROM lineitem WHERE l_suppkey = s_suppkey) > 52000""",
)
def correlated_against_constant(t):
    means = t.lineitem.groupBy("l_suppkey").agg(mean("l_extendedprice").alias("_mean")).where("_mean > 52000")
    return t.supplier.join(means, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select("s_suppkey", "s_name")


@query(
    "SUB-16",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem a
        WHERE l_extendedprice > (SELECT {sql_mean("l_extendedprice")} FROM lineitem b WHERE b.l_suppkey = a.l_suppkey)""",
)
def above_own_group(t):
    means = t.lineitem.groupBy(F.col("l_suppkey").alias("_seller")).agg(mean("l_extendedprice").alias("_mean"))
    joined = t.lineitem.join(means, F.col("l_suppkey") == F.col("_seller"))
    found = joined.where(F.col("l_extendedprice") > F.col("_mean"))
    return found.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
