"""Projections, filters, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.money import money
from lotwise.plans.registry import query


@query("PRJ-1", "SELECT c_name, c_mktsegment FROM customer")
def projection(t):
    return t.customer.select("c_name", "c_mktsegment")


@query("PRJ-2", "SELECT p_brand AS brand, p_name AS model FROM part")
def aliases(t):
    return t.part.select(F.col("p_brand").alias("brand"), F.col("p_name").alias("model"))


@query(
    "PRJ-3",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(floor(l_extendedprice) AS BIGINT) // 100 AS price_usd
       FROM lineitem""",
)
def integer_division(t):
    usd = F.expr("cast(floor(l_extendedprice) as bigint) div 100")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", usd.alias("price_usd"))


@query(
    "PRJ-4",
    "SELECT p_partkey, p_size, CAST((p_size * 7355 + 500) // 1000 AS BIGINT) / 10.0 AS power_kw FROM part",
)
def rounded_column(t):
    kilowatts = F.round(F.col("p_size") * F.lit("0.7355").cast("decimal(5,4)"), 1)
    return t.part.select("p_partkey", "p_size", kilowatts.cast("double").alias("power_kw"))


@query(
    "PRJ-5",
    """SELECT p_partkey, p_type, CASE WHEN p_type = 'ECONOMY' THEN 'economy' ELSE 'not economy' END AS class
       FROM part""",
)
def searched_case(t):
    label = F.when(F.col("p_type") == "ECONOMY", "economy").otherwise("not economy")
    return t.part.select("p_partkey", "p_type", label.alias("class"))


@query(
    "PRJ-6",
    """SELECT o_orderkey, o_orderstatus,
              CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'in processing' WHEN 'F' THEN 'sold'
                   ELSE 'unknown' END AS status_name
       FROM orders""",
)
def simple_case(t):
    name = F.expr(
        "CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'in processing' WHEN 'F' THEN 'sold' "
        "ELSE 'unknown' END"
    )
    return t.orders.select("o_orderkey", "o_orderstatus", name.alias("status_name"))


@query("PRJ-7", "SELECT DISTINCT p_type, p_brand FROM part")
def distinct_values(t):
    return t.part.select("p_type", "p_brand").distinct()


@query(
    "PRJ-8",
    """SELECT p_name AS title, p_retailprice AS price FROM part
       WHERE p_type = 'PROMO' AND p_size <= 25 AND p_retailprice > (SELECT avg(p_retailprice) FROM part)""",
)
def document_projection(t):
    books = t.part.select(
        F.struct(
            F.col("p_name").alias("title"),
            F.col("p_type").alias("genre"),
            F.col("p_retailprice").alias("price"),
            (F.col("p_size") <= 25).alias("available"),
        ).alias("doc")
    )
    usual = t.part.agg(F.avg("p_retailprice")).scalar()
    found = books.where((F.col("doc.genre") == "PROMO") & (F.col("doc.price") > usual) & F.col("doc.available"))
    return found.select("doc.title", "doc.price")


@query("FLT-1", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size > 20")
def comparison(t):
    return t.part.where(F.col("p_size") > 20).select("p_partkey", "p_brand", "p_size")


@query(
    "FLT-2",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, p_size
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_extendedprice > 60000 OR p_size > 40""",
)
def or_across_tables(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    found = joined.where((F.col("l_extendedprice") > 60000) | (F.col("p_size") > 40))
    return found.select("l_orderkey", "l_linenumber", "l_extendedprice", "p_size")


@query(
    "FLT-3",
    """SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer
       WHERE nullif(c_mktsegment, 'MACHINERY') NOT IN ('BUILDING', 'FURNITURE')""",
)
def not_in_list(t):
    # MACHINERY stands in for a missing value: NOT IN is unknown there, so those rows drop out too.
    segment = F.expr("nullif(c_mktsegment, 'MACHINERY')").alias("segment")
    return t.customer.select("c_custkey", segment).where(~F.col("segment").isin("BUILDING", "FURNITURE"))


@query("FLT-4", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 300000")
def between(t):
    return t.orders.where(F.col("o_totalprice").between(100000, 300000)).select("o_orderkey", "o_totalprice")


@query(
    "FLT-5",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_nationkey IN (SELECT n_nationkey FROM nation
                             WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE')))""",
)
def in_subquery(t):
    regions = t.region.where(F.col("r_name").isin("ASIA", "EUROPE"))
    nations = t.nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select(
        "c_custkey", "c_name"
    )


@query("FLT-6", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'")
def like_prefix(t):
    return t.part.where(F.col("p_name").startswith("red")).select("p_partkey", "p_name")


@query("FLT-7", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE '%12%'")
def like_infix(t):
    return t.customer.where(F.col("c_name").contains("12")).select("c_custkey", "c_name")


@query("FLT-8", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%Bl%B%'")
def ilike_two_terms(t):
    return t.part.where(F.col("p_name").ilike("%Bl%B%")).select("p_partkey", "p_name")


@query(
    "FLT-9",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-02-01 00:00:00'
         AND o_orderdate < TIMESTAMP '1997-03-01 00:00:00'""",
)
def point_and_time_range(t):
    in_range = F.expr(
        "o_orderdate >= timestamp_ntz'1997-02-01 00:00:00' AND o_orderdate < timestamp_ntz'1997-03-01 00:00:00'"
    )
    found = t.orders.where((F.col("o_orderstatus") == "F") & in_range)
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "FLT-10",
    """SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS old_status, nullif(l_linestatus, 'F') AS new_status
       FROM lineitem WHERE nullif(l_returnflag, 'N') IS DISTINCT FROM nullif(l_linestatus, 'F')""",
)
def distinct_from(t):
    pairs = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.expr("nullif(l_returnflag, 'N')").alias("old_status"),
        F.expr("nullif(l_linestatus, 'F')").alias("new_status"),
    )
    return pairs.where(~F.col("old_status").eqNullSafe(F.col("new_status")))


@query("FLT-11", "SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https://[a-z.]+/en/[0-9]+$')")
def regex(t):
    return t.pages.where(F.col("url").rlike("^https://[a-z.]+/en/[0-9]+$")).select("page_id", "url")


@query(
    "FLT-12",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 4000""",
)
def document_conjunction(t):
    docs = t.customer.select(
        "c_custkey", F.struct("c_name", "c_acctbal", F.col("c_mktsegment").alias("segment")).alias("doc")
    )
    found = docs.where((F.col("doc.segment") == "BUILDING") & (F.col("doc.c_acctbal") > 4000))
    return found.select("c_custkey", "doc.c_name", "doc.c_acctbal")


@query(
    "FLT-13",
    """SELECT 'key' AS access, c_custkey, c_name FROM customer WHERE c_custkey = 42
       UNION ALL SELECT 'name' AS access, c_custkey, c_name FROM customer WHERE c_name = 'Customer#000000007'""",
)
def lookups(t):
    by_key = t.customer.where(F.col("c_custkey") == 42).select(F.lit("key").alias("access"), "c_custkey", "c_name")
    by_name = t.customer.where(F.col("c_name") == "Customer#000000007")
    return by_key.union(by_name.select(F.lit("name").alias("access"), "c_custkey", "c_name"))


@query("SRT-1", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey")
def order_by(t):
    ordered = t.orders.select("o_orderkey", "o_totalprice")
    return ordered.orderBy(F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey").asc_nulls_last())


@query(
    "SRT-2",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders
       ORDER BY price DESC NULLS LAST, o_orderkey""",
)
def nulls_last(t):
    priced = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price")
    )
    return priced.orderBy(F.col("price").desc_nulls_last(), "o_orderkey")


@query("SRT-3", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 3")
def first_rows(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(3)


@query("SRT-4", "SELECT p_partkey, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 10")
def top_k(t):
    return t.part.select("p_partkey", "p_size").orderBy(F.col("p_size").desc(), "p_partkey").limit(10)


@query("SRT-5", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 1 OFFSET 17")
def nth_row(t):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey").offset(17).limit(1)


@query(
    "SRT-6",
    """SELECT event_id, user_id FROM events
       WHERE event_id NOT IN (SELECT event_id FROM events ORDER BY event_id DESC LIMIT 3)""",
)
def delete_latest(t):
    latest = t.events.select("event_id").orderBy(F.col("event_id").desc()).limit(3)
    return t.events.select("event_id", "user_id").join(latest, "event_id", "left_anti")


ACTIVE_AND_SOLD = """
SELECT 'active' AS status_type, o_orderkey, c_name, CAST(o_totalprice AS DECIMAL(18,2)) AS price
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'
UNION
SELECT 'sold', o_orderkey, c_name, CAST(l_extendedprice AS DECIMAL(18,2))
FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'F'
"""


@query("SET-1", ACTIVE_AND_SOLD)
def union_of_joins(t):
    named = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    active = named.where("o_orderstatus = 'O'").select(
        F.lit("active").alias("status_type"), "o_orderkey", "c_name", money("o_totalprice").alias("price")
    )
    sold = named.where("o_orderstatus = 'F'").join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    sold = sold.select(F.lit("sold"), "o_orderkey", "c_name", money("l_extendedprice"))
    return active.union(sold).distinct()


@query(
    "SET-2",
    """SELECT 'type' AS category, p_type AS item_name, count(*) AS vehicle_count FROM part GROUP BY p_type
       UNION SELECT 'brand', p_brand, count(*) FROM part GROUP BY p_brand""",
)
def union_of_reports(t):
    types = t.part.groupBy(F.lit("type").alias("category"), F.col("p_type").alias("item_name")).agg(
        F.count("*").alias("vehicle_count")
    )
    brands = t.part.groupBy(F.lit("brand").alias("category"), F.col("p_brand").alias("item_name")).agg(
        F.count("*").alias("vehicle_count")
    )
    return types.union(brands).distinct()


@query(
    "SET-3",
    """SELECT 'events' AS source, event_id AS id, user_id AS owner FROM events
       UNION ALL SELECT 'orders', o_orderkey, o_custkey FROM orders""",
)
def union_all(t):
    events = t.events.select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"), F.col("user_id").alias("owner")
    )
    orders = t.orders.select(F.lit("orders"), "o_orderkey", "o_custkey")
    return events.union(orders)


@query(
    "SET-4",
    """SELECT c_custkey, c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F'
       INTERSECT
       SELECT c_custkey, c_name FROM customer JOIN events ON c_custkey = user_id""",
)
def intersect(t):
    # A join only to find who has a match is a semi join on distinct keys.
    def having(keys, column):
        return t.customer.join(keys.distinct(), F.col("c_custkey") == F.col(column), "left_semi").select("c_custkey", "c_name")

    sold = having(t.orders.where("o_orderstatus = 'F'").select("o_custkey"), "o_custkey")
    return sold.intersect(having(t.events.select("user_id"), "user_id"))


@query(
    "SET-5",
    """SELECT p_partkey, p_brand, p_name FROM part JOIN lineitem ON p_partkey = l_partkey
       EXCEPT
       SELECT p_partkey, p_brand, p_name FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_quantity > 48""",
)
def subtract(t):
    def having(lines):
        keys = lines.select("l_partkey").distinct()
        return t.part.join(keys, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey", "p_brand", "p_name")

    return having(t.lineitem).subtract(having(t.lineitem.where("l_quantity > 48")))
