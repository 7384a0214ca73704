"""Grouped, global and multi-level aggregates. Hot groups are combined on the map side; money is summed exactly."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.money import (
    mean, mean_of, mean_of_rounded, mean_rounded, money, sql_mean, sql_mean_rounded, sql_total, total,
)
from lotwise.operators.aggregates import cube_of, distinct_estimates, distinct_pairs, distinct_sketches, joined_segments, rollup_of
from lotwise.operators.ordered import joined_null_safe
from lotwise.plans.registry import query
from lotwise.sources.workspace import layout

STATUS_NAMES = (("A", "active"), ("N", "in processing"), ("R", "sold"))


def price_sums(t):
    """Price sums per part with the columns of the part.

    Lines are summed per part before they meet the parts: the join then moves one row per part instead of every line,
    and reuses the partitioning of the sum.
    """
    sums = t.lineitem.groupBy("l_partkey").agg(
        F.count("*").alias("rows"),
        F.count("l_extendedprice").alias("n"),
        F.sum(money("l_extendedprice")).alias("price"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
    )
    return sums.join(t.part, F.col("l_partkey") == F.col("p_partkey"))


@query(
    "AGG-1",
    """SELECT n_name, count(s_suppkey) AS sellers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
)
def count_after_join(t):
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("s_suppkey").alias("sellers"))


@query(
    "AGG-2",
    f"""SELECT p_brand, count(*) AS n, {sql_total("l_extendedprice")} AS total_price,
               {sql_mean_rounded("l_extendedprice")} AS avg_price
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
)
def totals_by_brand(t):
    sums = price_sums(t).groupBy("p_brand").agg(
        F.sum("rows").alias("_rows"),
        F.sum("price").cast("decimal(28,2)").alias("total_price"),
        mean_of_rounded("price", "n").alias("avg_price"),
    )
    return sums.select("p_brand", F.col("_rows").alias("n"), "total_price", "avg_price")


@query(
    "AGG-3",
    f"""SELECT p_type, count(l_orderkey) AS ad_count, {sql_mean("l_extendedprice")} AS avg_price,
               min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
        FROM part LEFT JOIN lineitem ON l_partkey = p_partkey
        WHERE l_extendedprice IS NOT NULL GROUP BY p_type""",
)
def min_and_max(t):
    # A WHERE on the right side of a left join makes it an inner join.
    return price_sums(t).groupBy("p_type").agg(
        F.sum("n").alias("ad_count"),
        mean_of("price", "n").alias("avg_price"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
    )


@query(
    "AGG-4",
    f"""SELECT p_brand, count(*) AS n, {sql_mean_rounded("l_extendedprice")} AS avg_price
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
        HAVING {sql_mean("l_extendedprice")} > 52000""",
)
def having(t):
    grouped = price_sums(t).groupBy("p_brand").agg(
        F.sum("rows").alias("n"), mean_of_rounded("price", "n").alias("avg_price"), mean_of("price", "n").alias("_mean")
    )
    return grouped.where("_mean > 52000").drop("_mean")


@query(
    "AGG-5",
    """SELECT CASE WHEN grouping(p_type) = 1 THEN 'ALL TYPES' ELSE p_type END AS body_type,
              CASE WHEN grouping(p_brand) = 1 THEN 'ALL BRANDS' ELSE p_brand END AS brand,
              count(*) AS n, CAST(sum(p_size) AS DOUBLE) / count(p_size) AS avg_power
       FROM part GROUP BY ROLLUP (p_type, p_brand)""",
)
def rollup(t):
    base = t.part.select(F.col("p_type").alias("body_type"), F.col("p_brand").alias("brand"), "p_size")
    sums = {"n": F.count("*"), "power": F.sum("p_size"), "known": F.count("p_size")}
    levels = rollup_of(base, {"body_type": "ALL TYPES", "brand": "ALL BRANDS"}, sums)
    average = F.col("power").cast("double") / F.col("known")
    return levels.select("body_type", "brand", "n", average.alias("avg_power"))


@query(
    "AGG-6",
    """SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'ALL STATES' ELSE o_orderstatus END AS state,
              CASE WHEN grouping(o_orderpriority) = 1 THEN 'ALL PRIORITIES' ELSE o_orderpriority END AS priority,
              count(*) AS n, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
       FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
def cube(t):
    base = t.orders.withColumnsRenamed({"o_orderstatus": "state", "o_orderpriority": "priority"})
    labels = {"state": "ALL STATES", "priority": "ALL PRIORITIES"}
    lows = {"min_price": F.min("o_totalprice")}
    highs = {"max_price": F.max("o_totalprice")}
    return cube_of(base, labels, {"n": F.count("*")}, lows, highs)


@query(
    "AGG-7",
    """SELECT s_suppkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS active
       FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY s_suppkey""",
)
def conditional_sum(t):
    counts = t.lineitem.groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).alias("active")
    )
    return t.supplier.join(counts, F.col("s_suppkey") == F.col("l_suppkey")).select("s_suppkey", "active")


@query(
    "AGG-8",
    """SELECT l_partkey, CAST(sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS sold_quantity,
              CAST(sum(l_quantity) AS BIGINT) AS quantity
       FROM lineitem GROUP BY l_partkey""",
)
def sum_if(t):
    return t.lineitem.groupBy("l_partkey").agg(
        F.expr("cast(sum(l_quantity) FILTER (WHERE l_returnflag = 'R') as bigint)").alias("sold_quantity"),
        F.sum("l_quantity").cast("bigint").alias("quantity"),
    )


@query(
    "AGG-9",
    """SELECT s_suppkey, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands
       FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN part ON l_partkey = p_partkey GROUP BY s_suppkey""",
)
def distinct_strings(t):
    # Distinct pairs first: a seller with a third of all rows is down to one row per brand before its string is built.
    pairs = (
        t.lineitem.select("l_suppkey", "l_partkey")
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("l_suppkey").alias("s_suppkey"), "p_brand")
        .distinct()
    )
    known = pairs.join(t.supplier, "s_suppkey", "left_semi")
    return known.groupBy("s_suppkey").agg(
        F.expr("listagg(p_brand, ', ') WITHIN GROUP (ORDER BY p_brand)").alias("brands")
    )


@query(
    "AGG-10",
    """WITH entries AS (
         SELECT p_brand, concat(p_name, ' (', p_size, ')') AS entry FROM part JOIN lineitem ON l_partkey = p_partkey),
       numbered AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY entry) - 1 AS place FROM entries),
       totals AS (SELECT p_brand AS brand, count(*) AS vehicles, """ + sql_mean_rounded("l_extendedprice") + """ AS avg_price
                  FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_brand)
       SELECT p_brand, CAST(place // 1000 AS BIGINT) AS segment, count(*) AS entries,
              string_agg(entry, '; ' ORDER BY place) AS models, any_value(vehicles) AS vehicles, any_value(avg_price) AS avg_price
       FROM numbered JOIN totals ON brand IS NOT DISTINCT FROM p_brand GROUP BY p_brand, place // 1000""",
)
def composed_strings(t):
    entry = F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(")")).alias("entry")
    # Lines are counted per part before they meet the parts.
    sums = price_sums(t).select("p_brand", entry, "rows", "price", "n")
    totals = sums.groupBy("p_brand").agg(F.sum("rows").alias("vehicles"), mean_of_rounded("price", "n").alias("avg_price"))
    segments = joined_segments(sums, "p_brand", "entry", "; ", 1000, count=F.sum("rows")).withColumnRenamed("text", "models")
    return joined_null_safe(segments, totals, ["p_brand"])


@query(
    "AGG-11",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_shipdate) AS days FROM lineitem GROUP BY l_suppkey",
)
def distinct_counts(t):
    return distinct_pairs(t.lineitem, "l_suppkey", parts="l_partkey", days="l_shipdate")


def daily_parts(t):
    """Sketches of the parts that each supplier shipped on each day, written once for these data."""

    def write(path):
        lines = t.lineitem.select("l_suppkey", F.col("l_shipdate").cast("date").alias("day"), "l_partkey")
        distinct_sketches(lines, ["l_suppkey", "day"], "l_partkey", "parts").write.parquet(path)

    return t.spark.read.parquet(layout(t.spark, "daily-parts", [t.path("lineitem")], write))


@query(
    "AGG-11-sketch",
    """SELECT l_suppkey, span, count(DISTINCT l_partkey) AS parts, TRUE AS near FROM (
         SELECT l_suppkey, l_partkey, unnest(CASE WHEN l_shipdate < TIMESTAMP '1995-07-01' THEN ['all', 'early'] ELSE ['all'] END) AS span FROM lineitem)
       GROUP BY l_suppkey, span""",
)
def distinct_over_spans(t):
    """Exact counts over two spans, and whether the estimate from the daily sketches lies within four standard errors."""
    early = "day < date'1995-07-01'"
    sketches, lines = daily_parts(t), t.lineitem.select("l_suppkey", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    estimates = [distinct_estimates(rows, ["l_suppkey"], "parts", "estimate").withColumn("span", F.lit(span)) for span, rows in (("all", sketches), ("early", sketches.where(early)))]
    exact = [distinct_pairs(rows, "l_suppkey", parts="l_partkey").withColumn("span", F.lit(span)) for span, rows in (("all", lines), ("early", lines.where(early)))]
    both = joined_null_safe(exact[0].union(exact[1]), estimates[0].union(estimates[1]), ["l_suppkey", "span"])
    near = F.abs(F.col("estimate") - F.col("parts")) <= 1 + 4 * 0.8 / 2**6 * F.col("parts")
    return both.select("l_suppkey", "span", "parts", near.alias("near"))


@query("AGG-12", "SELECT l_partkey, min(l_returnflag) AS any_status, count(*) AS n FROM lineitem GROUP BY l_partkey")
def any_value(t):
    return t.lineitem.groupBy("l_partkey").agg(F.min("l_returnflag").alias("any_status"), F.count("*").alias("n"))


@query(
    "AGG-13",
    f"""SELECT count(*) AS ready, {sql_total("o_totalprice")} AS total_price,
               strftime(min(o_orderdate), '%Y-%m-%d') AS oldest
        FROM orders WHERE o_orderstatus = 'P'""",
)
def global_aggregate(t):
    return t.orders.where("o_orderstatus = 'P'").agg(
        F.count("*").alias("ready"),
        total("o_totalprice").alias("total_price"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("oldest"),
    )


@query(
    "AGG-14",
    f"""SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, count(*) AS contracts_count,
               {sql_total("o_totalprice")} AS total_amount, {sql_mean_rounded("o_totalprice")} AS avg_amount
        FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def by_month(t):
    month = F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM").alias("month")
    return t.orders.where("o_orderstatus = 'F'").groupBy(month).agg(
        F.count("*").alias("contracts_count"),
        total("o_totalprice").alias("total_amount"),
        mean_rounded("o_totalprice").alias("avg_amount"),
    )


@query(
    "AGG-15",
    f"""SELECT o_orderpriority, {sql_mean_rounded("l_quantity")} AS avg_distance, count(*) AS trip_count,
               max(date_diff('second', o_orderdate, l_shipdate)) AS max_duration_sec
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
)
def longest_duration(t):
    # One row per order meets the orders: its last line makes its longest duration.
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(money("l_quantity")).alias("distance"),
        F.count("l_quantity").alias("measured"),
        F.count("*").alias("trips"),
        F.max("l_shipdate").alias("last"),
    )
    joined = t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        mean_of_rounded("distance", "measured").alias("avg_distance"),
        F.sum("trips").alias("trip_count"),
        F.expr("max(timestampdiff(SECOND, o_orderdate, last))").alias("max_duration_sec"),
    )


@query(
    "AGG-16",
    f"""SELECT c_custkey, c_name, count(event_id) AS reviews_count, coalesce({sql_mean("value")}, 0.0) AS avg_rating
        FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey, c_name""",
)
def coalesced_mean(t):
    ratings = t.events.groupBy("user_id").agg(F.count("*").alias("_n"), mean("value").alias("_mean"))
    joined = t.customer.join(ratings, F.col("c_custkey") == F.col("user_id"), "left")
    return joined.select(
        "c_custkey",
        "c_name",
        F.coalesce("_n", F.lit(0)).alias("reviews_count"),
        F.coalesce("_mean", F.lit(0.0)).alias("avg_rating"),
    )


@query(
    "AGG-17",
    """SELECT o_custkey, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS categories
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_custkey""",
)
def distinct_list(t):
    pairs = (
        t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select("o_custkey", "p_brand")
        .distinct()
    )
    return pairs.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("categories")
    )


@query(
    "AGG-18",
    f"""SELECT s_name, n_name, count(l_orderkey) AS ads, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS active,
               {sql_mean("l_extendedprice")} AS avg_price
        FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN lineitem ON s_suppkey = l_suppkey
        WHERE l_extendedprice > 20000 GROUP BY s_name, n_name HAVING count(l_orderkey) > 350
        ORDER BY ads DESC, avg_price DESC""",
)
def complete_select(t):
    sums = t.lineitem.where("l_extendedprice > 20000").groupBy("l_suppkey").agg(
        F.count("l_orderkey").alias("ads"),
        F.sum(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).alias("active"),
        mean("l_extendedprice").alias("avg_price"),
    )
    joined = (
        sums.where("ads > 350")
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.select("s_name", "n_name", "ads", "active", "avg_price").orderBy(
        F.col("ads").desc(), F.col("avg_price").desc()
    )


@query(
    "AGG-19",
    """SELECT 'customer' AS table_name, count(*) AS rows_count FROM customer
       UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem
       UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part""",
)
def row_counts(t):
    counts = [
        getattr(t, name).agg(F.count("*").alias("rows_count")).select(F.lit(name).alias("table_name"), "rows_count")
        for name in ("customer", "events", "lineitem", "orders", "part")
    ]
    result = counts[0]
    for item in counts[1:]:
        result = result.union(item)
    return result


@query(
    "AGG-20",
    """WITH performance AS (
         SELECT strftime(o_orderdate, '%Y-%m') AS month, o_custkey, count(*) AS contracts
         FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)
       SELECT month, c_name AS top_seller, contracts FROM performance p JOIN customer ON o_custkey = c_custkey
       WHERE contracts = (SELECT max(contracts) FROM performance q WHERE q.month = p.month)""",
)
def top_of_month(t):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    performance = t.orders.where("o_orderstatus = 'F'").groupBy(month, "o_custkey").agg(
        F.count("*").alias("contracts")
    )
    best = performance.groupBy("month").agg(F.max("contracts").alias("contracts"))
    leaders = performance.join(best, ["month", "contracts"])
    named = leaders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return named.select("month", F.col("c_name").alias("top_seller"), "contracts")
