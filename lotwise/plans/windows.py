"""Window functions. Means, shares and extremes of a group are aggregates joined back; ordered functions run on
range slices, so neither a hot key nor a window without keys ends up in one task."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lotwise.functions.money import mean, money, sql_mean, sql_total, total
from lotwise.operators.ordered import Frame, day_of, joined_null_safe, ranks, row_frames, row_numbers, tiles, value_frames
from lotwise.plans.registry import query
from lotwise.sources.workspace import stage


@query(
    "WIN-1",
    f"""SELECT p_brand, p_type, l_orderkey, l_linenumber, l_extendedprice,
               {sql_mean("l_extendedprice").replace(")) AS DOUBLE)", ")) OVER fine AS DOUBLE)").replace("count(l_extendedprice)", "count(l_extendedprice) OVER fine")} AS avg_brand_type,
               {sql_mean("l_extendedprice").replace(")) AS DOUBLE)", ")) OVER coarse AS DOUBLE)").replace("count(l_extendedprice)", "count(l_extendedprice) OVER coarse")} AS avg_brand
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WINDOW fine AS (PARTITION BY p_brand, p_type), coarse AS (PARTITION BY p_brand)""",
)
def means_at_two_levels(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    sums = joined.groupBy("p_brand", "p_type").agg(
        F.sum(money("l_extendedprice")).alias("_s"), F.count("l_extendedprice").alias("_n")
    )
    fine = sums.select("p_brand", "p_type", (F.col("_s").cast("double") / F.col("_n")).alias("avg_brand_type"))
    coarse = sums.groupBy("p_brand").agg((F.sum("_s").cast("double") / F.sum("_n")).alias("avg_brand"))
    means = joined_null_safe(fine, coarse, ["p_brand"])
    return joined_null_safe(joined, means, ["p_brand", "p_type"]).select(
        "p_brand", "p_type", "l_orderkey", "l_linenumber", "l_extendedprice", "avg_brand_type", "avg_brand"
    )


@query(
    "WIN-2",
    """SELECT s_suppkey, s_name, s_nationkey, count(l_orderkey) AS ads_count,
              count(l_orderkey) * 100.0 / sum(count(l_orderkey)) OVER (PARTITION BY s_nationkey) AS percentage
       FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey GROUP BY s_suppkey, s_name, s_nationkey""",
)
def share_in_group(t):
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("_n"))
    sellers = t.supplier.join(counts, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        "s_suppkey", "s_name", "s_nationkey", F.coalesce("_n", F.lit(0)).alias("ads_count")
    )
    totals = sellers.groupBy("s_nationkey").agg(F.sum("ads_count").alias("_all"))
    share = F.col("ads_count") * F.lit(100.0) / F.col("_all")
    return joined_null_safe(sellers, totals, ["s_nationkey"]).select(
        "s_suppkey", "s_name", "s_nationkey", "ads_count", share.alias("percentage")
    )


@query(
    "WIN-3",
    """SELECT l_returnflag AS status, count(*) AS cnt, 100.0 * count(*) / sum(count(*)) OVER () AS pct
       FROM lineitem GROUP BY l_returnflag""",
)
def share_of_total(t):
    counts = t.lineitem.groupBy(F.col("l_returnflag").alias("status")).agg(F.count("*").alias("cnt"))
    # The empty OVER runs on one row per status.
    return counts.withColumn("pct", F.lit(100.0) * F.col("cnt") / F.sum("cnt").over(Window.partitionBy()))


@query(
    "WIN-4",
    """SELECT o_orderpriority, o_orderkey, o_totalprice,
              row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) AS place
       FROM orders""",
)
def row_number_in_group(t):
    orders = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return row_numbers(orders, ["o_orderpriority"], ["-o_totalprice", "o_orderkey"], "place")


RANK_SQL = """SELECT p_brand, l_orderkey, l_linenumber, l_quantity,
                     {name}() OVER (PARTITION BY p_brand ORDER BY l_quantity DESC NULLS FIRST) AS in_brand,
                     {name}() OVER (ORDER BY l_quantity DESC NULLS FIRST) AS overall
              FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _ranked(t, position):
    # Equal values are counted per part, then per brand, then overall; both rank tables hold one row per value, and the
    # lines are joined only to them.
    per_part = t.lineitem.groupBy("l_partkey", "l_quantity").agg(F.count("*").alias("n"))
    counted = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "l_quantity").agg(F.sum("n").alias("n"))
    counted = stage(counted, "counted")
    # Both levels are ranked in one pass: the whole table is a group beside the brands.
    both = counted.withColumn("level", F.lit(1)).unionByName(counted.withColumns({"level": F.lit(0), "p_brand": F.lit(None).cast("string")}))
    ranked = ranks(both, ["level", "p_brand"], "l_quantity", count=F.sum("n"))
    inside = ranked.where("level = 1").withColumnRenamed(position, "in_brand")
    overall = ranked.where("level = 0").withColumnRenamed(position, "overall")
    places = joined_null_safe(inside.select("p_brand", "l_quantity", "in_brand"), overall.select("l_quantity", "overall"), ["l_quantity"])
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select("p_brand", "l_orderkey", "l_linenumber", "l_quantity")
    return joined_null_safe(rows, places, ["p_brand", "l_quantity"])


@query("WIN-5", RANK_SQL.format(name="rank"))
def rank(t):
    return _ranked(t, "position")


@query("WIN-6", RANK_SQL.format(name="dense_rank"))
def dense_rank(t):
    return _ranked(t, "dense_position")


@query(
    "WIN-7",
    """SELECT o_orderkey, o_totalprice, ntile(4) OVER (ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) AS quartile,
              CASE ntile(4) OVER (ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) WHEN 1 THEN 'high' WHEN 2 THEN 'above middle'
                   WHEN 3 THEN 'below middle' ELSE 'low' END AS category
       FROM orders""",
)
def quartiles(t):
    tiled = tiles(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 4, "quartile")
    label = F.expr("CASE quartile WHEN 1 THEN 'high' WHEN 2 THEN 'above middle' WHEN 3 THEN 'below middle' ELSE 'low' END")
    return tiled.withColumn("category", label)


@query(
    "WIN-8",
    "SELECT row_number() OVER (ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey) AS row_num, o_orderkey, o_totalprice FROM orders",
)
def global_row_number(t):
    return row_numbers(t.orders.select("o_orderkey", "o_totalprice"), [], ["-o_totalprice", "o_orderkey"], "row_num")


MONTHLY = f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, {sql_total("o_totalprice")} AS amount
              FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"""


def _monthly(t):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    return t.orders.where("o_orderstatus = 'F'").groupBy(month).agg(total("o_totalprice").alias("amount"))


@query(
    "WIN-9",
    f"""SELECT month, amount, CAST(sum(amount) OVER (ORDER BY month) AS DECIMAL(28,2)) AS cumulative FROM ({MONTHLY})""",
)
def running_months(t):
    # The window runs over one row per month, not over the orders.
    running = F.sum("amount").over(Window.orderBy(F.col("month").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    return _monthly(t).withColumn("cumulative", running.cast("decimal(28,2)"))


@query(
    "WIN-10",
    f"""SELECT month, amount, CAST(sum(amount) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg
        FROM ({MONTHLY}) WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def moving_months(t):
    w = Window.orderBy(F.col("month").asc_nulls_last()).rowsBetween(-2, 0)
    return _monthly(t).withColumn("moving_avg", F.sum("amount").over(w).cast("double") / F.count("*").over(w))


@query(
    "WIN-11",
    """SELECT o_orderkey, o_totalprice,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg
       FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def moving_rows(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")

    def columns(window):
        frame = window.rowsBetween(-2, 0)
        return {"moving_avg": F.sum(money("o_totalprice")).over(frame).cast("double") / F.count("*").over(frame)}

    return row_frames(rows, [], ["o_orderdate", "o_orderkey"], columns, before=2, slice_of=day_of("o_orderdate")).drop("o_orderdate")


@query(
    "WIN-12",
    """SELECT o_orderkey, o_totalprice,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS avg_similar
       FROM orders
       WINDOW w AS (ORDER BY CAST(round(o_totalprice * 100) AS BIGINT) RANGE BETWEEN 500000 PRECEDING AND 500000 FOLLOWING)""",
)
def similar_prices(t):
    cents = (money("o_totalprice") * 100).cast("bigint")
    rows = t.orders.select("o_orderkey", "o_totalprice", cents.alias("_cents"))
    measures = {"sum": F.sum(money("o_totalprice")), "n": F.count("*")}
    framed = value_frames(rows, "_cents", [Frame(500000, 500000, measures, "_w_")])
    average = F.col("_w_sum").cast("double") / F.col("_w_n")
    return framed.select("o_orderkey", "o_totalprice", average.alias("avg_similar"))


@query(
    "WIN-13",
    """SELECT o_orderkey, o_custkey, o_totalprice,
              count(*) OVER (ORDER BY o_orderdate RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS last_7_days,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER
                   (ORDER BY o_orderdate RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS amount_30_days
       FROM orders""",
)
def interval_ranges(t):
    second = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", second.alias("_second"))
    day = 86400
    week = Frame(7 * day, 0, {"n": F.count("*")}, "_week_")
    month = Frame(30 * day, 0, {"sum": F.sum(money("o_totalprice"))}, "_month_")
    both = value_frames(rows, "_second", [week, month])
    return both.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.col("_week_n").alias("last_7_days"),
        F.col("_month_sum").cast("decimal(28,2)").alias("amount_30_days"),
    )


@query(
    "WIN-14",
    """SELECT o_orderkey, o_totalprice, lag(o_totalprice) OVER w AS prev_price,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) - lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DECIMAL(18,2)) AS difference
       FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""",
)
def lag(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")

    def columns(window):
        change = money("o_totalprice") - F.lag(money("o_totalprice")).over(window)
        return {"prev_price": F.lag("o_totalprice").over(window), "difference": change.cast("decimal(18,2)")}

    return row_frames(rows, [], ["o_orderdate", "o_orderkey"], columns, before=1, slice_of=day_of("o_orderdate")).drop("o_orderdate")


@query(
    "WIN-15",
    """SELECT o_custkey, o_orderkey, o_totalprice, lead(o_totalprice) OVER w AS next_price,
              CAST(lead(CAST(o_totalprice AS DECIMAL(18,2))) OVER w - CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS change_to_next
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def lead(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")

    def columns(window):
        change = F.lead(money("o_totalprice")).over(window) - money("o_totalprice")
        return {"next_price": F.lead("o_totalprice").over(window), "change_to_next": change.cast("decimal(18,2)")}

    return row_frames(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], columns, after=1, slice_of=day_of("o_orderdate", 90)).drop("o_orderdate")


def _extreme(t, function, name):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_brand", "l_orderkey", "l_linenumber", money("l_extendedprice").alias("price")
    )
    return joined_null_safe(rows, rows.groupBy("p_brand").agg(function("price").alias(name)), ["p_brand"])


@query(
    "WIN-16",
    """SELECT p_brand, l_orderkey, l_linenumber, price, first_value(price) OVER w AS lowest,
              CAST(price - first_value(price) OVER w AS DECIMAL(18,2)) AS above_lowest
       FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem JOIN part ON l_partkey = p_partkey)
       WINDOW w AS (PARTITION BY p_brand ORDER BY price)""",
)
def first_value(t):
    difference = (F.col("price") - F.col("lowest")).cast("decimal(18,2)")
    return _extreme(t, F.min, "lowest").withColumn("above_lowest", difference)


@query(
    "WIN-17",
    """SELECT p_brand, l_orderkey, l_linenumber, price, last_value(price) OVER w AS highest,
              CAST(last_value(price) OVER w - price AS DECIMAL(18,2)) AS below_highest
       FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem JOIN part ON l_partkey = p_partkey)
       WINDOW w AS (PARTITION BY p_brand ORDER BY price ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def last_value(t):
    difference = (F.col("highest") - F.col("price")).cast("decimal(18,2)")
    return _extreme(t, _last, "highest").withColumn("below_highest", difference)


def _last(column):
    # Nulls come last, so one null price is the last value.
    return F.when(F.count(column) == F.count("*"), F.max(column))


@query(
    "WIN-18",
    """WITH history AS (SELECT event_id, user_id, CAST(value AS DECIMAL(18,2)) AS value,
                               lag(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
                        FROM events)
       SELECT event_id, user_id, value, CAST(coalesce(value - prev, 0) AS DECIMAL(18,2)) AS increase FROM history
       WHERE coalesce(value - prev, 0) > 0""",
)
def increases(t):
    rows = t.events.select("event_id", "user_id", money("value").alias("value"), "ts")
    history = row_frames(
        rows, ["user_id"], ["ts", "event_id"], lambda w: {"_prev": F.lag("value").over(w)}, before=1, slice_of=day_of("ts")
    )
    increase = F.coalesce(F.col("value") - F.col("_prev"), F.lit(0)).cast("decimal(18,2)")
    return history.select("event_id", "user_id", "value", increase.alias("increase")).where("increase > 0")


@query("WIN-19", "SELECT c_custkey, ntile(10) OVER (ORDER BY c_custkey) AS decile FROM customer")
def deciles(t):
    return tiles(t.customer.select("c_custkey"), ["c_custkey"], 10, "decile")
