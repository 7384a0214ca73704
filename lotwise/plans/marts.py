"""The warehouse over the given tables: lines are enrollments, suppliers users, parts flows, brands units."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.money import mean_rounded, money, sql_mean, sql_mean_rounded
from lotwise.operators import warehouse as dw
from lotwise.operators.market import active_ads, average_rating
from lotwise.plans.registry import query
from lotwise.sources.workspace import stage, together


def enrollment(t):
    status = F.expr("CASE l_returnflag WHEN 'A' THEN 'active' WHEN 'N' THEN 'dropped' ELSE 'completed' END")
    return t.lineitem.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_partkey").alias("flow_id"),
        F.col("l_shipdate").alias("enrolled_at"),
        F.when(F.col("l_returnflag") == "N", F.expr("l_shipdate + interval 30 days")).alias("dropped_at"),
        F.col("l_discount").alias("attendance"),
        F.col("l_quantity").alias("score"),
        status.alias("status"),
    )


STATUS = "CASE l_returnflag WHEN 'A' THEN 'active' WHEN 'N' THEN 'dropped' ELSE 'completed' END"


def unit_dimension(t):
    names = t.part.select(F.col("p_brand").alias("unit_id")).distinct().withColumn("name", F.col("unit_id"))
    return dw.dimension(names, "unit_id", "unit_key")


def user_dimension(t):
    return dw.dimension(t.supplier.select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("full_name")), "user_id", "user_key")


def flow_dimension(t):
    rows = t.part.select(
        F.col("p_partkey").alias("flow_id"),
        F.concat(F.lit("F"), F.col("p_partkey").cast("string")).alias("code"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("modality"),
        F.col("p_brand").alias("unit_id"),
    )
    return dw.dimension(rows, "flow_id", "flow_key")


def star(t):
    rows = enrollment(t)
    dates, unit, user, flow = together(
        lambda: stage(dw.calendar(rows, "enrolled_at", "dropped_at"), "dates"),
        lambda: unit_dimension(t),
        lambda: user_dimension(t),
        lambda: flow_dimension(t),
    )
    return dw.enrollment_fact(rows, user, flow, unit), dates, user, flow, unit


def wide(t):
    unit, user, flow = together(lambda: unit_dimension(t), lambda: user_dimension(t), lambda: flow_dimension(t))
    return dw.wide_extract(enrollment(t), user, flow, unit)


@query(
    "DW-1",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date, CAST(year(d) AS INTEGER) AS year,
              CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
              CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_name, isodow(d) IN (6, 7) AS is_weekend
       FROM (SELECT unnest(generate_series((SELECT min(l_shipdate) - INTERVAL 1 YEAR FROM lineitem),
              (SELECT max(CASE WHEN l_returnflag = 'N' THEN l_shipdate + INTERVAL 30 DAY ELSE l_shipdate END) + INTERVAL 1 YEAR FROM lineitem),
              INTERVAL 1 DAY)) AS d)""",
)
def calendar(t):
    dates = dw.calendar(enrollment(t), "enrolled_at", "dropped_at")
    return dates.withColumn("full_date", F.col("full_date").cast("string"))


@query(
    "DW-2",
    """SELECT 'flow' AS dimension, row_number() OVER (ORDER BY p_partkey) AS surrogate, CAST(p_partkey AS VARCHAR) AS natural FROM part
       UNION ALL SELECT 'user', row_number() OVER (ORDER BY s_suppkey), CAST(s_suppkey AS VARCHAR) FROM supplier
       UNION ALL SELECT 'unit', row_number() OVER (ORDER BY p_brand), p_brand FROM (SELECT DISTINCT p_brand FROM part)""",
)
def surrogate_keys(t):
    def keys(name, rows, surrogate, natural):
        return rows.select(
            F.lit(name).alias("dimension"), F.col(surrogate).alias("surrogate"), F.col(natural).cast("string").alias("natural")
        )

    flows = keys("flow", flow_dimension(t), "flow_key", "flow_id")
    users = keys("user", user_dimension(t), "user_key", "user_id")
    return flows.union(users).union(keys("unit", unit_dimension(t), "unit_key", "unit_id"))


@query(
    "DW-3",
    f"""WITH u AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS user_key FROM supplier),
             f AS (SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_partkey) AS flow_key FROM part),
             n AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS unit_key FROM (SELECT DISTINCT p_brand FROM part))
        SELECT l_orderkey AS enrollment_id, l_linenumber AS line, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS enroll_date_key,
               CASE WHEN l_returnflag = 'N' THEN CAST(strftime(l_shipdate + INTERVAL 30 DAY, '%Y%m%d') AS INTEGER) END AS drop_date_key,
               user_key, flow_key, unit_key, l_discount AS attendance, l_quantity AS score,
               CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS is_dropped, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_completed,
               1 AS enrollment_cnt, {STATUS} AS status
        FROM lineitem JOIN u ON s_suppkey = l_suppkey JOIN f ON p_partkey = l_partkey JOIN n ON n.p_brand = f.p_brand""",
)
def fact_table(t):
    return star(t)[0]


@query(
    "DW-4",
    f"""SELECT l_orderkey AS enrollment_id, l_linenumber AS line, strftime(l_shipdate, '%Y-%m-%d') AS enroll_date, 'F' || p_partkey AS flow_code,
               p_name AS flow_title, p_brand AS unit_name, p_type AS modality, {STATUS} AS status, l_discount AS attendance, l_quantity AS score,
               CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS is_dropped, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_completed, 1 AS enrollment_cnt
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey AND p_brand IS NOT NULL""",
)
def wide_extract(t):
    return wide(t).withColumn("enroll_date", F.col("enroll_date").cast("string"))


@query(
    "DW-5",
    f"""SELECT strftime(l_shipdate, '%Y-%m-%d') AS enroll_date, count(*) AS enrollments, {sql_mean("l_quantity")} AS avg_score,
               {sql_mean("l_discount")} AS avg_attendance
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey AND p_brand IS NOT NULL GROUP BY 1""",
)
def daily_activity(t):
    return dw.daily_mart(wide(t)).withColumn("enroll_date", F.col("enroll_date").cast("string"))


@query(
    "DW-6",
    """SELECT 'F' || p_partkey AS flow_code, p_name AS flow_title, count(*) AS total_enrollments,
              count(*) FILTER (WHERE l_returnflag = 'R') AS completed_cnt, count(*) FILTER (WHERE l_returnflag = 'N') AS dropped_cnt,
              count(*) FILTER (WHERE l_returnflag = 'R') / count(*) * 100 AS completion_rate
       FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey AND p_brand IS NOT NULL GROUP BY p_partkey, p_name""",
)
def popularity(t):
    return dw.popularity_mart(wide(t))


@query(
    "DW-7",
    f"""SELECT {STATUS} AS status, count(*) AS cnt, count(*) * 100.0 / sum(count(*)) OVER () AS pct
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey AND p_brand IS NOT NULL GROUP BY 1""",
)
def status_funnel(t):
    return dw.funnel_mart(wide(t))


@query(
    "DW-8",
    f"""SELECT p_brand AS unit_name, count(*) AS enrollments, {sql_mean("l_quantity")} AS avg_score
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey AND p_brand IS NOT NULL GROUP BY p_brand""",
)
def unit_summary(t):
    return dw.unit_mart(wide(t))


@query(
    "DW-9",
    """SELECT p_partkey, p_name, count(*) AS total_enrollments FROM lineitem JOIN part ON l_partkey = p_partkey
       GROUP BY p_partkey, p_name ORDER BY total_enrollments DESC, p_partkey LIMIT 10""",
)
def top_courses(t):
    counts = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("total_enrollments"))
    joined = counts.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("p_partkey", "p_name", "total_enrollments").orderBy(F.col("total_enrollments").desc(), "p_partkey").limit(10)


@query(
    "DW-10",
    """SELECT upper(trim(p_name)) AS code, p_brand AS title, TRY_CAST(CASE WHEN p_size % 10 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS ects_credits,
              upper(p_type) AS unit_code, p_partkey AS position
       FROM part WHERE p_partkey IN (SELECT max(p_partkey) FROM part GROUP BY upper(trim(p_name)))""",
)
def catalogue_cleaning(t):
    credits = F.when(F.col("p_size") % 10 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    raw = t.part.select(
        F.concat(F.lit(" "), "p_name").alias("code"),
        F.concat("p_brand", F.lit("  ")).alias("title"),
        credits.alias("ects_credits"),
        F.lower("p_type").alias("unit_code"),
        F.col("p_partkey").alias("position"),
    )
    return dw.clean_catalogue(raw, "position")


@query(
    "DW-11",
    """SELECT n_name AS building, c_mktsegment AS room_number, CASE WHEN n_regionkey = 1 THEN '' ELSE 'campus ' || n_regionkey END AS campus,
              CAST(floor(c_acctbal) AS INTEGER) AS capacity, coalesce(c_acctbal > 5000 AND n_regionkey <> 2, FALSE) AS has_projector,
              FALSE AS has_pc, TRUE AS is_accessible, CASE WHEN c_acctbal < 500 THEN 'closed' ELSE 'active' END AS status, c_custkey AS position
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       WHERE c_custkey IN (SELECT min(c_custkey) FROM customer GROUP BY c_nationkey, c_mktsegment)""",
)
def room_cleaning(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    raw = joined.select(
        F.concat(F.lit(" "), "n_name").alias("building"),
        F.concat("c_mktsegment", F.lit(" ")).alias("room_number"),
        F.when(F.col("n_regionkey") != 1, F.concat(F.lit("campus "), F.col("n_regionkey").cast("string"))).alias("campus"),
        F.floor("c_acctbal").cast("int").alias("capacity"),
        F.when(F.col("n_regionkey") != 2, F.col("c_acctbal") > 5000).alias("has_projector"),
        F.lit(None).cast("boolean").alias("has_pc"),
        F.lit(True).alias("is_accessible"),
        F.when(F.col("c_acctbal") < 500, "closed").alias("status"),
        F.col("c_custkey").alias("position"),
    )
    return dw.clean_rooms(raw, "position")


@query(
    "DW-12",
    """SELECT p_partkey, p_brand AS code, (SELECT min(n_nationkey) FROM nation WHERE 'Brand#' || n_nationkey = p_brand AND n_regionkey <> 3) AS n_nationkey FROM part""",
)
def parent_lookup(t):
    parents = t.nation.where("n_regionkey <> 3").select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("unit_code"), "n_nationkey"
    )
    rows = t.part.select("p_partkey", F.col("p_brand").alias("code"))
    return dw.resolve_parent(rows, "code", parents, "unit_code", "n_nationkey")


@query(
    "DW-13",
    """SELECT 'run-1' AS run_id, 'part' AS source_name, count(*) AS rows_loaded FROM part UNION ALL SELECT 'run-1', 'customer', count(*) FROM customer
       UNION ALL SELECT 'run-2', 'part', count(*) FROM part WHERE p_size > 10""",
)
def load_log(t):
    empty = t.spark.createDataFrame([], "run_id string, source_name string, rows_loaded bigint")
    log = dw.log_loads(empty, "run-1", [("part", t.part.where("p_size > 40")), ("customer", t.customer)])
    log = dw.log_loads(log, "run-2", [("part", t.part.where("p_size > 10"))])
    return dw.log_loads(log, "run-1", [("part", t.part), ("customer", t.customer)])


@query(
    "DW-14",
    """(SELECT event_id AS run_id, 'job ' || user_id AS job, CAST(floor(value * 10) AS BIGINT) AS seconds, 'failed' AS status
        FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 20)
       UNION ALL (SELECT event_id, 'job ' || user_id, CAST(floor(value * 10) AS BIGINT), 'succeeded'
        FROM events WHERE event_type <> 'error' ORDER BY ts DESC, event_id DESC LIMIT 20)""",
)
def run_history(t):
    runs = t.events.select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("job "), F.col("user_id").cast("string")).alias("job"),
        F.col("ts").alias("started"),
        F.timestamp_add("SECOND", F.floor(F.col("value") * 10), F.col("ts")).alias("ended"),
        F.when(F.col("event_type") == "error", "failed").otherwise("succeeded").alias("status"),
    )
    both = dw.last_runs(runs, "failed").union(dw.last_runs(runs, "succeeded"))
    return both.select("run_id", "job", "seconds", "status")


@query(
    "DW-15",
    f"""SELECT s_suppkey, concat('Seller: ', s_name, chr(10), 'Mean rating: ', printf('%.2f', coalesce(rating, 0.0)), chr(10), 'Active ads: ', coalesce(n, 0), chr(10),
               'Total price: ', coalesce(total, CAST(0 AS DECIMAL(28,2)))) AS statistics
        FROM supplier LEFT JOIN (SELECT l_suppkey, {sql_mean_rounded("l_quantity")} AS rating FROM lineitem GROUP BY l_suppkey) r ON r.l_suppkey = s_suppkey
        LEFT JOIN (SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM lineitem
                   WHERE l_returnflag = 'A' GROUP BY l_suppkey) a ON a.l_suppkey = s_suppkey""",
)
def seller_report(t):
    ratings = average_rating(t.supplier, "s_suppkey", t.lineitem, "l_suppkey", "l_quantity")
    ads = active_ads(t.supplier, "s_suppkey", t.lineitem, "l_suppkey", F.col("l_returnflag") == "A", "l_extendedprice")
    joined = t.supplier.join(ratings, "s_suppkey").join(ads, "s_suppkey")
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("Seller: "), F.coalesce("s_name", F.lit("not found"))),
        F.concat(F.lit("Mean rating: "), F.format_string("%.2f", "avg_rating")),
        F.concat(F.lit("Active ads: "), F.col("active_ads").cast("string")),
        F.concat(F.lit("Total price: "), F.col("total_price").cast("string")),
    )
    return joined.select("s_suppkey", lines.alias("statistics"))
