"""Queue, series and trigger queries. Those ending in -stream run the same work through Structured Streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.money import mean, money, sql_mean
from lotwise.plans.registry import query
from lotwise.sources.tables import SCHEMAS
from lotwise.sources.workspace import new_path
from lotwise.streaming import keyed, queue, runtime, series, triggers

#: For streams over a finished table, whose rows come in any order of time.
ANY_AGE = "36500 days"


def event_stream(t):
    return runtime.file_stream(t.spark, t.path("events"), SCHEMAS["events"])


@query("ST-1", "SELECT event_id, user_id, event_type FROM events")
def consume(t):
    rows = event_stream(t).select("event_id", "user_id", "event_type")
    return runtime.collected(rows)


TASKS = """SELECT o_orderkey AS task_id, 6 - CAST(left(o_orderpriority, 1) AS INTEGER) AS priority, o_orderdate AS created_at,
                  o_orderdate + to_days(CAST(o_custkey % 90 AS INTEGER)) AS scheduled_at,
                  CASE o_orderstatus WHEN 'P' THEN 'Ready' WHEN 'O' THEN 'Running' ELSE 'Completed' END AS status FROM orders"""


def tasks_of(t):
    return t.orders.select(
        F.col("o_orderkey").alias("task_id"),
        (6 - F.left("o_orderpriority", F.lit(1)).cast("int")).alias("priority"),
        F.col("o_orderdate").alias("created_at"),
        F.timestamp_add("DAY", F.col("o_custkey") % 90, F.col("o_orderdate")).alias("scheduled_at"),
        F.expr("CASE o_orderstatus WHEN 'P' THEN 'Ready' WHEN 'O' THEN 'Running' ELSE 'Completed' END").alias("status"),
    )


@query(
    "ST-2",
    f"""SELECT task_id, priority FROM ({TASKS}) WHERE status = 'Ready' AND scheduled_at <= (SELECT max(o_orderdate) FROM orders)
        ORDER BY priority DESC, created_at, task_id LIMIT 20""",
)
def dispatch(t):
    as_of = t.orders.agg(F.max("o_orderdate")).scalar()
    return queue.dispatch_plan(tasks_of(t), as_of, 20).select("task_id", "priority")


FOLDED = """WITH outcomes AS (SELECT user_id AS task_id, event_id AS seq, ts, event_type IN ('purchase', 'view') AS success FROM events WHERE user_id IS NOT NULL),
                 done AS (SELECT task_id, min(seq) AS done FROM outcomes WHERE success GROUP BY task_id),
                 failed AS (SELECT task_id, count(*) AS n, max(epoch_us(ts)) AS last FROM outcomes LEFT JOIN done USING (task_id)
                            WHERE NOT success AND (done IS NULL OR seq < done) GROUP BY task_id)
            SELECT c_custkey AS task_id, CASE WHEN done IS NOT NULL THEN 'Completed' ELSE 'Ready' END AS status, coalesce(n, 0) AS attempts,
                   coalesce(last + 300000000, epoch_us(TIMESTAMP '2024-01-01')) AS scheduled_us,
                   CASE WHEN n IS NOT NULL THEN 'Processing failed' END AS last_error
            FROM customer LEFT JOIN done ON done.task_id = c_custkey LEFT JOIN failed ON failed.task_id = c_custkey"""


def open_tasks(t):
    return t.customer.select(
        F.col("c_custkey").alias("task_id"),
        F.lit("Ready").alias("status"),
        F.lit(0).cast("bigint").alias("attempts"),
        F.lit("2024-01-01").cast("timestamp").alias("scheduled_at"),
        F.lit(None).cast("string").alias("last_error"),
    )


def outcomes_of(events):
    return events.select(
        F.col("user_id").alias("task_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("at"),
        F.col("event_type").isin("purchase", "view").alias("success"),
    )


def _folded(tasks):
    return tasks.select(
        "task_id", "status", "attempts", F.unix_micros("scheduled_at").alias("scheduled_us"), "last_error"
    )


@query("ST-3", FOLDED)
def retries(t):
    return _folded(queue.fold_outcomes(open_tasks(t), outcomes_of(t.events)))


@query("ST-3-stream", FOLDED)
def retries_streamed(t):
    outcomes = outcomes_of(event_stream(t))
    return _folded(keyed.retries(open_tasks(t), outcomes, new_path(t.spark, "retries"), ANY_AGE)[0])


@query(
    "ST-4",
    f"""WITH r AS (SELECT min(created_at) AS oldest, count(*) AS queue_size FROM ({TASKS}) WHERE status = 'Ready'),
             s AS (SELECT *, date_diff('second', oldest, (SELECT max(o_orderdate) FROM orders)) AS lag_seconds FROM r)
        SELECT strftime(oldest, '%Y-%m-%d') AS oldest_ready, queue_size, lag_seconds,
               printf('%02d:%02d', lag_seconds // 60 % 60, lag_seconds % 60) AS lag_text FROM s""",
)
def queue_lag(t):
    as_of = t.orders.agg(F.max("o_orderdate")).scalar()
    found = queue.lag(tasks_of(t), as_of)
    return found.withColumn("oldest_ready", F.date_format("oldest_ready", "yyyy-MM-dd"))


THROUGHPUT = """SELECT CAST(floor(epoch(ts) / 10) * 10 AS BIGINT) AS window_start, count(*) AS tasks, count(*) / 10 AS tasks_per_second
                FROM events WHERE event_type <> 'error' GROUP BY 1"""


def _rates(rows):
    return rows.withColumn("window_start", F.unix_timestamp("window_start"))


@query("ST-5", THROUGHPUT)
def throughput(t):
    done = t.events.where("event_type <> 'error'").withColumn("ts", F.col("ts").cast("timestamp"))
    return _rates(queue.throughput(done, "ts"))


@query("ST-5-stream", THROUGHPUT)
def throughput_streamed(t):
    done = event_stream(t).where("event_type <> 'error'").withWatermark("ts", "10 minutes")
    return _rates(runtime.final_result(queue.throughput(done, "ts"), ["window_start"]))


@query("ST-6", f"SELECT task_id, priority, status FROM ({TASKS}) ORDER BY priority DESC, created_at, task_id")
def priority_listing(t):
    return tasks_of(t).orderBy(F.col("priority").desc(), "created_at", "task_id").select("task_id", "priority", "status")


@query(
    "ST-7",
    """SELECT event_id, event_type, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTES ORDER BY ts DESC""",
)
def last_minutes(t):
    as_of = t.events.agg(F.max("ts")).scalar()
    rows = series.trailing(t.events, "ts", as_of, "5 minutes")
    return rows.orderBy(F.col("ts").desc()).select("event_id", "event_type", "value")


@query(
    "ST-8",
    f"""SELECT event_type AS location, {sql_mean("value")} AS avg_temp, count(value) AS readings FROM events
        WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY event_type""",
)
def last_hour(t):
    as_of = t.events.agg(F.max("ts")).scalar()
    rows = series.trailing(t.events, "ts", as_of, "1 hour")
    return rows.groupBy(F.col("event_type").alias("location")).agg(
        mean("value").alias("avg_temp"), F.count("value").alias("readings")
    )


GROWN = """(SELECT event_type, user_id, ts, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS increase
            FROM (SELECT event_type, user_id, ts, CAST(value AS DECIMAL(18,2)) AS value,
                         lag(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS prev FROM events))"""
DEALT = f"(SELECT event_type, user_id, CAST(floor(epoch(ts) / 15) * 15 AS BIGINT) - i * 15 AS window_start, increase FROM {GROWN}, (SELECT unnest(range(20)) AS i))"


def _grown(t):
    cents = (money("value") * 100).cast("bigint").alias("value")
    samples = t.events.select("event_id", "event_type", "user_id", "ts", cents)
    return series.increases(samples, ["event_type", "user_id"], "ts", "event_id", "value")


RATES = f"""SELECT event_type, window_start, CAST(sum(increase) AS DOUBLE) / 300 AS rate FROM {DEALT} GROUP BY ALL"""


@query("ST-9", RATES)
def counter_rates(t):
    return series.sliding_rates(_grown(t), ["event_type"], "ts", unit=100)


def _streamed_steps(t):
    """Growth of each series and step, from a stream of samples, as rows that the sliding windows take."""
    samples = event_stream(t).select("event_id", "event_type", "user_id", F.col("ts").alias("at"), (money("value") * 100).cast("bigint").alias("cents"))
    grown = keyed.counter_growth(samples, ["event_type", "user_id"], F.col("at"), "event_id", "cents", new_path(t.spark, "steps"), ANY_AGE)
    return grown.select("event_type", "user_id", F.timestamp_seconds("step").alias("ts"), F.col("growth").alias("increase"))


@query("ST-9-stream", RATES)
def counter_rates_streamed(t):
    return series.sliding_rates(_streamed_steps(t), ["event_type"], "ts", unit=100)


MEANS = f"""SELECT window_start, CAST(sum(increase) AS DOUBLE) / 300 / count(DISTINCT (event_type, user_id)) * 1000 AS mean_rate
            FROM {DEALT} GROUP BY window_start"""


@query("ST-10", MEANS)
def mean_rate(t):
    means = series.mean_rates(_grown(t), ["event_type", "user_id"], "ts", unit=100)
    return means.withColumn("mean_rate", F.col("mean_rate") * 1000)


@query("ST-10-stream", MEANS)
def mean_rate_streamed(t):
    means = series.mean_rates(_streamed_steps(t), ["event_type", "user_id"], "ts", unit=100)
    return means.withColumn("mean_rate", F.col("mean_rate") * 1000)


@query(
    "ST-11",
    """SELECT count(*) AS series, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS active FROM events
       WHERE event_id IN (SELECT max(event_id) FROM events GROUP BY user_id) AND event_type = 'click'""",
)
def gauge(t):
    samples = t.events.select("event_id", "user_id", "event_type", "value")
    last = series.last_values(samples, ["user_id"], [F.col("event_id")])
    return last.where("event_type = 'click'").agg(
        F.count("*").alias("series"), F.sum(money("value")).cast("decimal(28,2)").alias("active")
    )


NOTES = """SELECT user_id AS seller_id, event_id AS feedback_id, 'low_rating' AS notification_type,
                  'Low rating received: ' || CAST(value AS DECIMAL(18,2)) || '. Text: ' || coalesce(nullif(event_type, 'view'), 'no text') AS message
           FROM events WHERE value < 3.0"""


def _feedback(events):
    return events.select(
        F.col("event_id").alias("feedback_id"),
        F.col("user_id").alias("seller_id"),
        money("value").alias("rating"),
        F.expr("nullif(event_type, 'view')").alias("text"),
    )


@query("ST-12", NOTES)
def low_ratings(t):
    return triggers.low_rating_notes(_feedback(t.events))


@query("ST-12-stream", NOTES)
def low_ratings_streamed(t):
    return runtime.collected(triggers.low_rating_notes(_feedback(event_stream(t))))


@query(
    "ST-13",
    """SELECT 'vehicle' AS sink, event_id AS vehicle_id FROM events UNION ALL SELECT 'mileage', event_id FROM events WHERE event_type = 'click'""",
)
def derived_rows(t):
    state = F.when(F.col("event_type") == "click", "new").otherwise("used").alias("state")
    cars, log = triggers.with_first_mileage(t.spark, event_stream(t).select(F.col("event_id").alias("vehicle_id"), state))
    return cars.select(F.lit("vehicle").alias("sink"), "vehicle_id").union(log.select(F.lit("mileage"), "vehicle_id"))


@query("ST-14", "SELECT 'INSERT' AS operation_type, 'events' AS table_name, count(*) AS affected_rows FROM events")
def batch_log(t):
    log = triggers.operation_log(t.spark, event_stream(t), "INSERT", "events")
    return log.groupBy("operation_type", "table_name").agg(F.sum("affected_rows").alias("affected_rows"))


@query(
    "ST-15",
    """SELECT 'events' AS table_name, 'Bulk insert: ' || count(*) || ' rows. Names: ' || string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS message,
              count(*) AS record_count FROM events""",
)
def batch_alert(t):
    return triggers.batch_alerts(t.spark, event_stream(t), "event_type", "events").drop("batch")


CLEANED = """SELECT event_id AS id, upper(left(event_type, 1)) || lower(substring(event_type, 2)) || ' number ' || user_id AS header,
                    upper(event_type || lpad(CAST(event_id AS VARCHAR), 12, '0')) AS vin,
                    CASE WHEN length(event_type) <> 5 THEN 'vin' WHEN user_id % 7 = 0 THEN 'email' ELSE 'ok' END AS verdict
             FROM events"""


def _raw_ads(events):
    user = F.col("user_id").cast("string")
    return events.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("  "), "event_type", F.lit("   NUMBER  "), user, F.lit(" ")).alias("header"),
        F.concat(F.lit(" "), "event_type", F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("vin"),
        F.concat(F.lit("user"), user, F.when(F.col("user_id") % 7 == 0, "#mail").otherwise("@mail.test")).alias("email"),
    )


@query("ST-16", CLEANED)
def clean_on_ingest(t):
    return runtime.collected(triggers.clean_ads(_raw_ads(event_stream(t))).drop("email"))


CHANGES = """SELECT user_id AS ad_id, event_id AS seq, prev AS old_price, price AS new_price, CAST(price - prev AS DECIMAL(19,2)) AS difference
             FROM (SELECT user_id, event_id, CAST(value AS DECIMAL(18,2)) AS price,
                          lag(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events)
             WHERE prev IS NOT NULL AND prev <> price"""


def _prices(events):
    return events.select(F.col("user_id").alias("ad_id"), F.col("event_id").alias("seq"), money("value").alias("price"))


@query("ST-17", CHANGES)
def price_changes(t):
    return triggers.price_changes(_prices(t.events))


@query("ST-17-stream", CHANGES)
def price_changes_streamed(t):
    return keyed.price_changes(_prices(event_stream(t)), new_path(t.spark, "prices"))
