"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions import text
from lotwise.functions.bands import price_band, price_band_sql
from lotwise.functions.money import money
from lotwise.plans.registry import query


@query(
    "FN-1",
    """SELECT c_custkey, concat(nullif(c_mktsegment, 'BUILDING'), ': ', c_name) AS skips_nulls,
              nullif(c_mktsegment, 'BUILDING') || ': ' || c_name AS keeps_nulls FROM customer""",
)
def concatenation(t):
    segment = F.expr("nullif(c_mktsegment, 'BUILDING')")
    return t.customer.select(
        "c_custkey",
        F.concat_ws("", segment, F.lit(": "), F.col("c_name")).alias("skips_nulls"),
        F.concat(segment, F.lit(": "), F.col("c_name")).alias("keeps_nulls"),
    )


@query(
    "FN-2",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, upper(p_name) AS up, lower(p_brand) AS low,
              substring(p_name, 3, 4) AS piece, replace(p_name, ' ', '_') AS replaced, length(p_name) AS size FROM part""",
)
def string_functions(t):
    return t.part.select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.upper("p_name").alias("up"),
        F.lower("p_brand").alias("low"),
        F.substring("p_name", 3, 4).alias("piece"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("replaced"),
        F.length("p_name").cast("bigint").alias("size"),
    )


@query("FN-3", "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 17, 'V') AS vin FROM orders")
def left_pad(t):
    return t.orders.select("o_orderkey", F.lpad(F.col("o_orderkey").cast("string"), 17, "V").alias("vin"))


@query(
    "FN-4",
    "SELECT doc_id, regexp_replace(trim(replace(text, 'e', '  '), ' '), ' {2,}', ' ', 'g') AS cleaned FROM documents",
)
def collapse_spaces(t):
    spaced = F.replace(F.col("text"), F.lit("e"), F.lit("  "))
    return t.documents.select("doc_id", text.one_space(spaced).alias("cleaned"))


@query(
    "FN-5",
    "SELECT p_partkey, upper(substring(p_name, 1, 1)) || lower(substring(p_name, 2)) AS header FROM part",
)
def first_letter(t):
    return t.part.select("p_partkey", text.sentence_case("p_name").alias("header"))


@query(
    "FN-6",
    """SELECT s_suppkey, coalesce(nullif(s_nationkey, 3), -1) AS nation,
              greatest(0.0, s_acctbal - 5000) AS above FROM supplier""",
)
def coalesce_and_greatest(t):
    return t.supplier.select(
        "s_suppkey",
        F.coalesce(F.expr("nullif(s_nationkey, 3)"), F.lit(-1)).alias("nation"),
        F.greatest(F.lit(0.0), F.col("s_acctbal") - 5000).alias("above"),
    )


@query(
    "FN-7",
    """SELECT p_partkey, CAST(CAST(round(p_retailprice * 10) AS BIGINT) // 10 AS BIGINT) AS whole,
              power(p_size, 2) AS square, CAST(floor(p_retailprice / 7) AS BIGINT) AS sevenths,
              CAST(trunc(p_retailprice) AS BIGINT) AS cut FROM part""",
)
def rounding(t):
    tenths = F.round(F.col("p_retailprice") * 10).cast("bigint")
    return t.part.select(
        "p_partkey",
        F.floor(tenths / 10).alias("whole"),
        F.pow("p_size", F.lit(2)).alias("square"),
        F.floor(F.col("p_retailprice") / 7).alias("sevenths"),
        F.col("p_retailprice").cast("bigint").alias("cut"),
    )


@query(
    "FN-8",
    """SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour
       FROM events""",
)
def date_truncation(t):
    return t.events.select(
        "event_id",
        F.date_format(F.date_trunc("month", "ts"), "yyyy-MM-dd").alias("month"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH").alias("hour"),
    )


@query(
    "FN-9",
    """SELECT event_id, strftime(ts, '%Y-%m') AS month, strftime(ts, '%Y%m%d') AS day_key, strftime(ts, '%a') AS day_name,
              strftime(ts, '%M:%S') AS clock FROM events""",
)
def formatted_dates(t):
    formats = {"month": "yyyy-MM", "day_key": "yyyyMMdd", "day_name": "E", "clock": "mm:ss"}
    return t.events.select("event_id", *[F.date_format("ts", form).alias(name) for name, form in formats.items()])


@query(
    "FN-10",
    """SELECT event_id, year(ts) AS y, quarter(ts) AS q, month(ts) AS m, day(ts) AS d, isodow(ts) AS dow, hour(ts) AS h,
              CAST(floor(epoch(ts)) AS BIGINT) AS epoch FROM events""",
)
def date_parts(t):
    parts = {"y": F.year("ts"), "q": F.quarter("ts"), "m": F.month("ts"), "d": F.day("ts"), "dow": F.weekday("ts") + 1}
    return t.events.select(
        "event_id",
        *[part.cast("bigint").alias(name) for name, part in parts.items()],
        F.hour("ts").cast("bigint").alias("h"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("epoch"),
    )


@query(
    "FN-11",
    """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 YEAR, '%Y-%m-%d') AS year_before,
              strftime(o_orderdate + to_days(CAST(o_orderkey % 75 AS INTEGER)), '%Y-%m-%d') AS some_days_later FROM orders""",
)
def interval_arithmetic(t):
    return t.orders.select(
        "o_orderkey",
        F.date_format(F.expr("o_orderdate - INTERVAL 1 YEAR"), "yyyy-MM-dd").alias("year_before"),
        F.date_format(F.timestamp_add("DAY", F.col("o_orderkey") % 75, F.col("o_orderdate")), "yyyy-MM-dd").alias(
            "some_days_later"
        ),
    )


@query(
    "FN-12",
    """SELECT l_orderkey, l_linenumber, date_diff('second', o_orderdate, l_shipdate) AS seconds
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def seconds_between(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", F.expr("timestampdiff(SECOND, o_orderdate, l_shipdate)").alias("seconds")
    )


@query(
    "FN-13",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount * 100 END AS rate
       FROM lineitem""",
)
def guarded_ratio(t):
    rate = F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_tax") / F.col("l_discount") * 100)
    return t.lineitem.select("l_orderkey", "l_linenumber", rate.alias("rate"))


@query(
    "FN-14",
    """SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority,
              TRY_CAST(o_orderpriority AS INTEGER) AS bad FROM orders""",
)
def lenient_numbers(t):
    first = F.split_part("o_orderpriority", F.lit("-"), F.lit(1))
    return t.orders.select(
        "o_orderkey", first.try_cast("int").alias("priority"), F.col("o_orderpriority").try_cast("int").alias("bad")
    )


PRICE_OR_NULL = "CASE WHEN l_linenumber <> 7 THEN l_extendedprice END"


@query(
    "FN-15",
    f"""SELECT l_orderkey, l_linenumber, {price_band_sql(0.02)} AS band
        FROM (SELECT l_orderkey, l_linenumber, {PRICE_OR_NULL} AS price FROM lineitem)""",
)
def bands(t):
    priced = t.lineitem.select("l_orderkey", "l_linenumber", F.expr(PRICE_OR_NULL).alias("price"))
    return priced.select("l_orderkey", "l_linenumber", price_band(F.col("price"), 0.02).alias("band"))


@query("FN-16", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(10,2)) AS amount FROM orders")
def typed_cast(t):
    return t.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(10,2)").alias("amount"))
