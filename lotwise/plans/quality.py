"""Data quality: rules, keys, counts, gates, request validation and health reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lotwise.functions import text
from lotwise.functions.money import mean_rounded, money, sql_mean_rounded
from lotwise.operators import quality as dq
from lotwise.operators.purchases import check_requests
from lotwise.plans.changes import ADS, REQUESTS, ads_of, requests_of
from lotwise.plans.aggregates import STATUS_NAMES
from lotwise.plans.registry import query
from lotwise.sources.workspace import new_path


@query(
    "DQ-1",
    """SELECT 'email' AS missing, count(*) AS row_count FROM customer UNION ALL SELECT 'phone', count(*) FROM customer""",
)
def required_columns(t):
    required = ["c_custkey", "c_name", "phone", "email"]
    missing = dq.missing_columns(t.customer, required)
    listed = F.explode(F.array(*[F.lit(name) for name in missing])).alias("missing")
    return t.customer.agg(F.count("*").alias("row_count")).select(listed, "row_count")


@query(
    "DQ-2",
    "SELECT doc_id FROM documents WHERE trim(regexp_replace(source, '^src[0-4]$', ' ')) = ''",
)
def blank_keys(t):
    rows = t.documents.select("doc_id", F.regexp_replace("source", "^src[0-4]$", " ").alias("key"))
    return dq.violations(rows, "doc_id", {"blank": dq.present("key")}).select("doc_id")


@query(
    "DQ-3",
    """SELECT 'orders' AS source, count(*) > 0 AS non_empty FROM orders UNION ALL
       SELECT 'overdue', count(*) > 0 FROM orders WHERE o_totalprice < 0""",
)
def non_empty(t):
    def check(name, rows):
        return rows.limit(1).agg((F.count("*") > 0).alias("non_empty")).select(F.lit(name).alias("source"), "non_empty")

    return check("orders", t.orders).union(check("overdue", t.orders.where("o_totalprice < 0")))


@query(
    "DQ-4",
    """SELECT c_custkey, 'segment missing' AS rule FROM customer WHERE c_mktsegment = 'BUILDING'
       UNION ALL SELECT c_custkey, 'balance not positive' FROM customer WHERE c_acctbal - 2000 <= 0""",
)
def record_rules(t):
    rows = t.customer.select(
        "c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"), (F.col("c_acctbal") - 2000).alias("balance")
    )
    rules = {"segment missing": dq.present("segment"), "balance not positive": F.col("balance") > 0}
    return dq.violations(rows, "c_custkey", rules)


@query("DQ-5", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal - 3000 <= 0")
def positive_numbers(t):
    return dq.broken(t.supplier, F.col("s_acctbal") - 3000 > 0).select("s_suppkey", "s_acctbal")


@query(
    "DQ-6",
    """SELECT 'quantity' AS rule, count(*) FILTER (WHERE NOT (l_quantity BETWEEN 1 AND 45)) AS failed FROM lineitem
       UNION ALL SELECT 'discount', count(*) FILTER (WHERE l_discount > 0.08) FROM lineitem
       UNION ALL SELECT 'flag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
       UNION ALL SELECT 'price', count(*) FILTER (WHERE l_extendedprice < 0) FROM lineitem""",
)
def check_rules(t):
    rules = {
        "quantity": F.col("l_quantity").between(1, 45),
        "discount": F.col("l_discount") <= 0.08,
        "flag": F.col("l_returnflag").isin("A", "N"),
        "price": F.col("l_extendedprice") >= 0,
    }
    return dq.rule_counts(t.lineitem, rules)


CONTACT = """(SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '@mail.test' ELSE 'user' || c_custkey || '@mail.test' END AS email,
                     '+' || lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_mktsegment = 'FURNITURE' THEN 9 ELSE 11 END, '7') AS phone FROM customer)"""


@query(
    "DQ-7",
    f"""SELECT c_custkey, 'email' AS rule FROM {CONTACT} WHERE NOT regexp_matches(email, '{dq.EMAIL}')
        UNION ALL SELECT c_custkey, 'phone' FROM {CONTACT} WHERE NOT regexp_matches(phone, '{dq.PHONE}')""",
)
def contact_patterns(t):
    key = F.col("c_custkey").cast("string")
    bad_mail, short = F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment") == "FURNITURE"
    rows = t.customer.select(
        "c_custkey",
        F.concat(F.when(bad_mail, F.col("c_name")).otherwise(F.concat(F.lit("user"), key)), F.lit("@mail.test")).alias("email"),
        F.concat(F.lit("+"), F.when(short, F.lpad(key, 9, "7")).otherwise(F.lpad(key, 11, "7"))).alias("phone"),
    )
    return dq.violations(rows, "c_custkey", {"email": F.col("email").rlike(dq.EMAIL), "phone": F.col("phone").rlike(dq.PHONE)})


RAW_VIN = "'  ' || lower(p_type) || lpad(CAST(p_partkey AS VARCHAR), 10, '0') || ' '"


@query("DQ-8", f"SELECT p_partkey, upper(trim({RAW_VIN})) AS vin, length(trim({RAW_VIN})) = 17 AS valid FROM part")
def vin_rule(t):
    vin = text.vin(F.expr(RAW_VIN.replace("VARCHAR", "STRING")))
    return t.part.select("p_partkey", vin.alias("vin")).withColumn("valid", F.length("vin") == 17)


@query(
    "DQ-9",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def unique_keys(t):
    return dq.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("DQ-10", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def foreign_keys(t):
    return dq.orphans(t.documents, t.labels.withColumnRenamed("doc_id", "labelled"), "doc_id", "labelled").select("doc_id", "lang")


@query(
    "DQ-11",
    """SELECT count(*) AS source_rows, count(*) AS loaded_rows, TRUE AS complete FROM part""",
)
def loaded_counts(t):
    # The source is read once: its rows are counted as they are written, those of the load in the files' footers.
    path = new_path(t.spark, "loaded")
    source = dq.written(t.part, path, rows=F.count(F.lit(1)))
    loaded = t.spark.read.schema(t.part.schema).parquet(path).agg(F.count("*").alias("loaded_rows"))
    counts = loaded.select(F.lit(source["rows"]).cast("bigint").alias("source_rows"), "loaded_rows")
    return counts.withColumn("complete", F.col("loaded_rows") == F.col("source_rows"))


@query(
    "DQ-12",
    """SELECT l_returnflag AS status, count(*) AS fact_rows, count(*) AS extract_rows, CAST(0 AS BIGINT) AS difference
       FROM lineitem GROUP BY l_returnflag""",
)
def reconcile_stores(t):
    # Lines without a part stay marked until they have been counted, so the write itself sees both sides.
    joined = t.lineitem.select("l_orderkey", "l_returnflag", "l_partkey").join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"), "left")
    counts = {f"{side}_{status}": F.count_if(in_status & found) for status, in_status in _statuses() for side, found in (("fact", F.lit(True)), ("extract", F.col("p_partkey").isNotNull()))}
    path = new_path(t.spark, "extract")
    seen = dq.written(joined.select("l_orderkey", "l_returnflag", "p_name", "p_partkey"), path, **counts)
    if seen["fact_other"]:
        raise ValueError("lines with a status that is not in the dictionary")
    rows = [(status, seen[f"fact_{status}"], seen[f"extract_{status}"]) for status, _ in _statuses() if seen[f"fact_{status}"]]
    both = t.spark.createDataFrame(rows, "status string, fact_rows bigint, extract_rows bigint")
    return both.withColumn("difference", F.col("fact_rows") - F.col("extract_rows"))


def _statuses():
    """The dictionary of line statuses, and what is none of them."""
    known = [status for status, _ in STATUS_NAMES]
    flag = F.col("l_returnflag")
    return [*((status, F.coalesce(flag == status, F.lit(False))) for status in known), ("other", ~F.coalesce(flag.isin(*known), F.lit(False)))]


@query(
    "DQ-13",
    """SELECT count(*) AS days, CAST(sum(n) AS BIGINT) AS total, count(*) > 0 AND sum(n) > 0 AS passed
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY CAST(l_shipdate AS DATE))""",
)
def mart_gate(t):
    mart = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    seen = dq.written(mart, new_path(t.spark, "mart"), days=F.count(F.lit(1)), total=F.sum("n"))
    sums = t.spark.createDataFrame([(seen["days"], seen["total"])], "days bigint, total bigint")
    return sums.withColumn("passed", F.coalesce((F.col("days") > 0) & (F.col("total") > 0), F.lit(False)))


@query("DQ-14", "SELECT count(DISTINCT l_returnflag) AS shares, TRUE AS passed FROM lineitem")
def share_gate(t):
    counts = t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    shares = counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))
    return shares.agg(
        F.count("*").alias("shares"), (F.abs(F.round(F.sum("pct"), 2) - 100.0) <= 0.5).alias("passed")
    )


@query(
    "DQ-15",
    f"""WITH r AS ({REQUESTS}), a AS ({ADS}), load AS (SELECT seller_id, count(*) AS n FROM a GROUP BY seller_id)
        SELECT request_id, CASE WHEN a.ad_id IS NULL THEN 'unknown ad' WHEN a.status <> 'active' THEN 'ad not active'
               WHEN c_custkey IS NULL THEN 'unknown buyer' WHEN amount <= 0 THEN 'amount not positive' ELSE 'ok' END AS code,
               CASE WHEN a.ad_id IS NULL OR a.status <> 'active' OR c_custkey IS NULL OR amount <= 0 THEN 'error'
                    WHEN amount < 1 OR n > 15 THEN 'warning' ELSE 'ok' END AS level
        FROM r LEFT JOIN a ON a.ad_id = r.ad_id LEFT JOIN customer ON c_custkey = buyer_id LEFT JOIN load l ON l.seller_id = a.seller_id""",
)
def request_codes(t):
    ads = ads_of(t)
    checked = check_requests(requests_of(t), ads, t.customer.select(F.col("c_custkey").alias("user_id")))
    load = ads.groupBy("seller_id").agg(F.count("*").alias("_ads"))
    warned = checked.join(load, "seller_id", "left")
    level = dq.first_failure(
        [("error", F.col("code") != "ok"), ("warning", (F.col("amount") < 1) | (F.coalesce("_ads", F.lit(0)) > 15))]
    )
    return warned.select("request_id", "code", level.alias("level"))


@query(
    "DQ-16",
    f"""WITH ads AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
             ratings AS (SELECT user_id, {sql_mean_rounded("value")} AS rating FROM events GROUP BY user_id),
             health AS (SELECT c_custkey, coalesce(n, 0) AS ads, coalesce(rating, 0.0) AS rating FROM customer
                        LEFT JOIN ads ON o_custkey = c_custkey LEFT JOIN ratings ON user_id = c_custkey)
        SELECT c_custkey, ads, rating, concat_ws('; ', CASE WHEN ads = 0 THEN 'no ads' END,
               CASE WHEN rating < 3.0 AND ads > 0 THEN 'low rating' END, CASE WHEN ads > 8 THEN 'too many ads' END) AS warnings
        FROM health""",
)
def health_report(t):
    ads = t.orders.where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.count("*").alias("_ads"))
    ratings = t.events.groupBy("user_id").agg(mean_rounded("value").alias("_rating"))
    health = (
        t.customer.join(ads, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(ratings, F.col("user_id") == F.col("c_custkey"), "left")
        .select("c_custkey", F.coalesce("_ads", F.lit(0)).alias("ads"), F.coalesce("_rating", F.lit(0.0)).alias("rating"))
    )
    warnings = F.concat_ws(
        "; ",
        F.when(F.col("ads") == 0, "no ads"),
        F.when((F.col("rating") < 3.0) & (F.col("ads") > 0), "low rating"),
        F.when(F.col("ads") > 8, "too many ads"),
    )
    return health.withColumn("warnings", warnings)


@query(
    "DQ-17",
    "SELECT event_id, CASE WHEN hour(ts) >= 9 AND hour(ts) < 18 THEN 'accepted' ELSE 'rejected' END AS verdict FROM events",
)
def business_hours(t):
    verdict = F.when(F.hour("ts").between(9, 17), "accepted").otherwise("rejected")
    return t.events.select("event_id", verdict.alias("verdict"))
