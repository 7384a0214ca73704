"""Scans, files, partitioned and sharded layouts, views."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.money import mean, sql_mean
from lotwise.plans.registry import query
from lotwise.sources import files
from lotwise.sources.tables import SCHEMAS
from lotwise.sources.workspace import layout, new_path, together

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
ORDERS_WITH_DAY = f"SELECT {', '.join(ORDER_COLUMNS)}, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders"


def _with_day(orders):
    return orders.select(*ORDER_COLUMNS, F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("SRC-1", ORDERS_WITH_DAY)
def full_scan(t):
    return _with_day(t.orders)


@query("SRC-2", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_with_schema(t):
    path = new_path(t.spark, "csv")
    t.customer.write.option("header", True).csv(path)
    return files.read_csv(t.spark, path, SCHEMAS["customer"])


@query("SRC-3", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def json_arrays(t):
    path = new_path(t.spark, "json-arrays")
    files.write_json_arrays(t.supplier, path, F.expr("s_suppkey DIV 10000"))
    rows = files.read_json_arrays(t.spark, path, SCHEMAS["supplier"] + ", chunk bigint")
    return rows.drop("chunk")


@query("SRC-4", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def parquet_staging(t):
    path = new_path(t.spark, "parquet")
    t.part.write.parquet(path)
    return t.spark.read.schema(SCHEMAS["part"]).parquet(path)


@query("SRC-5", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def json_staging(t):
    path = new_path(t.spark, "json")
    t.supplier.write.json(path)
    return files.read_json_lines(t.spark, path, SCHEMAS["supplier"])


@query(
    "SRC-6",
    """SELECT name, count(*) AS contracts FROM orders
       JOIN (VALUES ('F', 'closed'), ('O', 'active'), ('P', 'pending')) AS s(code, name) ON code = o_orderstatus
       GROUP BY name""",
)
def inline_rows(t):
    statuses = t.spark.createDataFrame([("F", "closed"), ("O", "active"), ("P", "pending")], "code string, name string")
    counts = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("contracts"))
    return counts.join(statuses, F.col("code") == F.col("o_orderstatus")).select("name", "contracts")


@query(
    "SRC-7",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'""",
)
def append(t):
    path = new_path(t.spark, "append")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    rows.where("o_orderstatus = 'F'").drop("o_orderstatus").write.parquet(path)
    rows.where("o_orderstatus = 'P'").drop("o_orderstatus").write.mode("append").parquet(path)
    return t.spark.read.schema("o_orderkey bigint, o_custkey bigint, o_totalprice double").parquet(path)


@query("SRC-8", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type")
def full_refresh(t):
    path = new_path(t.spark, "refresh")
    for _ in range(2):
        t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(path)
    return t.spark.read.schema("user_id bigint, event_type string, n bigint").parquet(path)


WIDE_FACT = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, p_name, p_brand, s_name
               FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""


@query("SRC-9", WIDE_FACT)
def cross_store_extract(t):
    wide = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "p_name", "p_brand", "s_name"
        )
    )
    folder = new_path(t.spark, "extract")
    wide.write.mode("overwrite").parquet(f"{folder}/raw_fact")
    t.part.select("p_partkey", "p_name", "p_brand", "p_type").write.mode("overwrite").parquet(f"{folder}/raw_part")
    t.supplier.select("s_suppkey", "s_name").write.mode("overwrite").parquet(f"{folder}/raw_supplier")
    return t.spark.read.schema(wide.schema).parquet(f"{folder}/raw_fact")


LAYOUT = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"


def _partitioned(t, label, column, more):
    """The orders partitioned by a column, written once for these data."""

    def write(path):
        rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", more.alias(column))
        files.write_partitioned(rows, path, column)

    return layout(t.spark, label, [t.path("orders")], write)


def by_month(t):
    path = _partitioned(t, "by-month", "month", files.month_of(F.col("o_orderdate")))
    return files.read_partitioned(t.spark, path, f"{LAYOUT}, month date")


def by_status(t):
    path = _partitioned(t, "by-status", "o_orderstatus", F.col("o_orderstatus"))
    return files.read_partitioned(t.spark, path, f"{LAYOUT}, o_orderstatus string")


def by_hash(t, buckets=4):
    path = _partitioned(t, f"by-hash-{buckets}", "bucket", files.bucket_of(F.col("o_custkey"), buckets))
    return files.read_partitioned(t.spark, path, f"{LAYOUT}, bucket int")


@query(
    "SRC-10",
    "SELECT o_orderkey, o_custkey, o_totalprice, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders",
)
def range_partitions(t):
    return by_month(t).select("o_orderkey", "o_custkey", "o_totalprice", F.col("month").cast("string").alias("month"))


@query("SRC-11", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def list_partitions(t):
    return by_status(t).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@query(
    "SRC-12",
    "SELECT o_custkey, count(*) AS orders, 1 AS buckets FROM orders GROUP BY o_custkey",
)
def hash_partitions(t):
    counted = by_hash(t).groupBy("o_custkey").agg(F.count("*").alias("orders"), F.count_distinct("bucket").alias("buckets"))
    return counted.withColumn("buckets", F.col("buckets").cast("int"))


@query(
    "SRC-12-join",
    """SELECT c_mktsegment AS segment, count(*) AS orders, count(DISTINCT c_custkey) AS customers
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def bucketed_join(t):
    """Both sides lie in buckets of the customer, so neither is shuffled for the join or for the counts per customer."""
    orders = files.bucketed(t.spark, "orders-by-customer", [t.path("orders")], lambda: t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 16)
    customers = files.bucketed(t.spark, "customers", [t.path("customer")], lambda: t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", 16)
    counted = orders.groupBy("o_custkey").agg(F.count("*").alias("n")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return counted.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.sum("n").alias("orders"), F.count("*").alias("customers"))


@query(
    "SRC-13",
    """SELECT 'month' AS layout, o_orderkey, o_totalprice FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'
       UNION ALL SELECT 'status', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_custkey = 120
       UNION ALL SELECT 'hash', o_orderkey, o_totalprice FROM orders WHERE o_custkey = 42""",
)
def pruned_reads(t):
    def tagged(name, rows):
        return rows.select(F.lit(name).alias("layout"), "o_orderkey", "o_totalprice")

    months, statuses, buckets = together(lambda: by_month(t), lambda: by_status(t), lambda: by_hash(t))
    month = months.where(F.col("month") == F.lit("1997-03-01").cast("date"))
    status = statuses.where("o_orderstatus = 'F' AND o_custkey = 120")
    hashed = files.in_bucket(buckets, "bucket", "o_custkey", 42, 4)
    return tagged("month", month).union(tagged("status", status)).union(tagged("hash", hashed))


@query("SRC-14", "SELECT o_orderstatus AS partition, count(*) AS row_count FROM orders GROUP BY o_orderstatus")
def partition_inventory(t):
    folder = F.regexp_extract(F.col("_metadata.file_path"), "o_orderstatus=([^/]+)/", 1).alias("partition")
    return by_status(t).groupBy(folder).agg(F.count("*").alias("row_count"))


def shards(t):
    """Customers written to two stores, the lower and the upper half of the keys, read back as one table."""
    border = t.customer.agg(F.expr("max(c_custkey) DIV 2 + 1").alias("border")).scalar()
    folder = new_path(t.spark, "shards")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    rows.where(F.col("c_custkey") < border).write.parquet(f"{folder}/shard=1")
    rows.where(F.col("c_custkey") >= border).write.parquet(f"{folder}/shard=2")
    return t.spark.read.schema("c_custkey bigint, c_name string, c_acctbal double, shard int").parquet(folder)


@query(
    "SRC-15",
    """SELECT 'all' AS question, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer
       UNION ALL SELECT 'low key', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey = 15
       UNION ALL SELECT 'high key', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey = 140""",
)
def sharded_table(t):
    both = shards(t)
    sums = (F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))
    everything = both.agg(*sums).select(F.lit("all").alias("question"), "n", "keys")
    highest = t.customer.agg(F.max("c_custkey")).scalar()

    def lookup(question, key):
        # The shard follows from the key, so only one shard is read.
        shard = F.when(F.lit(key) < F.expr("highest div 2 + 1"), 1).otherwise(2)
        found = both.withColumn("highest", highest).where((F.col("shard") == shard) & (F.col("c_custkey") == key))
        return found.agg(*sums).select(F.lit(question), "n", "keys")

    return everything.union(lookup("low key", 15)).union(lookup("high key", 140))


@query(
    "SRC-16",
    """SELECT CASE WHEN c_custkey < (SELECT max(c_custkey) // 2 + 1 FROM customer) THEN 1 ELSE 2 END AS shard,
              count(*) AS row_count, CAST(0 AS BIGINT) AS out_of_bounds
       FROM customer GROUP BY 1""",
)
def shard_bounds(t):
    border = t.customer.agg(F.expr("max(c_custkey) DIV 2 + 1").alias("border")).scalar()
    inside = F.when(F.col("shard") == 1, F.col("c_custkey") < border).otherwise(F.col("c_custkey") >= border)
    checked = shards(t).withColumn("_inside", inside)
    return checked.groupBy("shard").agg(F.count("*").alias("row_count"), F.count_if(~F.col("_inside")).alias("out_of_bounds"))


@query(
    "SRC-17",
    """SELECT 'temperature' AS measurement, event_type AS location, CAST(user_id AS VARCHAR) AS sensor, value,
              epoch_us(ts) * 1000 AS time_ns FROM events""",
)
def line_protocol(t):
    path = new_path(t.spark, "lines")
    nanoseconds = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    line = F.format_string("temperature,location=%s,sensor=%d value=%s %d", "event_type", "user_id", F.col("value").cast("string"), nanoseconds)
    t.events.select(line).write.text(path)
    parsed = files.parse_line_protocol(t.spark.read.text(path))
    return parsed.select(
        "measurement",
        F.col("tags.location").alias("location"),
        F.col("tags.sensor").alias("sensor"),
        F.col("fields.value").alias("value"),
        "time_ns",
    )


@query(
    "SRC-18",
    """SELECT p_name AS title, p_type AS genre, split_part(p_name, ' ', 1) AS first_tag, 'maker ' || p_brand AS author_name
       FROM part""",
)
def nested_documents(t):
    path = new_path(t.spark, "documents")
    t.part.select(
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genre"),
        F.split("p_name", " ").alias("tags"),
        F.struct(F.concat(F.lit("maker "), "p_brand").alias("name"), F.lit("USA").alias("country")).alias("author"),
    ).write.json(path)
    schema = "title string, genre string, tags array<string>, author struct<name string, country string>"
    books = files.read_json_lines(t.spark, path, schema)
    return books.select("title", "genre", F.col("tags")[0].alias("first_tag"), F.col("author.name").alias("author_name"))


@query(
    "SRC-19",
    """SELECT 'reader' AS kind, count(DISTINCT c_custkey) AS n FROM customer
       UNION ALL SELECT 'article', count(DISTINCT p_partkey) FROM part
       UNION ALL SELECT 'read', count(*) FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                 JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey""",
)
def graph_from_csv(t):
    folder = new_path(t.spark, "graph")
    t.customer.select("c_custkey", "c_name").union(t.customer.select("c_custkey", "c_name")).write.option(
        "header", True
    ).csv(f"{folder}/readers")
    t.part.select("p_partkey", "p_name").write.option("header", True).csv(f"{folder}/articles")
    t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey").write.option(
        "header", True
    ).csv(f"{folder}/read")
    readers = files.read_csv(t.spark, f"{folder}/readers", "c_custkey bigint, c_name string").dropDuplicates(["c_custkey"])
    articles = files.read_csv(t.spark, f"{folder}/articles", "p_partkey bigint, p_name string").dropDuplicates(["p_partkey"])
    edges = files.read_csv(t.spark, f"{folder}/read", "o_custkey bigint, l_partkey bigint")
    matched = edges.join(readers, F.col("c_custkey") == F.col("o_custkey"), "left_semi").join(
        articles, F.col("p_partkey") == F.col("l_partkey"), "left_semi"
    )
    counts = [("reader", readers), ("article", articles), ("read", matched)]
    parts = [rows.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, rows in counts]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "SRC-20",
    """SELECT 'id' AS access, c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey = 77
       UNION ALL SELECT 'name', c_custkey, c_name, c_acctbal FROM customer WHERE c_name = 'Customer#000000012'""",
)
def two_layouts(t):
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    by_id, by_name = new_path(t.spark, "by-id"), new_path(t.spark, "by-name")
    files.write_for_key(rows, by_id, "c_custkey")
    files.write_for_key(rows, by_name, "c_name")
    one = t.spark.read.schema(rows.schema).parquet(by_id).where("c_custkey = 77")
    other = t.spark.read.schema(rows.schema).parquet(by_name).where("c_name = 'Customer#000000012'")
    return one.select(F.lit("id").alias("access"), *rows.columns).union(other.select(F.lit("name"), *rows.columns))


@query(
    "SRC-21",
    f"""SELECT c_custkey, {sql_mean("value")} AS avg_rating, count(event_id) AS reviews_count
        FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey""",
)
def ratings_view(t):
    per_user = t.events.groupBy("user_id").agg(mean("value").alias("avg_rating"), F.count("*").alias("reviews_count"))
    ratings = t.customer.join(per_user, F.col("user_id") == F.col("c_custkey"), "left")
    ratings.select("c_custkey", "avg_rating", F.coalesce("reviews_count", F.lit(0)).alias("reviews_count")).createOrReplaceTempView("seller_ratings")
    return t.spark.sql("SELECT c_custkey, avg_rating, reviews_count FROM seller_ratings")
