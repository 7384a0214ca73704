"""Upserts, updates, deletes, audits, purchase batches, change feeds and schema migrations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.money import mean, money, sql_mean, sql_total, total
from lotwise.operators import change, purchases
from lotwise.operators.ordered import row_numbers
from lotwise.plans.registry import query
from lotwise.sources import files
from lotwise.sources.stored import StoredTable
from lotwise.sources.workspace import layout, new_path


def _stored(t, label, sources, rows, keys) -> StoredTable:
    """The table that is stored for these data, made of ``rows`` by whoever asks first."""
    build = lambda path: StoredTable.create(t.spark, path, rows(), keys)
    return StoredTable(t.spark, layout(t.spark, label, [t.path(name) for name in sources], build))


def _spending(t):
    spent = t.orders.where("o_orderdate >= timestamp_ntz'2000-01-01 00:00:00'").groupBy("o_custkey").agg(
        total("o_totalprice").alias("balance")
    )
    return t.customer.join(spent, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "balance")


def _known(t):
    known = t.customer.where("c_mktsegment <> 'BUILDING'")
    return known.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(28,2)").alias("balance"))


SPENDING = f"""SELECT c_custkey, c_name, {sql_total("o_totalprice")} AS balance FROM customer JOIN orders ON o_custkey = c_custkey
               WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY c_custkey, c_name"""
KNOWN = "SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(28,2)) AS balance FROM customer WHERE c_mktsegment <> 'BUILDING'"


@query(
    "UPS-1",
    f"""WITH incoming AS ({SPENDING}) SELECT * FROM incoming
        UNION ALL SELECT * FROM ({KNOWN}) WHERE c_custkey NOT IN (SELECT c_custkey FROM incoming)""",
)
def incoming_wins(t):
    """Into the stored table, of which only the buckets of changed rows are rewritten; asking again changes nothing."""
    table = _stored(t, "balances", ["customer"], lambda: _known(t), ["c_custkey"])
    table.upsert(_spending(t))
    return table.read()


@query(
    "UPS-2",
    f"""WITH target AS ({KNOWN}) SELECT * FROM target
        UNION ALL SELECT * FROM ({SPENDING}) WHERE c_custkey NOT IN (SELECT c_custkey FROM target)""",
)
def absent_only(t):
    return change.insert_absent(_known(t), _spending(t), ["c_custkey"])


def _ratings(events):
    return events.groupBy("user_id").agg(mean("value").alias("avg_rating"), F.count("*").alias("reviews"))


@query(
    "UPS-3",
    f"""SELECT c_custkey AS user_id, coalesce({sql_mean("value")}, 0.0) AS avg_rating, count(event_id) AS reviews
        FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey""",
)
def rating_cache(t):
    cache = _ratings(t.events.where("ts < timestamp_ntz'2024-01-15 00:00:00'"))
    fresh = _ratings(t.events)
    everyone = t.customer.select(F.col("c_custkey").alias("user_id")).join(fresh, "user_id", "left")
    incoming = everyone.select(
        "user_id",
        F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
        F.coalesce("reviews", F.lit(0)).alias("reviews"),
    )
    return change.upsert(cache, incoming, ["user_id"])


@query(
    "UPS-4",
    """WITH
            early AS (SELECT user_id, event_type, max(event_id) AS id FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY ALL),
            late AS (SELECT user_id, event_type, max(event_id) AS id FROM events
                     WHERE ts >= TIMESTAMP '2024-01-10' AND value BETWEEN 0 AND 50 AND event_type <> 'view' GROUP BY ALL)
       SELECT user_id, event_type, value, CASE WHEN l.id IS NULL THEN 'kept' WHEN e.id IS NULL THEN 'inserted' ELSE 'updated' END AS action
       FROM early e FULL JOIN late l USING (user_id, event_type) JOIN (SELECT event_id, value FROM events)
       ON event_id = coalesce(l.id, e.id)""",
)
def feedback(t):
    keys = ["user_id", "event_type"]
    rows = t.events.select("event_id", *keys, "value", "ts")
    early = change.keep_one(rows.where("ts < timestamp_ntz'2024-01-10 00:00:00'"), keys, [F.col("event_id")], last=True)
    new = rows.where("ts >= timestamp_ntz'2024-01-10 00:00:00' AND value BETWEEN 0 AND 50 AND event_type <> 'view'")
    late = change.keep_one(new, keys, [F.col("event_id")], last=True)
    marked = late.join(early.select(*keys, F.lit(True).alias("_old")), keys, "left").select(
        *keys, "value", F.when(F.col("_old"), "updated").otherwise("inserted").alias("action")
    )
    return change.upsert(early.select(*keys, "value", F.lit("kept").alias("action")), marked, keys)


@query(
    "UPS-5",
    """SELECT p_partkey, p_name, coalesce(low, p_retailprice) AS p_retailprice, p_size FROM part
       LEFT JOIN (SELECT l_partkey, min(l_extendedprice) AS low FROM lineitem WHERE l_quantity = 50 GROUP BY l_partkey)
       ON l_partkey = p_partkey""",
)
def partial_update(t):
    changes = t.lineitem.where("l_quantity = 50").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.min("l_extendedprice").alias("p_retailprice"), F.lit(None).cast("int").alias("p_size")
    )
    return change.patch(t.part.select("p_partkey", "p_name", "p_retailprice", "p_size"), changes, "p_partkey")


@query(
    "UPD-1",
    """SELECT o_orderkey, o_orderstatus, CAST(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'
              THEN CAST(o_totalprice AS DECIMAL(18,2)) - 2 ELSE o_totalprice END AS DECIMAL(18,2)) AS price FROM orders""",
)
def conditional_update(t):
    priced = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", money("o_totalprice").alias("price"))
    hit = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    changed = change.update_where(priced, hit, {"price": (F.col("price") - 2).cast("decimal(18,2)")})
    return changed.drop("o_orderpriority")


@query("UPD-2", "SELECT p_partkey, p_name, 'white' AS color FROM part")
def unconditional_update(t):
    return t.part.select("p_partkey", "p_name", F.col("p_type").alias("color")).withColumn("color", F.lit("white"))


ADS = """SELECT o_orderkey AS ad_id, o_custkey AS seller_id, CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'sold'
                ELSE 'in processing' END AS status, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders"""


def ads_of(t):
    status = F.expr("CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'sold' ELSE 'in processing' END")
    return t.orders.select(
        F.col("o_orderkey").alias("ad_id"),
        F.col("o_custkey").alias("seller_id"),
        status.alias("status"),
        F.floor("o_totalprice").cast("bigint").alias("price"),
    )


@query(
    "UPD-3",
    f"""WITH ads AS ({ADS}), first AS (SELECT ad_id FROM (SELECT ad_id, row_number() OVER (PARTITION BY seller_id ORDER BY ad_id) AS n
                                       FROM ads WHERE status = 'active' AND price > 0) WHERE n <= 10)
        SELECT ad_id, seller_id, status, CASE WHEN ad_id IN (SELECT ad_id FROM first) THEN price - (price * 7) // 100 ELSE price END AS price
        FROM ads""",
)
def stepwise_discount(t):
    return purchases.discount_first(ads_of(t), 7)


@query(
    "UPD-4",
    """SELECT o_orderkey, CASE WHEN price IS NULL OR price <= 0 THEN 1000000 ELSE price END AS price, price IS NULL OR price <= 0 AS repaired
       FROM (SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice) - 20000 END AS BIGINT) AS price FROM orders)""",
)
def repair_prices(t):
    priced = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice").cast("bigint") - 20000).alias("price"),
        F.lit(False).alias("repaired"),
    )
    bad = F.col("price").isNull() | (F.col("price") <= 0)
    return change.update_where(priced, bad, {"price": F.lit(1000000).cast("bigint"), "repaired": F.lit(True)})


PRICE_REQUESTS = """SELECT event_id AS request, user_id * 7 AS ad, CAST(floor(value) AS BIGINT) - 20 AS wanted FROM events"""


@query(
    "UPD-6",
    f"""WITH requests AS ({PRICE_REQUESTS}),
             judged AS (SELECT r.*, CASE WHEN o_orderkey IS NULL THEN 'unknown ad' WHEN wanted IS NULL OR wanted < 0 THEN 'bad price' END AS reason
                        FROM requests r LEFT JOIN orders ON o_orderkey = ad),
             placed AS (SELECT *, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY ad, reason IS NULL ORDER BY request DESC) END AS place FROM judged),
             final AS (SELECT request, ad, wanted, coalesce(reason, CASE WHEN place > 1 THEN 'overtaken' ELSE 'updated' END) AS outcome FROM placed)
        SELECT request, ad, outcome, CAST(floor(o_totalprice) AS BIGINT) AS old_price, CASE WHEN outcome = 'updated' THEN wanted END AS new_price
        FROM final LEFT JOIN orders ON o_orderkey = ad""",
)
def price_changes(t):
    """Every request gets an outcome; of several good ones for an ad the last wins."""
    requests = t.events.select(
        F.col("event_id").alias("request"), (F.col("user_id") * 7).alias("ad"), (F.floor("value").cast("bigint") - 20).alias("wanted")
    )
    ads = t.orders.select(F.col("o_orderkey").alias("_ad"), F.floor("o_totalprice").cast("bigint").alias("old_price"))
    known = requests.join(ads, F.col("ad") == F.col("_ad"), "left")
    reason = F.when(F.col("_ad").isNull(), "unknown ad").when(F.coalesce(F.col("wanted") < 0, F.lit(True)), "bad price")
    judged = known.withColumn("reason", reason)
    # The winner of an ad is a maximum, combined before the shuffle, so an ad with a third of all requests is no problem.
    last = judged.where("reason IS NULL").groupBy(F.col("ad").alias("_of")).agg(F.max("request").alias("_last"))
    placed = judged.join(last, F.col("ad") == F.col("_of"), "left")
    outcome = F.coalesce("reason", F.when(F.col("request") == F.col("_last"), "updated").otherwise("overtaken"))
    changed = placed.withColumn("outcome", outcome)
    return changed.select("request", "ad", "outcome", "old_price", F.when(F.col("outcome") == "updated", F.col("wanted")).alias("new_price"))


@query(
    "UPD-5",
    "SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'UNIT' || c_custkey) AS code FROM customer",
)
def fill_codes(t):
    made = F.concat(F.lit("UNIT"), F.col("c_custkey").cast("string"))
    return t.customer.select("c_custkey", F.coalesce(F.expr("nullif(c_mktsegment, 'BUILDING')"), made).alias("code"))


@query(
    "DEL-1",
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer
       WHERE NOT coalesce(nullif(c_mktsegment, 'BUILDING') = 'MACHINERY', FALSE)""",
)
def conditional_delete(t):
    rows = t.customer.select("c_custkey", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"))
    return change.delete_where(rows, F.col("segment") == "MACHINERY")


@query(
    "DEL-2",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'F'
         AND o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 1 YEAR)""",
)
def retention(t):
    as_of = t.orders.agg(F.max("o_orderdate").alias("m")).select(F.expr("m - INTERVAL 1 YEAR")).scalar()
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    kept = change.delete_where(rows, (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < as_of))
    return kept.drop("o_orderdate")


CLOSED_SELLERS = "(SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000)"


@query("DEL-3", f"SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey NOT IN {CLOSED_SELLERS}")
def cascade(t):
    _, deleted = change.split_deleted(t.supplier, F.col("s_acctbal") < 1000)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return change.delete_children(lines, deleted, "l_suppkey", "s_suppkey")


@query(
    "DEL-4",
    """SELECT event_id, CASE WHEN user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE')
              THEN user_id END AS user_id FROM events""",
)
def set_null(t):
    _, deleted = change.split_deleted(t.customer, F.col("c_mktsegment") == "FURNITURE")
    return change.null_children(t.events.select("event_id", "user_id"), deleted, "user_id", "c_custkey")


@query(
    "DEL-5",
    """SELECT CASE WHEN o_orderkey IS NULL THEN l_orderkey END AS ad_id, l_partkey, l_linenumber,
              CASE WHEN o_orderkey IS NOT NULL AND l_returnflag IN ('A', 'N') THEN 'R' ELSE l_returnflag END AS status
       FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P') ON o_orderkey = l_orderkey""",
)
def close_dependents(t):
    _, deleted = change.split_deleted(t.orders, F.expr("o_orderpriority = '5-LOW' AND o_orderstatus = 'P'"))
    contracts = t.lineitem.select(
        F.col("l_orderkey").alias("ad_id"), "l_partkey", "l_linenumber", F.col("l_returnflag").alias("status")
    )
    flagged = change.flag_children(contracts, deleted, "ad_id", "o_orderkey", "_deleted")
    closed = change.update_where(flagged, F.col("_deleted") & F.col("status").isin("A", "N"), {"status": F.lit("R")})
    return change.update_where(closed, F.col("_deleted"), {"ad_id": F.lit(None).cast("bigint")}).drop("_deleted")


@query(
    "DEL-6",
    """SELECT 'archive' AS place, o_orderkey, '2002-01-01' AS deleted_on, 'cleaner' AS deleted_by FROM orders
       WHERE o_orderstatus = 'F' AND o_totalprice < 50000
       UNION ALL SELECT 'table', o_orderkey, NULL, NULL FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 50000)""",
)
def archive_deleted(t):
    kept, deleted = change.split_deleted(t.orders, F.expr("o_orderstatus = 'F' AND o_totalprice < 50000"))
    archived = deleted.select(
        F.lit("archive").alias("place"), "o_orderkey", F.lit("2002-01-01").alias("deleted_on"), F.lit("cleaner").alias("deleted_by")
    )
    empty = F.lit(None).cast("string")
    return archived.union(kept.select(F.lit("table"), "o_orderkey", empty, empty))


OLD_PRICE = "CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(o_totalprice AS DECIMAL(18,2)) END"
NEW_PRICE = "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END"


@query(
    "AUD-1",
    f"""SELECT o_orderkey, {OLD_PRICE} AS old_value, {NEW_PRICE} AS new_value,
               CAST({NEW_PRICE} - {OLD_PRICE} AS DECIMAL(19,2)) AS difference
        FROM orders WHERE {OLD_PRICE} IS DISTINCT FROM {NEW_PRICE}""",
)
def audit(t):
    old = t.orders.select("o_orderkey", F.expr(OLD_PRICE).alias("price"))
    new = t.orders.select("o_orderkey", F.expr(NEW_PRICE).alias("price"))
    return change.changed_rows(old, new, "o_orderkey", "price")


REQUESTS = """SELECT event_id AS request_id, event_id * 7919 % 20000 AS ad_id, user_id * 11 AS buyer_id,
                     CAST(value AS DECIMAL(18,2)) - 5 AS amount FROM events"""


def requests_of(t):
    """Purchase requests made from events; some name unknown ads or buyers or a bad amount."""
    return t.events.select(
        F.col("event_id").alias("request_id"),
        (F.col("event_id") * 7919 % 20000).alias("ad_id"),
        (F.col("user_id") * 11).alias("buyer_id"),
        (money("value") - 5).alias("amount"),
    )


def _users(t):
    return t.customer.select(F.col("c_custkey").alias("user_id"))


WINNERS = f"""SELECT ad_id, min(request_id) AS request_id FROM ({REQUESTS}) WHERE amount > 0
              AND ad_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
              AND buyer_id IN (SELECT c_custkey FROM customer) GROUP BY ad_id"""


@query(
    "TXN-1",
    f"""SELECT a.ad_id, CASE WHEN w.ad_id IS NOT NULL THEN 'sold' ELSE a.status END AS status, w.request_id, r.buyer_id,
               CAST(r.amount AS DECIMAL(18,2)) AS amount
        FROM ({ADS}) a LEFT JOIN ({WINNERS}) w USING (ad_id) LEFT JOIN ({REQUESTS}) r ON r.request_id = w.request_id""",
)
def purchase_batch(t):
    contracts, ads = purchases.purchase(requests_of(t), ads_of(t), _users(t))
    joined = ads.join(contracts.drop("seller_id", "status"), "ad_id", "left")
    return joined.select("ad_id", "status", "request_id", "buyer_id", F.col("amount").cast("decimal(18,2)").alias("amount"))


@query(
    "TXN-2",
    """WITH sales AS (SELECT l_partkey AS vehicle_id, min(l_suppkey) AS buyer_id, max(CAST(l_shipdate AS DATE)) AS sold_on
                      FROM lineitem WHERE l_quantity > 48 GROUP BY l_partkey),
            owned AS (SELECT p_partkey AS vehicle_id, CAST(p_size AS BIGINT) AS owner_id, DATE '1994-01-01' AS purchase_date,
                             CASE WHEN p_type = 'SMALL' THEN DATE '1994-06-01' END AS sale_date FROM part)
       SELECT vehicle_id, owner_id, strftime(purchase_date, '%Y-%m-%d') AS purchase_date,
              strftime(coalesce(sale_date, sold_on), '%Y-%m-%d') AS sale_date, 'first' AS note
       FROM owned LEFT JOIN sales USING (vehicle_id)
       UNION ALL SELECT vehicle_id, buyer_id, strftime(sold_on, '%Y-%m-%d'), NULL, 'bought on the platform' FROM sales""",
)
def ownership_hand_over(t):
    sales = t.lineitem.where("l_quantity > 48").groupBy(F.col("l_partkey").alias("vehicle_id")).agg(
        F.min("l_suppkey").alias("buyer_id"), F.max(F.col("l_shipdate").cast("date")).alias("sold_on")
    )
    owned = t.part.select(
        F.col("p_partkey").alias("vehicle_id"),
        F.col("p_size").cast("bigint").alias("owner_id"),
        F.lit("1994-01-01").cast("date").alias("purchase_date"),
        F.when(F.col("p_type") == "SMALL", F.lit("1994-06-01").cast("date")).alias("sale_date"),
        F.lit("first").alias("note"),
    )
    after = purchases.hand_over(owned, sales)
    return after.withColumns({name: F.col(name).cast("string") for name in ("purchase_date", "sale_date")})


@query(
    "TXN-3",
    """SELECT p_partkey AS ad_id, 'https://example.com/photos/' || p_partkey || '-' || n || '.jpg' AS url, n = 1 AS is_primary,
              p_brand || ' ' || p_name AS header
       FROM part, (SELECT unnest([1, 2, 3]) AS n)""",
)
def publish_ads(t):
    key = F.col("p_partkey").cast("string")

    def url(n):
        return F.concat(F.lit("https://example.com/photos/"), key, F.lit("-"), n.cast("string"), F.lit(".jpg"))

    drafts = t.part.select(
        F.col("p_partkey").alias("ad_id"),
        F.struct("p_brand", "p_name").alias("vehicle"),
        F.concat_ws(" ", "p_brand", "p_name").alias("header"),
        F.col("p_retailprice").alias("price"),
        F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), url).alias("photos"),
    )
    _, ads, photos = purchases.publish(drafts)
    return photos.join(ads.select("ad_id", "header"), "ad_id").select("ad_id", "url", "is_primary", "header")


FEED = """SELECT event_id AS seq, CASE event_type WHEN 'error' THEN 'D' WHEN 'click' THEN 'U' ELSE 'I' END AS op,
                 user_id * 12 AS c_custkey, 'user ' || user_id AS c_name, value AS c_acctbal, event_type FROM events"""


def feed_of(t):
    operation = F.expr("CASE event_type WHEN 'error' THEN 'D' WHEN 'click' THEN 'U' ELSE 'I' END")
    return t.events.select(
        F.col("event_id").alias("seq"),
        operation.alias("op"),
        (F.col("user_id") * 12).alias("c_custkey"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("c_name"),
        F.col("value").alias("c_acctbal"),
        "event_type",
    )


APPLIED = f"""WITH feed AS ({FEED}), last AS (SELECT * FROM feed WHERE seq IN (SELECT max(seq) FROM feed GROUP BY c_custkey))
              SELECT {{columns}} FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM last)
              UNION ALL SELECT {{columns}} FROM last WHERE op <> 'D'"""


@query("CDC-1", APPLIED.format(columns="c_custkey, c_name, c_acctbal"))
def change_feed(t):
    """Into the stored table; CDC-2 applies the feed to rows that are not stored."""
    table = _stored(t, "accounts", ["customer"], lambda: t.customer.select("c_custkey", "c_name", "c_acctbal"), ["c_custkey"])
    table.apply(feed_of(t))
    return table.read()


@query("CDC-2", APPLIED.format(columns="c_custkey, c_acctbal"))
def narrower_target(t):
    return change.apply_changes(t.customer.select("c_custkey", "c_acctbal"), feed_of(t), ["c_custkey"])


@query(
    "CDC-3",
    """SELECT CASE WHEN l_returnflag = 'A' AND l_quantity > 45 THEN NULL ELSE l_returnflag END AS flag, l_linestatus AS state,
              CAST(l_quantity AS BIGINT) AS quantity, l_linenumber AS line FROM lineitem""",
)
def keyless_feed(t):
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("state"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_linenumber").alias("line"),
    )
    old = rows.where("flag = 'A' AND quantity > 45")
    return change.apply_keyless(rows, old, old.withColumn("flag", F.lit(None).cast("string")))


@query(
    "CDC-4",
    f"""WITH feed AS ({FEED}) SELECT 'root' AS route, event_type, count(*) AS changes, CAST(sum(seq) AS BIGINT) AS checksum FROM feed GROUP BY event_type
        UNION ALL SELECT 'leaf', event_type, count(*), CAST(sum(seq) AS BIGINT) FROM feed WHERE event_type = 'error' GROUP BY event_type""",
)
def routed_feed(t):
    path = new_path(t.spark, "feed")
    feed = feed_of(t)
    files.write_partitioned(feed, path, "event_type")
    root = files.read_partitioned(t.spark, path, "seq bigint, op string, c_custkey bigint, c_name string, c_acctbal double, event_type string")
    sums = (F.count("*").alias("changes"), F.sum("seq").alias("checksum"))
    merged = root.groupBy("event_type").agg(*sums).select(F.lit("root").alias("route"), "event_type", "changes", "checksum")
    leaf = root.where("event_type = 'error'").groupBy("event_type").agg(*sums)
    return merged.union(leaf.select(F.lit("leaf"), "event_type", "changes", "checksum"))


@query(
    "MIG-1",
    """SELECT 'ownerships' AS entity, o_orderkey AS vehicle_id, c_name AS detail FROM orders JOIN customer ON o_custkey = c_custkey
       UNION ALL SELECT 'mileage_log', o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) FROM orders
       UNION ALL SELECT 'insurances', o_orderkey, o_orderpriority FROM orders
       UNION ALL SELECT 'vehicle_flags', o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'true' WHEN o_orderstatus IS NOT NULL THEN 'false' END FROM orders""",
)
def split_wide_table(t):
    # Only an ownership needs its owner; the rest of the wide row is exploded into one row per new table.
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    owned = owned.select(F.lit("ownerships").alias("entity"), F.col("o_orderkey").alias("vehicle_id"), F.col("c_name").alias("detail"))

    def row(entity, detail):
        return F.struct(F.lit(entity).alias("entity"), F.col("o_orderkey").alias("vehicle_id"), detail.alias("detail"))

    rows = F.array(
        row("mileage_log", F.floor("o_totalprice").cast("bigint").cast("string")),
        row("insurances", F.col("o_orderpriority")),
        row("vehicle_flags", (F.col("o_orderstatus") == "P").cast("string")),
    )
    return owned.unionByName(t.orders.select(F.inline(rows)))


YES_NO = "CASE c_mktsegment WHEN 'BUILDING' THEN 'Yes' WHEN 'FURNITURE' THEN ' no' WHEN 'MACHINERY' THEN 'y' WHEN 'HOUSEHOLD' THEN 'NO ' ELSE 'maybe' END"


@query(
    "MIG-2",
    f"""SELECT c_custkey, CASE WHEN lower(trim({YES_NO})) IN ('yes', 'y') THEN TRUE WHEN lower(trim({YES_NO})) IN ('no', 'n') THEN FALSE END AS flag,
               lower(trim({YES_NO})) NOT IN ('yes', 'y', 'no', 'n') AS rejected FROM customer""",
)
def text_to_boolean(t):
    word = F.lower(F.trim(F.expr(YES_NO)))
    flag = F.when(word.isin("yes", "y"), True).when(word.isin("no", "n"), False)
    return t.customer.select("c_custkey", flag.alias("flag")).withColumn("rejected", F.col("flag").isNull())


@query(
    "MIG-3",
    """WITH codes AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'sold' ELSE lower(o_orderpriority) END AS code FROM orders),
            lookup AS (SELECT code, row_number() OVER (ORDER BY code) AS id FROM (SELECT DISTINCT code FROM codes))
       SELECT o_orderkey, id AS status_id, code FROM codes JOIN lookup USING (code)""",
)
def enum_to_lookup(t):
    # 5-LOW stands in for the misspelt code that has to become 'sold'.
    written = F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN 'saled' ELSE lower(o_orderpriority) END")
    code = F.when(written == "saled", "sold").otherwise(written)
    rows = t.orders.select("o_orderkey", code.alias("code"))
    lookup = row_numbers(rows.select("code").distinct(), [], ["code"], "status_id")
    return rows.join(lookup, "code").select("o_orderkey", "status_id", "code")


@query("MIG-4", "SELECT s_suppkey, s_name AS full_name, s_acctbal AS balance FROM supplier")
def drop_and_rename(t):
    return t.supplier.drop("s_nationkey").withColumnsRenamed({"s_name": "full_name", "s_acctbal": "balance"})


@query(
    "MIG-5",
    """SELECT o_custkey AS user_id, l_partkey AS ad_id, strftime(min(l_shipdate), '%Y-%m-%d') AS added_on
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""",
)
def deduplicate_pairs(t):
    pairs = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("ad_id"), F.col("l_shipdate").alias("added")
    )
    first = change.keep_one(pairs, ["user_id", "ad_id"], [F.col("added")])
    return first.select("user_id", "ad_id", F.date_format("added", "yyyy-MM-dd").alias("added_on"))


@query(
    "MIG-6",
    """WITH stored AS (SELECT user_id, count(*) AS ads, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
                       FROM events WHERE event_type <> 'error' OR user_id > 20 GROUP BY user_id),
            actual AS (SELECT user_id, count(*) AS ads, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM events GROUP BY user_id)
       SELECT user_id, s.ads AS stored_ads, s.total AS stored_total, a.ads AS actual_ads, a.total AS actual_total
       FROM stored s FULL JOIN actual a USING (user_id) WHERE s.ads IS DISTINCT FROM a.ads OR s.total IS DISTINCT FROM a.total""",
)
def drift_report(t):
    def sums(events):
        return events.groupBy("user_id").agg(F.count("*").alias("ads"), total("value").alias("total"))

    stored = sums(t.events.where("event_type <> 'error' OR user_id > 20"))
    return change.drift(stored, sums(t.events), ["user_id"], ["ads", "total"])
