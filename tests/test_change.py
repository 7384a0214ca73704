"""Upserts, feeds, deletes and purchase batches on small fixtures with nulls, repeats and missing keys."""

import pytest
from pyspark.sql import functions as F

from lotwise.operators import change, purchases
from lotwise.operators.copies import steps


def rows(df, *names):
    return sorted(map(tuple, df.select(*names).collect() if names else df.collect()), key=repr)


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", None), (3, "c", 30)], "id int, name string, price int")


def test_upsert(spark, table):
    new = spark.createDataFrame([(2, "B", 5), (4, "d", None)], "id int, name string, price int")
    expected = [(1, "a", 10), (2, "B", 5), (3, "c", 30), (4, "d", None)]
    once = change.upsert(table, new, ["id"])
    assert rows(once) == expected
    assert rows(change.upsert(once, new, ["id"])) == expected


def test_insert_absent(spark, table):
    new = spark.createDataFrame([(2, "B", 5), (4, "d", 1)], "id int, name string, price int")
    once = change.insert_absent(table, new, ["id"])
    assert rows(once) == [(1, "a", 10), (2, "b", None), (3, "c", 30), (4, "d", 1)]
    assert rows(change.insert_absent(once, new, ["id"])) == rows(once)


def test_keep_one(spark):
    df = spark.createDataFrame([("x", 1, "old"), ("x", 2, None), ("y", 5, "only")], "k string, at int, v string")
    assert rows(change.keep_one(df, ["k"], [F.col("at")])) == [("x", 1, "old"), ("y", 5, "only")]
    assert rows(change.keep_one(df, ["k"], [F.col("at")], last=True)) == [("x", 2, None), ("y", 5, "only")]


def test_patch(spark, table):
    changes = spark.createDataFrame([(1, 11), (2, None), (9, 9)], "id int, price int")
    assert rows(change.patch(table, changes, "id")) == [(1, "a", 11), (2, "b", None), (3, "c", 30)]


def test_unknown_conditions(table):
    cheap = F.col("price") < 20
    assert rows(change.update_where(table, cheap, {"price": F.lit(0)}), "id", "price") == [(1, 0), (2, None), (3, 30)]
    assert rows(change.delete_where(table, cheap), "id") == [(2,), (3,)]
    kept, gone = change.split_deleted(table, cheap)
    assert rows(kept, "id") == [(2,), (3,)] and rows(gone, "id") == [(1,)]


def test_deleted_parents(spark, table):
    children = spark.createDataFrame([(10, 1), (11, 2), (12, None), (13, 1)], "child int, parent int")
    gone = table.where("id = 1")
    assert rows(change.delete_children(children, gone, "parent", "id")) == [(11, 2), (12, None)]
    assert rows(change.null_children(children, gone, "parent", "id"), "child", "parent") == [(10, None), (11, 2), (12, None), (13, None)]


def test_audit_of_nulls(spark):
    old = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 5), (5, None), (6, 1)], "id int, v int")
    new = spark.createDataFrame([(1, 5), (2, 7), (3, 4), (4, None), (5, None), (7, 1)], "id int, v int")
    assert rows(change.changed_rows(old, new, "id", "v")) == [(2, 5, 7, 2), (3, None, 4, None), (4, 5, None, None)]


FEED = "op string, seq int, id int, name string, price int, extra string"


def test_feed_latest_wins(spark, table):
    feed = spark.createDataFrame(
        [
            ("U", 1, 1, "a1", 1, "x"), ("U", 3, 1, "a3", 3, "x"), ("U", 2, 1, "a2", 2, "x"),
            ("D", 4, 2, None, None, None),
            ("D", 5, 3, None, None, None), ("I", 6, 3, "c2", 31, "x"),
            ("I", 7, 4, "d", 4, "x"), ("D", 8, 4, None, None, None), ("I", 9, 5, "e", 5, "x"),
        ],
        FEED,
    )
    assert rows(change.apply_changes(table, feed, ["id"])) == [(1, "a3", 3), (3, "c2", 31), (5, "e", 5)]
    narrow = change.apply_changes(table.select("id", "price"), feed, ["id"])
    assert rows(narrow) == [(1, 3), (3, 31), (5, 5)]


def test_keyless_feed(spark):
    schema = "id int, data string"
    table = spark.createDataFrame([(1, "row1"), (1, "row1"), (2, None), (3, "x")], schema)
    removed = spark.createDataFrame([(1, "row1"), (2, None), (1, "mid")], schema)
    added = spark.createDataFrame([(1, "mid"), (1, "end"), (2, "two")], schema)
    assert rows(change.apply_keyless(table, removed, added)) == sorted([(1, "row1"), (1, "end"), (2, "two"), (3, "x")], key=repr)


@pytest.mark.parametrize("block", [1, 3, 100])
def test_steps(spark, block):
    df = spark.createDataFrame([("a", 1, 7), ("b", 5, 5), ("c", 3, 2), ("d", 0, 3)], "k string, lo int, hi int")
    found = rows(steps(df, F.col("lo"), F.col("hi"), "n", block), "k", "n")
    assert found == sorted([("a", n) for n in range(1, 8)] + [("b", 5)] + [("d", n) for n in range(4)], key=repr)


def test_drift(spark):
    stored = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, n int")
    actual = spark.createDataFrame([(1, 5), (2, 7), (4, 1)], "id int, n int")
    found = change.drift(stored, actual, ["id"], ["n"])
    assert rows(found, "id", "stored_n", "actual_n") == [(2, 6, 7), (4, None, 1)]


@pytest.fixture
def market(spark):
    ads = spark.createDataFrame(
        [(1, 7, "active"), (2, 7, "sold"), (3, 8, "active"), (4, 8, "active")], "ad_id int, seller_id int, status string"
    )
    users = spark.createDataFrame([(100,), (101,)], "user_id int")
    requests = spark.createDataFrame(
        [(1, 1, 999, 5), (2, 1, 100, 0), (3, 1, 101, 50), (4, 1, 100, 60), (5, 2, 100, 5), (6, 77, 100, 5), (7, 3, 100, None), (8, 4, 100, 9)],
        "request_id int, ad_id int, buyer_id int, amount int",
    )
    return requests, ads, users


def test_purchase_codes(market):
    found = dict(rows(purchases.check_requests(*market), "request_id", "code"))
    assert found == {
        1: "unknown buyer", 2: "amount not positive", 3: "ok", 4: "ok", 5: "ad not active", 6: "unknown ad",
        7: "amount not positive", 8: "ok",
    }


def test_first_valid_request_wins(market):
    contracts, ads = purchases.purchase(*market)
    assert rows(contracts, "request_id", "ad_id", "seller_id", "buyer_id", "amount") == [(3, 1, 7, 101, 50), (8, 4, 8, 100, 9)]
    assert rows(ads, "ad_id", "status") == [(1, "sold"), (2, "sold"), (3, "active"), (4, "sold")]


def test_discount_stops_after_ten(spark):
    ads = spark.createDataFrame(
        [(i, 1, "active" if i != 2 else "sold", None if i == 3 else 105) for i in range(1, 16)],
        "ad_id int, seller_id int, status string, price bigint",
    )
    found = dict(rows(purchases.discount_first(ads, 10), "ad_id", "price"))
    assert found[1] == 95 and found[2] == 105 and found[3] is None and found[12] == 95 and found[13] == 105


def test_hand_over(spark):
    owned = spark.sql(
        "SELECT * FROM VALUES (1, 10, date'2020-01-01', date'2021-01-01', 'n'), (1, 11, date'2021-01-01', NULL, 'n'), (2, 12, date'2020-05-05', NULL, 'n') "
        "AS t(vehicle_id, owner_id, purchase_date, sale_date, note)"
    )
    sales = spark.sql("SELECT 1 AS vehicle_id, 20 AS buyer_id, date'2024-02-02' AS sold_on")
    after = purchases.hand_over(owned, sales).selectExpr("vehicle_id", "owner_id", "string(purchase_date)", "string(sale_date)")
    assert rows(after) == sorted(
        [(1, 10, "2020-01-01", "2021-01-01"), (1, 11, "2021-01-01", "2024-02-02"), (2, 12, "2020-05-05", None), (1, 20, "2024-02-02", None)], key=repr
    )
