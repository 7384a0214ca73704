"""Gates from the metrics of a write, bucketed joins, sketches of distinct values."""

import duckdb
from pyspark.sql import functions as F

from lotwise.operators import change
from lotwise.operators.aggregates import distinct_estimates, distinct_pairs, distinct_sketches
from lotwise.operators.quality import written
from lotwise.plans import CATALOGUE
from lotwise.sources.files import bucketed
from lotwise.sources.workspace import new_path
from tests.conftest import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_come_with_the_write(spark):
    path = new_path(spark, "observed")
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            reads.add(1)
            yield row

    source = spark.createDataFrame(spark.sparkContext.parallelize(range(1000), 4).mapPartitions(counted).map(lambda n: (n, n % 3)), "id bigint, part bigint")
    seen = written(source, path, rows=F.count(F.lit(1)), odd=F.count_if(F.col("part") == 1), top=F.max("id"))
    assert seen == {"rows": 1000, "odd": 333, "top": 999}
    assert reads.value == 1000 and spark.read.parquet(path).count() == 1000


def test_a_gate_sees_what_a_join_loses(spark, tmp_path):
    connection = duckdb.connect()
    for name in ("lineitem", "part"):
        where = "WHERE p_partkey % 2 = 0" if name == "part" else ""
        connection.execute(f"COPY (SELECT * FROM '{SMALL}/{name}.parquet' {where}) TO '{tmp_path}/{name}.parquet'")
    found = {r["status"]: (r["fact_rows"], r["extract_rows"], r["difference"]) for r in CATALOGUE["DQ-12"](spark, str(tmp_path)).collect()}
    want = connection.execute(f"SELECT l_returnflag, count(*), count(*) FILTER (l_partkey % 2 = 0), count(*) FILTER (l_partkey % 2 <> 0) FROM '{SMALL}/lineitem.parquet' GROUP BY 1").fetchall()
    assert found == {status: tuple(counts) for status, *counts in want}


def test_bucketed_tables_join_without_an_exchange(spark):
    left = bucketed(spark, "left-side", [f"{SMALL}/orders.parquet"], lambda: spark.read.parquet(f"{SMALL}/orders.parquet").select("o_orderkey", "o_custkey"), "o_custkey", 8)
    right = bucketed(spark, "right-side", [f"{SMALL}/customer.parquet"], lambda: spark.read.parquet(f"{SMALL}/customer.parquet").select("c_custkey", "c_name"), "c_custkey", 8)
    joined = left.join(right, F.col("o_custkey") == F.col("c_custkey"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(joined)
        grouped = plan_of(left.groupBy("o_custkey").count())
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Exchange" not in grouped
        assert joined.count() == spark.read.parquet(f"{SMALL}/orders.parquet").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    again = bucketed(spark, "left-side", [f"{SMALL}/orders.parquet"], lambda: 1 / 0, "o_custkey", 8)
    assert again.count() == left.count()


def test_sketches_merge_over_any_span(spark):
    rows = spark.range(60_000).selectExpr("id % 4 AS shop", "id % 30 AS day", "(id * 7919) % 9000 AS value")
    daily = distinct_sketches(rows, ["shop", "day"], "value", "sketch")
    assert daily.count() == rows.select("shop", "day").distinct().count()
    for span in ("day < 30", "day BETWEEN 3 AND 11", "day = 5"):
        exact = {r["shop"]: r["n"] for r in distinct_pairs(rows.where(span), "shop", n="value").collect()}
        found = {r["shop"]: r["n"] for r in distinct_estimates(daily.where(span), ["shop"], "sketch", "n").collect()}
        assert found.keys() == exact.keys() and all(abs(found[s] - exact[s]) <= 1 + 0.05 * exact[s] for s in exact)


def test_distinct_counts_repeat_no_row(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 'a', 5), (1, 'a', 6), (1, NULL, 6), (NULL, 'b', 7), (NULL, 'b', NULL), (2, NULL, NULL) AS t(k, x, y)")
    counted = distinct_pairs(rows, "k", xs="x", ys="y")
    assert sorted(map(repr, map(tuple, counted.collect()))) == ["(1, 1, 2)", "(2, 0, 0)", "(None, 1, 1)"]
    assert "Expand" not in plan_of(counted)


def test_keyless_changes_leave_other_rows_where_they_are(spark):
    target = spark.range(1000).selectExpr("id % 10 AS a", "IF(id % 7 = 0, NULL, 'x') AS b")
    removed = spark.sql("SELECT 3L AS a, CAST(NULL AS STRING) AS b UNION ALL SELECT 3L, 'x' UNION ALL SELECT 99L, 'y'")
    added = spark.sql("SELECT 3L AS a, 'new' AS b UNION ALL SELECT 99L, 'y' UNION ALL SELECT 99L, 'y' UNION ALL SELECT 4L, 'x'")
    found = change.apply_keyless(target, removed, added)
    counts = {tuple(r)[:2]: r["n"] for r in found.groupBy("a", "b").agg(F.count("*").alias("n")).collect()}
    old = {tuple(r)[:2]: r["n"] for r in target.groupBy("a", "b").agg(F.count("*").alias("n")).collect()}
    want = old | {(3, None): old[3, None] - 1, (3, "x"): old[3, "x"] - 1, (3, "new"): 1, (99, "y"): 1, (4, "x"): old[4, "x"] + 1}
    assert counts == want
