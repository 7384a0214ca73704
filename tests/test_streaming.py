"""Streams cut into several micro-batches give what the batch programs give."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from lotwise.functions.money import money
from lotwise.plans.streams import ANY_AGE, _grown, _prices, open_tasks, outcomes_of
from lotwise.sources.tables import SCHEMAS, Tables
from lotwise.sources.workspace import new_path
from lotwise.streaming import keyed, queue, runtime, series, triggers
from tests.conftest import SMALL


def rows(df, *names):
    return sorted(map(tuple, df.select(*names).collect() if names else df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture(scope="module")
def in_three(spark, tables):
    """The events in three files, in the order of their ids."""
    path = new_path(spark, "events")
    third = tables.events.count() // 3 + 1
    for i in range(3):
        part = tables.events.where(F.col("event_id").between(i * third, (i + 1) * third - 1))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return runtime.file_stream(spark, path, SCHEMAS["events"], files_per_batch=1)


def test_outcomes_over_batches(spark, tables, in_three):
    whole = queue.fold_outcomes(open_tasks(tables), outcomes_of(tables.events))
    streamed, _ = keyed.retries(open_tasks(tables), outcomes_of(stream(spark, in_three)), new_path(spark, "retries"), ANY_AGE)
    assert rows(streamed) == rows(whole)


def test_price_changes_over_batches(spark, tables, in_three):
    streamed = keyed.price_changes(_prices(stream(spark, in_three)), new_path(spark, "prices"))
    assert rows(streamed) == rows(triggers.price_changes(_prices(tables.events)))


def test_operation_log(spark, tables, in_three):
    log = triggers.operation_log(spark, stream(spark, in_three), "INSERT", "events")
    assert log.count() == 3
    assert log.agg(F.sum("affected_rows")).first()[0] == tables.events.count()


def test_alert_per_batch(spark, in_three):
    alerts = triggers.batch_alerts(spark, stream(spark, in_three), "event_type", "events").collect()
    assert len(alerts) == 3 and all("Names: click, error, purchase, signup, view" in a["message"] for a in alerts)


def test_restart_repeats_nothing(spark, in_three):
    path, checkpoint = new_path(spark, "rows"), new_path(spark, "checkpoint")
    for _ in range(2):
        runtime.run_batches(stream(spark, in_three), lambda df, n: runtime.write_batch(df, path, n), checkpoint)
    assert spark.read.parquet(path).select("event_id").distinct().count() == spark.read.parquet(path).count()


def test_windowed_throughput(spark, tables, in_three):
    done = tables.events.withColumn("ts", F.col("ts").cast("timestamp"))
    streamed = runtime.final_result(queue.throughput(stream(spark, in_three).withWatermark("ts", "1 minute"), "ts"), ["window_start"])
    assert rows(streamed) == rows(queue.throughput(done, "ts"))


def outcomes(spark, data):
    df = spark.createDataFrame(data, "task_id bigint, seq bigint, at string, success boolean")
    return df.withColumn("at", F.col("at").cast("timestamp"))


def tasks(spark, *ids):
    df = spark.createDataFrame([(i, "Ready", 0, "2024-01-01", None) for i in ids], "task_id bigint, status string, attempts bigint, scheduled_at string, last_error string")
    return df.withColumn("scheduled_at", F.col("scheduled_at").cast("timestamp"))


def test_retry_rules(spark):
    folded = queue.fold_outcomes(
        tasks(spark, 1, 2, 3, 4),
        outcomes(
            spark,
            [
                (1, 1, "2024-01-02 10:00:00", True),
                (2, 2, "2024-01-02 10:00:00", False), (2, 3, "2024-01-02 11:00:00", True), (2, 4, "2024-01-02 12:00:00", False),
                (3, 5, "2024-01-02 10:00:00", False), (3, 6, "2024-01-02 10:30:00", False), (3, 7, "2024-01-02 11:00:00", False),
            ],
        ),
        max_attempts=3,
    )
    found = rows(folded.withColumn("scheduled_at", F.col("scheduled_at").cast("string")))
    assert found == [
        (1, "Completed", 0, "2024-01-01 00:00:00", None),
        (2, "Completed", 1, "2024-01-02 10:05:00", "Processing failed"),
        (3, "Failed", 3, "2024-01-02 11:05:00", "Processing failed"),
        (4, "Ready", 0, "2024-01-01 00:00:00", None),
    ]


def test_dispatch_order(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 'Ready', 0, 1, 1), (2, 'Ready', 100, 5, 5), (3, 'Ready', 100, 3, 3), (4, 'Running', 100, 1, 1), (5, 'Ready', 100, 1, 99) "
        "AS t(task_id, status, priority, created_at, scheduled_at)"
    )
    assert [r["task_id"] for r in queue.dispatch_plan(df, F.lit(10), 3).collect()] == [3, 2, 1]


def test_counter_reset(spark):
    df = spark.sql(
        "SELECT key, id, timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 15) AS ts, v FROM VALUES "
        "('a', 0, 10), ('a', 1, 25), ('a', 2, 5), ('a', 3, 5), ('b', 1, 7) AS t(key, id, v)"
    )
    grown = series.increases(df, ["key"], "ts", "id", "v")
    assert rows(grown, "key", "id", "increase") == [("a", 0, 0), ("a", 1, 15), ("a", 2, 5), ("a", 3, 0), ("b", 1, 0)]
    rates = series.sliding_rates(grown, ["key"], "ts", span=30, step=15).where("key = 'a'").orderBy("window_start")
    assert [round(r["rate"], 4) for r in rates.collect()] == [0.0, 0.5, 0.6667, 0.1667, 0.0]


def _samples(events):
    return events.select("event_id", "event_type", "user_id", F.col("ts").cast("timestamp").alias("at"), (money("value") * 100).cast("bigint").alias("cents"))


def _steps(stream_, folder, lateness=ANY_AGE):
    return keyed.counter_growth(_samples(stream_), ["event_type", "user_id"], F.col("at"), "event_id", "cents", folder, lateness)


def _batch_steps(tables):
    second = F.unix_timestamp(F.col("ts").cast("timestamp"))
    grown = _grown(tables).groupBy("event_type", "user_id", (F.floor(second / 15) * 15).alias("step"))
    return grown.agg(F.sum("increase").alias("growth"))


@pytest.mark.parametrize("case", ["queue", "prices", "counters"])
def test_a_stopped_stream_goes_on(spark, tables, case):
    """Five batches, a stop after three of them; a call with the same folder ends at the result of the batch program."""
    folder, source = new_path(spark, "resumed"), new_path(spark, "growing")
    fifth = tables.events.count() // 5 + 1

    def add(number):
        part = tables.events.where(F.col("event_id").between(number * fifth, (number + 1) * fifth - 1))
        part.coalesce(1).write.mode("append").parquet(source)

    def run():
        rows_ = stream(spark, source)
        if case == "queue":
            return keyed.retries(open_tasks(tables), outcomes_of(rows_), folder, ANY_AGE)[0]
        if case == "prices":
            return keyed.price_changes(_prices(rows_), folder)
        return _steps(rows_, folder)

    for number in range(3):
        add(number)
    run()
    for number in range(3, 5):
        add(number)
    resumed = rows(run())
    whole = {
        "queue": lambda: queue.fold_outcomes(open_tasks(tables), outcomes_of(tables.events)),
        "prices": lambda: triggers.price_changes(_prices(tables.events)),
        "counters": lambda: _batch_steps(tables),
    }[case]()
    assert resumed == rows(whole)
    assert rows(run()) == resumed


def _files(spark, name, batches, schema):
    path = new_path(spark, name)
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def test_timers_tell_what_is_due_again_and_finished_tasks_go(spark):
    schema = "task_id bigint, seq bigint, at timestamp, success boolean"

    def at(minute):
        return datetime.datetime(2024, 1, 1, 12, minute)

    batches = [[(1, 1, at(0), False), (2, 2, at(0), False)], [(2, 3, at(1), True)], [(3, 4, at(6), False)], [(9, 5, at(6), True)], [(1, 6, at(8), False), (2, 7, at(8), False)], [(3, 8, at(30), True)]]
    path, folder = _files(spark, "outcomes", batches, schema), new_path(spark, "retries")
    outcomes_ = runtime.file_stream(spark, path, schema, files_per_batch=1)
    after, due = keyed.retries(tasks(spark, 1, 2, 3), outcomes_, folder, "0 seconds", max_attempts=5)
    found = {r["task_id"]: (r["status"], r["attempts"], r["scheduled_at"]) for r in after.collect()}
    assert found == {1: ("Ready", 2, at(13)), 2: ("Completed", 1, at(5)), 3: ("Completed", 1, at(11))}
    # Task 1 is due after each failure once the watermark has passed; task 2 was done before, task 3 as it came due.
    assert sorted((r["task_id"], r["scheduled_at"]) for r in due.collect()) == [(1, at(5)), (1, at(13))]
    state = spark.read.format("statestore").option("stateVarName", "task").load(f"{folder}/checkpoint")
    assert [r[0] for r in state.selectExpr("key.task_id").collect()] == [1]


def test_a_batch_touches_the_state_of_its_keys_only(spark):
    """The work of a small batch does not follow the number of open tasks."""
    schema = "task_id bigint, seq bigint, at timestamp, success boolean"
    rows_ = [(n, n, datetime.datetime(2024, 1, 1), False) for n in range(3)]
    path, folder = _files(spark, "outcomes", [rows_[:1], rows_[1:]], schema), new_path(spark, "retries")
    many = spark.range(20_000).select(F.col("id").alias("task_id"), F.lit("Ready").alias("status"), F.lit(0).cast("bigint").alias("attempts"), F.lit("2024-01-01").cast("timestamp").alias("scheduled_at"), F.lit(None).cast("string").alias("last_error"))
    after, _ = keyed.retries(many, runtime.file_stream(spark, path, schema, files_per_batch=1), folder, ANY_AGE)
    assert after.where("attempts = 1").count() == 3 and after.count() == 20_000
    told_ = runtime.read_batches(spark, f"{folder}/told", "task_id bigint")
    assert sorted((r["batch"], r["count"]) for r in told_.groupBy("batch").count().collect()) == [(0, 1), (1, 2)]


def test_counters_with_late_samples(spark):
    """Late samples within the watermark change what was told; later ones are given up, as is the state of passed steps."""
    schema = "event_id bigint, event_type string, user_id bigint, ts timestamp, value double"

    def at(second):
        return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)

    def sample(n, second, value):
        return n, "a", None, at(second), value

    batches = [[sample(1, 0, 1.0), sample(2, 20, 5.0)], [sample(3, 40, 2.0)], [sample(4, 10, 3.0)], [sample(5, 200, 9.0)], [sample(6, 215, 10.0)], [sample(7, 21, 100.0), sample(8, 216, 10.0)]]
    path, folder = _files(spark, "samples", batches, schema), new_path(spark, "steps")
    found = _steps(runtime.file_stream(spark, path, schema, files_per_batch=1), folder, "60 seconds")
    start = int(datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc).timestamp())
    # 1, 3 in the first step, 5 in the second, a fall to 2 in the third; 9 and 10 go on from 2; the sample 7 came too late.
    assert {r["step"] - start: r["growth"] for r in found.collect()} == {0: 200, 15: 200, 30: 200, 195: 700, 210: 100}
    state = spark.read.format("statestore").option("stateVarName", "steps").load(f"{folder}/checkpoint")
    assert sorted(r[0] - start for r in state.selectExpr("user_map_key.step" if "user_map_key" in state.columns else "map_value.step").collect()) in ([195, 210], [210])


def test_many_names_in_several_messages(spark):
    told = triggers.batch_summary(spark.range(5000).select(F.col("id").cast("string").alias("name")), "name", "t").collect()
    assert len(told) > 1 and sum(row["record_count"] for row in told) == 5000


class _State:
    """The state of one key in memory, counting the calls that change it."""

    def __init__(self):
        self.values, self.value, self.calls = {}, None, 0

    def iterator(self):
        return iter([((first,), value) for first, value in self.values.items()])

    def updateValue(self, key, value):
        self.calls += 1
        self.values[key[0]] = value

    def removeKey(self, key):
        del self.values[key[0]]

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.calls += 1


def test_counters_keep_runs_of_steps():
    """Few calls to the state for many steps, and the growth of the sorted samples in whatever batches they come."""
    pick = random.Random(5)
    samples = sorted((pick.randint(0, 6000) * 1_000_000, n, pick.randint(0, 9)) for n in range(600))
    for batches in (1, 4, 25):
        state, before, told_ = _State(), _State(), {}
        counters = keyed.Counters(15, "name")
        counters.handle, counters.steps, counters.before = state, state, before
        given = samples[:]
        pick.shuffle(given)
        for at in range(batches):
            rows_ = [dict(zip(("micros", "id", "value"), sample)) for sample in given[at::batches]]
            told_.update({row["step"]: row["growth"] for row in counters.handleInputRows(("x",), rows_, None)})
        assert told_ == counters._growth(samples, None)
        assert sorted(sample for value in state.values.values() for sample in value[0]) == samples
        assert batches > 1 or state.calls <= 2 * (len(told_) // keyed.RUN + 1)
        assert all(first == counters._step_of(value[0][0]) for first, value in state.values.items())
        assert max(len({counters._step_of(s) for s in value[0]}) for value in state.values.values()) <= keyed.RUN


def test_means_count_a_series_once_a_window(spark):
    """Every window by brute force, series and times with nulls."""
    pick = random.Random(9)
    begin = datetime.datetime(2024, 1, 1)
    given = [(pick.choice(["a", "b", None]), pick.randint(1, 4), begin + datetime.timedelta(seconds=pick.randint(0, 3000)), pick.randint(0, 50)) for _ in range(200)]
    given += [("a", 1, None, 7), ("a", 1, None, 8), ("b", 2, None, 9)]
    grown = spark.createDataFrame(given, "kind string, name int, ts timestamp, increase bigint")
    each = series.sliding_growth(grown, ["kind", "name"], "ts")
    want = each.groupBy("window_start").agg((F.sum("growth").cast("double") / 300 / F.count("*")).alias("mean_rate"))
    found = series.mean_rates(grown, ["kind", "name"], "ts")
    assert rows(found) == rows(want) and found.count() > 200
    assert "kind" not in found._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]  # no series is dealt to windows
