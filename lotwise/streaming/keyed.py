"""Streams whose state the engine holds by key: retries with timers, last prices, counters by step.

Each key's state lies in the engine's own store (RocksDB), read and written only for the keys of a batch, so the cost of a
batch follows the batch and not the state; its changes are part of the checkpoint, so a restarted stream goes on with them.
What a batch tells is written to its own folder, which a replayed batch overwrites.

Times that come before the watermark are late: the engine drops them. ``lateness`` says how far behind they may be.
"""

from __future__ import annotations

import bisect
import datetime
import itertools
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lotwise.streaming.runtime import read_batches, write_batch

BACK_OFF_MINUTES = 5
ERROR_TEXT = "Processing failed"
#: The store that keeps the state of keys on the executors' disks, and only its changes in the checkpoint.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _store(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in STORE}
    for name, value in STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def told(stream: DataFrame, folder: str, fresh: DataFrame | None = None) -> DataFrame:
    """Runs a stream over what is available and returns all that its batches told, with the ``batch`` that told it."""
    spark = stream.sparkSession
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in stream.schema)
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{folder}/told/batch=-1")
    with _store(spark):
        writer = stream.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint")
        writer.foreachBatch(lambda batch, number: write_batch(batch, f"{folder}/told", number)).trigger(availableNow=True).start().awaitTermination()
    return read_batches(spark, f"{folder}/told", schema)


def last_told(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key what the last batch told."""
    rest = [name for name in rows.columns if name not in [*keys, "batch"]]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{name}").alias(name) for name in rest])


def _milliseconds(at: datetime.datetime) -> int:
    return int(at.timestamp() * 1000)


TASK = "status string, attempts bigint, scheduled_at timestamp, last_error string"


class Retries(StatefulProcessor):
    """Open tasks. An outcome completes its task or puts it off; a timer tells when it is due again; finished tasks go."""

    def __init__(self, max_attempts: int | None):
        self.max_attempts = max_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.task = handle.getValueState("task", TASK)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.task.update(tuple(initialState[name] for name in ("status", "attempts", "scheduled_at", "last_error")))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self.task.exists():  # finished before, or never known
            return
        status, attempts, scheduled_at, error = self.task.get()
        done = False
        for row in sorted(rows, key=lambda row: row["seq"]):
            if row["success"]:
                done = True
                break
            attempts, error = attempts + 1, ERROR_TEXT
            scheduled_at = row["at"] + datetime.timedelta(minutes=BACK_OFF_MINUTES)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if done or (self.max_attempts is not None and attempts >= self.max_attempts):
            status = "Completed" if done else "Failed"
            self.task.clear()
        else:
            self.task.update((status, attempts, scheduled_at, error))
            self.handle.registerTimer(_milliseconds(scheduled_at))
        yield Row(task_id=key[0], event="outcome", status=status, attempts=attempts, scheduled_at=scheduled_at, last_error=error)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.task.exists():
            status, attempts, scheduled_at, error = self.task.get()
            yield Row(task_id=key[0], event="due", status=status, attempts=attempts, scheduled_at=scheduled_at, last_error=error)

    def close(self) -> None:
        pass


def retries(tasks: DataFrame, outcomes: DataFrame, folder: str, lateness: str, max_attempts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(tasks after all outcomes so far, tasks that became due again) of a stream of (task_id, seq, at, success).

    ``tasks`` are the open tasks before the first batch. ``folder`` keeps what is told and the checkpoint; a call with the
    same folder goes on where the last one stopped.
    """
    known = outcomes.where("task_id IS NOT NULL").withWatermark("at", lateness)
    processed = known.groupBy("task_id").transformWithState(
        Retries(max_attempts), f"task_id bigint, event string, {TASK}", "Update", "EventTime", tasks.groupBy("task_id")
    )
    rows = told(processed, folder)
    after = last_told(rows.where("event = 'outcome'").drop("event"), ["task_id"])
    changed = after.select(F.col("task_id").alias("_task"), F.struct(*[name for name in after.columns if name != "task_id"]).alias("_new"))
    joined = tasks.join(changed, F.col("task_id") == F.col("_task"), "left")
    now = [F.when(F.col("_task").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name) for name in ("status", "attempts", "scheduled_at", "last_error")]
    return joined.select("task_id", *now), rows.where("event = 'due'").select("task_id", "scheduled_at", "attempts", "batch")


class Prices(StatefulProcessor):
    """The last price of each ad; tells every change."""

    def __init__(self, price: str):
        self.price = price

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", f"seq bigint, price {self.price}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = [(row["seq"], row["price"]) for row in rows]
        if self.last.exists():
            known.append(tuple(self.last.get()))
        known.sort(key=lambda pair: pair[0])
        self.last.update(known[-1])
        for (_, old), (seq, new) in zip(known, known[1:]):
            if old != new:
                yield Row(ad_id=key[0], seq=seq, old_price=old, new_price=new)

    def close(self) -> None:
        pass


def price_changes(prices: DataFrame, folder: str) -> DataFrame:
    """(ad_id, seq, old_price, new_price, difference) of a stream of (ad_id, seq, price), in the order of ``seq``."""
    price = prices.schema["price"].dataType.simpleString()
    schema = f"ad_id bigint, seq bigint, old_price {price}, new_price {price}"
    rows = told(prices.groupBy("ad_id").transformWithState(Prices(price), schema, "Update", "None"), folder)
    return rows.select("ad_id", "seq", "old_price", "new_price", (F.col("new_price") - F.col("old_price")).alias("difference"))


#: Steps of a series that lie in one entry of its state.
RUN = 64


class Counters(StatefulProcessor):
    """Samples of each series since the watermark, and the last value before it. Tells the growth of each step it changes.

    A sample's growth belongs to its step; until the watermark passes a step, late samples may still change it and the
    step after it. An entry of the state, with one timer, holds a run of up to ``RUN`` steps under its first one. New steps
    begin entries of their own, late samples go to the entry they fall into. When the watermark passes the last step of an
    entry, it gives up its samples, and the last of them is what the next step starts from.
    """

    def __init__(self, step: int, key: str):
        self.step, self.key = step, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.before = handle.getValueState("before", "value bigint")
        self.steps = handle.getMapState("steps", "step bigint", "samples array<struct<at:bigint,id:bigint,value:bigint>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = sorted((row["micros"], row["id"], row["value"]) for row in rows)
        known = {place[0]: [tuple(sample) for sample in value[0]] for place, value in self.steps.iterator()}
        before = self.before.get()
        last = None if before is None else before[0]
        old = self._growth(itertools.chain.from_iterable(known[first] for first in sorted(known)), last)
        ends = {first: self._step_of(known[first][-1]) for first in known}
        firsts, changed, fresh = sorted(known), {}, []
        for sample in new:
            at = bisect.bisect_right(firsts, self._step_of(sample)) - 1
            if at < 0 or (at == len(firsts) - 1 and self._step_of(sample) > ends[firsts[at]]):
                fresh.append(sample)
            else:
                changed.setdefault(firsts[at], []).append(sample)
        for first, samples in changed.items():
            known[first] = sorted(known[first] + samples)
        # Samples before all entries and those after them never share an entry.
        early = [sample for sample in fresh if firsts and self._step_of(sample) < firsts[0]]
        for samples in [early, fresh[len(early) :], *[known[first] for first in changed]]:
            for run in self._runs(samples):
                first, end = self._step_of(run[0]), self._step_of(run[-1])
                known[first] = run
                self.steps.updateValue((first,), (run,))
                if ends.get(first) != end:
                    self.handle.registerTimer((end + self.step) * 1000)
        names = self._names(key)
        for step, growth in self._growth(itertools.chain.from_iterable(known[first] for first in sorted(known)), last).items():
            if old.get(step) != growth:
                yield Row(**dict(zip(names, key)), step=step, growth=growth)

    def _step_of(self, sample: tuple) -> int:
        return sample[0] // (self.step * 1_000_000) * self.step

    def _growth(self, samples: Iterable[tuple], last: int | None) -> dict[int, int]:
        """Growth of each step of samples in order."""
        found: dict[int, int] = {}
        for sample in samples:
            step, value = self._step_of(sample), sample[2]
            found[step] = found.get(step, 0) + (0 if last is None else value if value < last else value - last)
            last = value
        return found

    def _runs(self, samples: list[tuple]) -> Iterator[list[tuple]]:
        """Samples in order, cut into runs of whole steps."""
        steps = [list(of) for _, of in itertools.groupby(samples, key=self._step_of)]
        for at in range(0, len(steps), RUN):
            yield list(itertools.chain.from_iterable(steps[at : at + RUN]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = expiredTimerInfo.getExpiryTimeInMs() // 1000 - self.step
        # Timers of one batch may come in any order; what an earlier entry leaves is never put over that of a later one.
        gone = [(place[0], value[0][-1]) for place, value in self.steps.iterator() if self._step_of(tuple(value[0][-1])) <= passed]
        if gone:
            self.before.update((max(gone)[1][2],))
            for first, _ in gone:
                self.steps.removeKey((first,))
        return iter(())

    def _names(self, key) -> list[str]:
        return self.key.split(",")

    def close(self) -> None:
        pass


def counter_growth(samples: DataFrame, series: list[str], time: Column, id_: str, value: str, folder: str, lateness: str, step: int = 15) -> DataFrame:
    """(series, step, growth) of a stream of counter samples: growth since the sample before, in steps of seconds.

    A counter that fell has restarted from zero; samples of one time go by their id. Steps after which the watermark has
    not passed may be told again; the last word counts. Growth of ``series``, added up, serves any sliding window.
    """
    rows = samples.withWatermark("at", lateness).select(*series, "at", F.unix_micros(time).alias("micros"), F.col(id_).alias("id"), F.col(value).cast("bigint").alias("value"))
    types = [f"{name} {rows.schema[name].dataType.simpleString()}" for name in series]
    processed = rows.groupBy(*series).transformWithState(
        Counters(step, ",".join(series)), f"{', '.join(types)}, step bigint, growth bigint", "Update", "EventTime"
    )
    return last_told(told(processed, folder), [*series, "step"])
