"""The attempt ledger as a stream: windowed progress, the progress of runs and the concurrency policy
as keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quillmesh.operators.ledger import ConcurrencyPolicy


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """A folder of event files as a stream, with the schema that the files have now."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def progress(attempts: DataFrame, every: str = "5 minutes", late: str | None = "10 minutes") -> DataFrame:
    """Attempts and successes by window of event time; in append mode closed windows only, late rows
    dropped after the watermark. With ``late`` None there is no watermark, for complete mode."""
    window = F.window("occurred_at", every)
    rows = attempts if late is None else attempts.withWatermark("occurred_at", late)
    out = rows.groupBy(window).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("final_result") == "SUCCESS").alias("successes"))
    return out.select(F.col("window.start").alias("start"), "attempts", "successes")


def concurrency_changes(attempts: DataFrame, policy: ConcurrencyPolicy | None = None) -> DataFrame:
    """``domain, before, after`` of every change, in arrival order by (occurred_at, attempt_id)
    within a batch. The state of a domain is one integer."""
    policy = policy or ConcurrencyPolicy()

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at = state.get[0] if state.exists else (policy.start - 1) * policy.restore
        rows = pd.concat(list(frames)).sort_values(["occurred_at", "attempt_id"])
        changes = []
        for result in rows["final_result"]:
            if result in ("SUCCESS", "RATE_LIMITED"):
                then = int((policy.succeeded if result == "SUCCESS" else policy.limited)[at])
                before, after = at // policy.restore + 1, then // policy.restore + 1
                if before != after:
                    changes.append((key[0], before, after))
                at = then
        state.update((at,))
        yield pd.DataFrame(changes, columns=["domain", "before", "after"])

    return attempts.groupBy("domain").applyInPandasWithState(step, "domain string, before long, after long", "at long", "append", GroupStateTimeout.NoTimeout)


# fixed value: the store that arbitrary state needs
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SNAPSHOT = "run_id string, processed long, succeeded long, elapsed_seconds double, per_second double, state string"


class RunProgress(StatefulProcessor):
    """How far each run is: its attempts and successes so far, the time from its first attempt to its
    last, and their rate. A run ends with its completion, or when ``idle_ms`` pass without an attempt."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "processed long, succeeded long, first long, last long")

    def _snapshot(self, run: str, totals: tuple, state: str) -> pd.DataFrame:
        processed, succeeded, first, last = totals
        elapsed = (last - first) / 1e6 if processed else 0.0
        rate = processed / elapsed if elapsed else None
        row = [(run, processed, succeeded, elapsed, rate, state)]
        return pd.DataFrame(row, columns=["run_id", "processed", "succeeded", "elapsed_seconds", "per_second", "state"]).astype({"per_second": float})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        processed, succeeded, first, last = self.totals.get() if self.totals.exists() else (0, 0, 2**62, -(2**62))
        done = False
        for pdf in rows:
            tried = pdf[~pdf["completed"]]
            done |= bool(pdf["completed"].any())
            if len(tried):
                processed, succeeded = processed + len(tried), succeeded + int(tried["ok"].sum())
                first, last = min(first, int(tried["at"].min())), max(last, int(tried["at"].max()))
        totals = (processed, succeeded, first, last)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if done:
            self.totals.clear()
        else:
            self.totals.update(totals)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._snapshot(key[0], totals, "final" if done else "running")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.totals.exists():
            totals = self.totals.get()
            self.totals.clear()
            yield self._snapshot(key[0], totals, "interrupted")

    def close(self) -> None:
        pass


@contextmanager
def without_empty_batches(spark: SparkSession) -> Iterator[None]:
    """Queries that start here have batches for new rows only; timers fire in the next of those."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def run_progress(attempts: DataFrame, idle_ms: int = 3_600_000) -> DataFrame:
    """``run_id, processed, succeeded, elapsed_seconds, per_second, state`` from a stream of attempts
    (run_id, occurred_at, final_result; "COMPLETED" ends a run): a row a run and batch with attempts
    (state "running"), and one last row when a run ends ("final", or "interrupted" if it fell silent).

    The state of a run is four numbers, kept over restarts. A run's rate has no value before time has passed.
    A query that is to end with the available rows must do without batches for timers alone
    (``without_empty_batches``), since those never end.
    Null run ids are a run; null times and results count as attempts at the time 0 without success.
    """
    attempts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = attempts.select(
        F.coalesce(F.col("run_id").cast("string"), F.lit("")).alias("run_id"),
        F.coalesce(F.unix_micros("occurred_at"), F.lit(0)).alias("at"),
        F.coalesce(F.col("final_result") == "SUCCESS", F.lit(False)).alias("ok"),
        F.coalesce(F.col("final_result") == "COMPLETED", F.lit(False)).alias("completed"),
    )
    return rows.groupBy("run_id").transformWithStateInPandas(RunProgress(idle_ms), SNAPSHOT, "Append", "ProcessingTime")
