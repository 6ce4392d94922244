"""The attempt ledger: rollups, and state machines rebuilt from recorded attempts.

An attempts table has run_id, url, domain, occurred_at, attempt_id, final_result, and may have
retry_number, acquisition_method, proxy_status. Order is (occurred_at, attempt_id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.storage import materialize

UNHEALTHY_AFTER = 3
BACKOFF_BASE, BACKOFF_MOST = 1.0, 60.0


def _success() -> Column:
    return F.col("final_result") == "SUCCESS"


def outcome(status: Column, failure: Column) -> Column:
    """Result of one HTTP attempt from its status, or from how it failed without one."""
    return (
        F.when(failure == "oversize", "BLOCKED")
        .when(failure == "timeout", "TIMEOUT")
        .when(failure == "unreachable", "NETWORK_ERROR")
        .when(status == 429, "RATE_LIMITED")
        .when(status.isin(401, 403), "ACCESS_DENIED")
        .when(status == 408, "TIMEOUT")
        .when(status == 404, "NOT_FOUND")
        .when(status >= 400, "NETWORK_ERROR")
        .otherwise("SUCCESS")
    )


def outcome_detail(status: Column, failure: Column) -> Column:
    return (
        F.when(failure == "oversize", "artifact_too_large")
        .when(failure == "timeout", "connect_timeout")
        .when(failure == "unreachable", "connection_failed")
        .when(status >= 400, F.concat(F.lit("http_"), status.cast("string")))
    )


def run_status(attempted: Column, acquired: Column, interrupted: Column | None = None) -> Column:
    """FAILED without any URL or success, SUCCESS if all succeeded, else PARTIAL; an interrupt overrides."""
    derived = F.when(acquired == 0, "FAILED").when(acquired == attempted, "SUCCESS").otherwise("PARTIAL")
    return derived if interrupted is None else F.when(interrupted, "INTERRUPTED").otherwise(derived)


def last_results(attempts: DataFrame) -> DataFrame:
    """The last result of each URL of a run. A partial aggregate: no window, no sort."""
    return attempts.groupBy("run_id", "url").agg(F.max_by("final_result", F.struct("occurred_at", "attempt_id")).alias("final_result"))


def run_rollup(attempts: DataFrame) -> DataFrame:
    """One row a run: attempted, acquired, failed, retries, rate_limited, browser_pages,
    proxy_failures, status. Retries count attempts with a retry number, not the sum of numbers; a
    quarantined proxy isn't counted as a failure."""
    urls = last_results(attempts).groupBy("run_id").agg(F.count(F.lit(1)).alias("attempted"), F.count_if(_success()).alias("acquired"))
    facts = attempts.groupBy("run_id").agg(
        F.count_if(F.col("retry_number") > 0).alias("retries"),
        F.count_if(F.col("final_result") == "RATE_LIMITED").alias("rate_limited"),
        F.count_if(_success() & (F.col("acquisition_method") == "browser")).alias("browser_pages"),
        F.count_if(F.col("proxy_status") == "unhealthy").alias("proxy_failures"),
    )
    out = urls.join(facts, "run_id")
    return out.withColumn("failed", F.col("attempted") - F.col("acquired")).withColumn("status", run_status(F.col("attempted"), F.col("acquired")))


def state_counts(attempts: DataFrame) -> DataFrame:
    return last_results(attempts).groupBy("run_id", "final_result").agg(F.count(F.lit(1)).alias("urls"))


def url_history(attempts: DataFrame) -> DataFrame:
    """Attempts and last result of each URL by retry number first: the report's order, which is not
    the rollup's."""
    return attempts.groupBy("run_id", "url").agg(F.count(F.lit(1)).alias("attempts"), F.max_by("final_result", F.struct("retry_number", "occurred_at", "attempt_id")).alias("last_result"))


def _ordered(*keys: str):
    return Window.partitionBy(*keys).orderBy("occurred_at", "attempt_id")


def with_retry_numbers(attempts: DataFrame) -> DataFrame:
    """Retry numbers of a ledger that has none: earlier attempts of the URL in the run."""
    return attempts.withColumn("retry_number", F.row_number().over(_ordered("run_id", "url")) - 1)


def _since_reset(attempts: DataFrame, key: str, counted: Column, reset: Column) -> DataFrame:
    """``streak``: counted rows since the last reset of the key, this row included; ``streak_before``:
    the same up to the row before.

    The ledger is cut into ranges of (key, time), which are counted apart; what a range takes over from
    those before it comes from one row a range and key. So a hot key is the work of many tasks.
    """
    ranged = attempts.repartitionByRange(key, "occurred_at", "attempt_id")
    rows = ranged.withColumn("__range", F.spark_partition_id())
    inside = _ordered(key, "__range").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__island", F.sum(reset.cast("int")).over(inside))
    island = _ordered(key, "__range", "__island").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("streak", F.sum(counted.cast("int")).over(island)).withColumn("streak_before", F.lag("streak").over(_ordered(key, "__range")))
    # written, as it is read twice and its ranges could differ in a second run
    rows = materialize(rows, "streaks")
    ends = rows.groupBy(key, "__range").agg(F.max_by("streak", F.struct("occurred_at", "attempt_id")).alias("__tail"), (F.max("__island") > 0).cast("int").alias("__reset"))
    by_range = Window.partitionBy(key).orderBy("__range")
    ends = ends.withColumn("__since", F.sum("__reset").over(by_range))
    ends = ends.withColumn("__sum", F.sum("__tail").over(Window.partitionBy(key, "__since").orderBy("__range")))
    ends = ends.select(F.col(key).alias("__key"), F.col("__range").alias("__of"), F.coalesce(F.lag("__sum").over(by_range), F.lit(0)).alias("__carried"))
    joined = rows.join(ends, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__range") == F.col("__of")))
    streak = F.col("streak") + F.when(F.col("__island") == 0, F.col("__carried")).otherwise(0)
    # the row before is in the same island, or is the first island's, if nothing was reset up to it
    carried_before = F.when(F.col("__island") - reset.cast("int") == 0, F.col("__carried")).otherwise(0)
    before = F.when(F.col("streak_before").isNull(), F.col("__carried")).otherwise(F.col("streak_before") + carried_before)
    return joined.withColumns({"streak": streak, "streak_before": before}).drop("__range", "__island", "__key", "__of", "__carried")


def backoff(attempts: DataFrame) -> DataFrame:
    """Rate-limited attempts with how many came since the last success, and the wait that follows."""
    limited = F.col("final_result") == "RATE_LIMITED"
    rows = _since_reset(attempts, "domain", limited, _success()).where(limited)
    return rows.withColumn("backoff_seconds", F.least(F.lit(BACKOFF_MOST), BACKOFF_BASE * F.pow(F.lit(2.0), F.least(F.col("streak") - 1, F.lit(62)))))


def failure_streaks(attempts: DataFrame, key: str = "domain", threshold: int = UNHEALTHY_AFTER) -> DataFrame:
    """Attempts with their consecutive failures and ``health``; a missing page is neutral."""
    failed = ~_success() & (F.col("final_result") != "NOT_FOUND")
    rows = _since_reset(attempts, key, failed, _success())
    return rows.withColumn("health", F.when(F.col("streak") >= threshold, "quarantined").when(F.col("streak") > 0, "unhealthy").otherwise("healthy"))


def recoveries(attempts: DataFrame, key: str = "domain") -> DataFrame:
    """Successes right after an unhealthy state: each recovery once."""
    return failure_streaks(attempts, key).where(_success() & (F.col("streak_before") > 0))


def announced(attempts: DataFrame, least: int = 2) -> DataFrame:
    """The attempt at which a URL's retries are announced: its first with so many, once."""
    late = attempts.where(F.col("retry_number") >= least)
    first = F.min(F.struct("retry_number", "occurred_at", "attempt_id")).alias("x")
    return late.groupBy("run_id", "url").agg(first).select("run_id", "url", F.col("x.retry_number").alias("retry_number"), F.col("x.attempt_id").alias("attempt_id"))


class ConcurrencyPolicy:
    """Concurrency per domain: halved by a rate limit, raised by one after so many successes."""

    def __init__(self, start: int = 8, least: int = 1, most: int = 8, restore: int = 5):
        if not 1 <= least <= start <= most or restore < 1:
            raise ValueError("need 1 <= least <= start <= most and a positive restore")
        self.start, self.least, self.most, self.restore = start, least, most, restore
        levels, streaks = np.divmod(np.arange(most * restore), restore)
        levels += 1
        halved = np.maximum(least, levels // 2)
        #: state after a rate limit and after a success; a state is (level - 1) * restore + streak
        self.limited = (halved - 1) * restore
        self.reduced = halved < levels
        grown = (streaks + 1 >= restore) & (levels < most)
        # at the highest level a longer streak makes no difference
        streak = np.where(grown, 0, np.minimum(streaks + 1, restore - 1))
        self.succeeded = (levels + grown - 1) * restore + streak
        self.restored = grown


def adaptive_concurrency(attempts: DataFrame, policy: ConcurrencyPolicy | None = None) -> DataFrame:
    """``domain, concurrency, reductions, restorations`` after all attempts of a domain.

    A state machine has few states, so a run of attempts is a map from states to states, and maps
    compose. The ledger is split into ranges of (domain, time); each task makes the map of its part
    of a domain, and only maps meet by domain: a hot domain is folded by many tasks.
    """
    policy = policy or ConcurrencyPolicy()
    size = policy.most * policy.restore
    rows = attempts.where(F.col("final_result").isin("SUCCESS", "RATE_LIMITED")).select("domain", "occurred_at", "attempt_id", (F.col("final_result") == "SUCCESS").alias("ok"))

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maps: dict[str, list[np.ndarray]] = {}
        place = 0
        for pdf in frames:
            for domain, ok in zip(pdf["domain"], pdf["ok"]):
                if domain not in maps:
                    maps[domain] = [np.arange(size), np.zeros(size, np.int64), np.zeros(size, np.int64), place]
                    place += 1
                at, down, up, _ = maps[domain]
                if ok:
                    up += policy.restored[at]
                    maps[domain][0] = policy.succeeded[at]
                else:
                    down += policy.reduced[at]
                    maps[domain][0] = policy.limited[at]
        yield pd.DataFrame({"domain": list(maps), **{n: [m[i].tolist() for m in maps.values()] for i, n in enumerate(("to", "down", "up"))}})

    ranged = rows.repartitionByRange("domain", "occurred_at", "attempt_id").sortWithinPartitions("domain", "occurred_at", "attempt_id")
    schema = "domain string, to array<long>, down array<long>, up array<long>"
    maps = materialize(ranged.mapInPandas(fold, schema).withColumn("part", F.spark_partition_id()), "state-maps")
    start = (policy.start - 1) * policy.restore + 0
    parts = F.array_sort(F.collect_list(F.struct("part", "to", "down", "up")))
    seed = F.struct(F.lit(start).cast("long").alias("at"), F.lit(0).cast("long").alias("down"), F.lit(0).cast("long").alias("up"))
    step = lambda s, m: F.struct(F.get(m["to"], s["at"]).alias("at"), (s["down"] + F.get(m["down"], s["at"])).alias("down"), (s["up"] + F.get(m["up"], s["at"])).alias("up"))
    out = maps.groupBy("domain").agg(parts.alias("parts")).select("domain", F.aggregate("parts", seed, step).alias("s"))
    return out.select("domain", (F.floor(F.col("s.at") / policy.restore) + 1).alias("concurrency"), F.col("s.down").alias("reductions"), F.col("s.up").alias("restorations"))


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("run_id", "decision_type").agg(F.count(F.lit(1)).alias("decisions"))


def page_outcome(fetched: Column, supported: Column, extracted_before: Column, extracted: Column) -> Column:
    """What became of a URL in the simple pipeline, the first that applies."""
    return (
        F.when(~fetched, "acquisition_failed")
        .when(~supported, "unsupported_content")
        .when(extracted_before, "duplicate_content")
        .when(~extracted, "extraction_failed")
        .otherwise("acquired")
    )


def crawl_counts(pages: DataFrame) -> DataFrame:
    """``run_id, discovered, acquired, rejected`` of a crawl's visits (run_id, url, acquired boolean): URLs,
    those with an artifact, and the difference."""
    by_url = pages.groupBy("run_id", "url").agg(F.bool_or("acquired").alias("acquired"))
    out = by_url.groupBy("run_id").agg(F.count(F.lit(1)).alias("discovered"), F.count_if("acquired").alias("acquired"))
    return out.withColumn("rejected", F.col("discovered") - F.col("acquired"))


def failures(attempts: DataFrame) -> DataFrame:
    """Attempts without success, by state and then by time."""
    return attempts.where(~_success()).orderBy("final_result", "occurred_at", "attempt_id")


def failure_counts(attempts: DataFrame) -> DataFrame:
    """``final_result, failures``, most frequent first."""
    return attempts.where(~_success()).groupBy("final_result").agg(F.count(F.lit(1)).alias("failures")).orderBy(F.desc("failures"), "final_result")


def sorted_by(rows: DataFrame, column: str, descending: bool = False, ties: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` by one column in either direction; nulls come last in both."""
    order = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    return rows.orderBy(order, *ties)


def append(rows: DataFrame, path: str) -> None:
    """Add rows to a ledger table; a table with other columns or types is refused."""
    try:
        existing = rows.sparkSession.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        if dict(existing.dtypes) != dict(rows.dtypes):
            raise ValueError(f"the table at {path} has {existing.dtypes}, not {rows.dtypes}")
    rows.write.mode("append").parquet(path)


def of_run(table: DataFrame, run_id, order: tuple[str, ...] = ("occurred_at", "attempt_id")) -> DataFrame:
    """The rows of one run, in order."""
    return table.where(F.col("run_id") == run_id).orderBy(*order)


def redirect_chains(hops: DataFrame) -> DataFrame:
    """``key, redirect_chain, final_url`` from hops (key, hop, url, status): an array of (url, status) in
    order of the hops, and the last URL."""
    gathered = hops.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("hop", "url", "status"))).alias("hops"))
    return gathered.select("key", F.transform("hops", lambda h: F.struct(h["url"].alias("url"), h["status"].alias("status"))).alias("redirect_chain"), F.element_at("hops", -1)["url"].alias("final_url"))


def redirect_hops(chains: DataFrame) -> DataFrame:
    """``key, hop, url, status``: the hops of chains again, counted from 0."""
    return chains.select("key", F.posexplode("redirect_chain").alias("hop", "x")).select("key", "hop", "x.url", "x.status")


def escalated(attempts: DataFrame, dynamic: Column, browser_result: Column) -> DataFrame:
    """The ledger with escalations: a successful HTTP attempt whose content is dynamic is recorded as
    PENDING_RETRY and followed by a browser attempt with the same retry number, whose result is
    ``browser_result``. ``step`` orders the two; the URL's last result is the browser's."""
    up = _success() & (F.col("acquisition_method") == "http") & F.coalesce(dynamic, F.lit(False))
    none = F.lit(None).cast("string")
    kept = F.struct(F.lit(0).alias("step"), F.col("acquisition_method").alias("method"), F.col("final_result").alias("result"), none.alias("why"), none.alias("decision"))
    http = F.struct(F.lit(0).alias("step"), F.lit("http").alias("method"), F.lit("PENDING_RETRY").alias("result"), F.lit("escalated_to_browser").alias("why"), F.lit("method_escalated").alias("decision"))
    browser = F.struct(F.lit(1).alias("step"), F.lit("browser").alias("method"), browser_result.alias("result"), none.alias("why"), none.alias("decision"))
    rows = attempts.withColumn("__x", F.explode(F.when(up, F.array(http, browser)).otherwise(F.array(kept))))
    changed = {"acquisition_method": F.col("__x.method"), "final_result": F.col("__x.result"), "failure_classification": F.col("__x.why"), "adaptive_decision": F.col("__x.decision"), "step": F.col("__x.step")}
    return rows.withColumns(changed).drop("__x")


def run_states(events: DataFrame) -> DataFrame:
    """``run_id, status, error_message`` after all events (run_id, event_id, event_type, status,
    error_message) in order: every failure sets the run to failed with its message, a completion
    (event_type "completion") sets its status and clears the message; without either it runs."""
    failed = F.col("status") == "failed"
    done = F.col("event_type") == "completion"
    state = F.when(done, F.struct(F.col("status").alias("status"), F.lit(None).cast("string").alias("error_message"))).when(failed, F.struct(F.lit("failed").alias("status"), F.col("error_message").alias("error_message")))
    last = F.max_by(state, F.when(state.isNotNull(), F.col("event_id"))).alias("x")
    return events.groupBy("run_id").agg(last).select("run_id", F.coalesce("x.status", F.lit("running")).alias("status"), F.col("x.error_message").alias("error_message"))
