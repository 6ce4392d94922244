"""Session and proxy pools, rebuilt from recorded attempts.

Both are state machines of a few numbers over attempts in order of time. A pool's attempts are one
sorted run of rows, which a task folds as a stream, holding the pool's state only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POOL_SIZE = 4
UNHEALTHY_AFTER = 3
NEUTRAL = "NOT_FOUND"


class SessionPool:
    """Sessions of one domain: minted up to the pool's size, then taken by turns; one that has failed
    so often in a row is retired, the turn starts anew, and the next request mints another."""

    def __init__(self, size: int = POOL_SIZE, threshold: int = UNHEALTHY_AFTER):
        self.size, self.threshold = size, threshold
        self.minted, self.cursor = 0, 0
        self.pool: list[list[int]] = []  # session, failures in a row

    def use(self, result: str) -> tuple[int, str]:
        """The session of the next attempt, and its health after that attempt's result."""
        if len(self.pool) < self.size:
            session = [self.minted, 0]
            self.minted += 1
            self.pool.append(session)
        else:
            session = self.pool[self.cursor % len(self.pool)]
            self.cursor = (self.cursor + 1) % len(self.pool)
        if result == "SUCCESS":
            session[1] = 0
        elif result != NEUTRAL:
            session[1] += 1
            if session[1] >= self.threshold:
                self.pool.remove(session)
                self.cursor = 0
                return session[0], "retired"
        return session[0], "healthy"


class ProxyPool:
    """Proxies of a run by turns, without those in quarantine; none if all are."""

    def __init__(self, proxies: int, threshold: int = UNHEALTHY_AFTER):
        self.threshold, self.next = threshold, 0
        self.failures = [0] * proxies

    def use(self, result: str) -> tuple[int | None, str | None]:
        """The proxy of the next attempt, and its health after that attempt's result."""
        for _ in self.failures:
            at = self.next
            self.next = (self.next + 1) % len(self.failures)
            if self.failures[at] < self.threshold:
                if result == "SUCCESS":
                    self.failures[at] = 0
                elif result != NEUTRAL:
                    self.failures[at] += 1
                n = self.failures[at]
                return at, "healthy" if n == 0 else "quarantined" if n >= self.threshold else "unhealthy"
        return None, None


def _folded(attempts: DataFrame, key: str, pool: Callable, number: str, health: str) -> DataFrame:
    schema = f"{key} string, attempt_id long, {number} long, {health} string"

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, current = None, None
        for pdf in frames:
            rows = []
            for k, attempt, result in zip(pdf[key], pdf["attempt_id"], pdf["final_result"]):
                if held is None or k != current:
                    held, current = pool(), k
                rows.append((k, attempt, *held.use(result)))
            out = pd.DataFrame(rows, columns=[key, "attempt_id", number, health])
            yield out.astype({number: "Int64"})

    rows = attempts.select(F.col(key).cast("string").alias(key), "occurred_at", F.col("attempt_id").cast("long").alias("attempt_id"), "final_result")
    ordered = rows.repartition(key).sortWithinPartitions(key, "occurred_at", "attempt_id")
    return ordered.select(key, "attempt_id", "final_result").mapInPandas(fold, schema)


def session_assignments(attempts: DataFrame, size: int = POOL_SIZE, threshold: int = UNHEALTHY_AFTER) -> DataFrame:
    """``domain, attempt_id, session, session_health``: sessions are numbered from 0 in each domain. A
    missing page is neutral."""
    return _folded(attempts, "domain", lambda: SessionPool(size, threshold), "session", "session_health")


def proxy_assignments(attempts: DataFrame, proxies: int, threshold: int = UNHEALTHY_AFTER) -> DataFrame:
    """``run_id, attempt_id, proxy, proxy_health``; a null proxy is a direct connection."""
    return _folded(attempts, "run_id", lambda: ProxyPool(proxies, threshold), "proxy", "proxy_health")
