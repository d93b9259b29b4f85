"""The log laid out by account, so that rules about accounts need no shuffle.

Rows of an account are in one bucket, sorted by time: windows and aggregates over accounts
run where they are read. Accounts too busy for one bucket are kept apart and go the way of
the plain log, which cuts them up.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loginwatch.operators.normalize import login_events
from loginwatch.operators.skew import HotKeys


class AccountLog(NamedTuple):
    """``settled``: bucketed by account; ``busy``: accounts above the limit, and NULL."""

    settled: DataFrame
    busy: DataFrame

    def per_account(self, rule: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``rule`` over the whole log; it must look at one account at a time."""
        return rule(self.settled).unionByName(rule(self.busy))


def write_account_log(attempts: DataFrame, name: str, path: str, buckets: int = 512, hot_rows: int | None = None) -> None:
    """Writes tables ``<name>_settled`` and ``<name>_busy`` below ``path``, replacing old ones.

    One shuffle, by account; each task writes one sorted file. Busy accounts have more rows
    than ``hot_rows`` (by default the limit of :class:`HotKeys`); they and attempts without
    an account are laid out by a hash of the event id. Choose ``buckets`` so that one holds
    some hundred megabytes.
    """
    hot = HotKeys.of(attempts, ["username"], hot_rows).listed
    known = attempts.where("username IS NOT NULL")
    busy = attempts.where("username IS NULL")
    if hot is not None:
        # At most rows / hot_rows names.
        busy = busy.unionByName(known.join(F.broadcast(hot), ["username"], "left_semi"))
        known = known.join(F.broadcast(hot), ["username"], "left_anti")
    columns = attempts.columns
    known.select(*columns).repartition(buckets, "username").write.mode("overwrite").option("path", f"{path}/settled").bucketBy(
        buckets, "username"
    ).sortBy("username", "login_date", "login_time", "event_id").saveAsTable(f"{name}_settled")
    spread = F.expr(f"pmod(xxhash64(event_id), {buckets})")
    busy.select(*columns).repartition(spread).write.mode("overwrite").option("path", f"{path}/busy").saveAsTable(f"{name}_busy")


def read_account_log(spark: SparkSession, name: str) -> AccountLog:
    """The log as events: ready for every rule that takes them."""
    return AccountLog(*[login_events(spark.table(f"{name}_{part}")) for part in ("settled", "busy")])
