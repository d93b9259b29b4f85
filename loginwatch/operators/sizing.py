"""Size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a name, a label or two and a status: below 100 MB.
BROADCAST_ACCOUNTS = 500_000


def broadcast_if_small(side: DataFrame, max_rows: int = BROADCAST_ACCOUNTS) -> DataFrame:
    """Broadcast ``side`` if it has at most ``max_rows`` rows, else leave the join to the planner.

    A count of partial counts: no rows are moved for it. Used where the other side is the
    whole log, which a shuffle join would move for the sake of a few accounts.
    """
    return F.broadcast(side) if side.count() <= max_rows else side
