"""Ordered per-account work that survives one account owning a third of the log.

Three devices are used instead of a plain window over an account's whole history:

* *points*: events folded to one row per account and second. The fold combines
  map-side, and afterwards an account can have at most one row per second of the
  observed range however many events it had, so a window over it is bounded.
* *chunks*: where event identity matters, accounts above ``HOT_ROWS`` rows are cut
  into one chunk per second, others are a single chunk. A window runs inside chunks;
  only chunk edges go through a second window that carries values across chunks.
* *sweeps*: a trailing-window total is a running sum of arrivals and expiries, which
  is linear, where a sliding frame would revisit every row of the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one account a single sort may see before the account is cut up.
HOT_ROWS = 4_000_000


def hot_accounts(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Accounts with more than ``hot_rows`` rows: at most rows / hot_rows of them."""
    counts = rows.groupBy("username").agg(F.expr("count(1) AS n"))
    return counts.where(f"n > {hot_rows}").selectExpr("username", "true AS is_hot")


def with_chunk(rows: DataFrame, hot_rows: int = HOT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Add ``chunk``: NULL for ordinary accounts, the second of the event for hot ones.

    ``counted`` may name the rows that decide, where ``rows`` adds only a few to them.
    The hot list is broadcast; by counting it holds at most rows / hot_rows names
    (250,000 for 10^12 rows), and a name is all a row carries.
    """
    hot = F.broadcast(hot_accounts(rows if counted is None else counted, hot_rows))
    # Attempts without an account are one account here, and may be many: NULL matches NULL.
    return rows.join(hot.withColumnRenamed("username", "hot_name"), F.expr("username <=> hot_name"), "left").selectExpr(
        *rows.columns, "if(is_hot, unix_seconds(ts), NULL) AS chunk"
    )


def with_previous(
    rows: DataFrame,
    fields: Sequence[str],
    keep: str | None = None,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``prev``, a struct of ``fields`` from the account's preceding row.

    Order is ``(ts, event_id)``. ``keep`` is a condition that may use ``prev``; rows that
    fail it inside a chunk are dropped before the second exchange.
    """
    columns, carried = rows.columns, f"lag(struct({', '.join(fields)}))"
    inside = "OVER (PARTITION BY username, chunk ORDER BY ts, event_id)"
    local = with_chunk(rows, hot_rows, counted).selectExpr(
        "*", f"{carried} {inside} AS prev", f"lead(event_id) {inside} IS NULL AS is_last"
    )
    if keep is not None:
        local = local.where(f"prev IS NULL OR is_last OR ({keep})")
    # What stands before a chunk's first row is the last row of the chunk before: an edge.
    # Only edges of hot accounts are moved again, at most two per second of one account; the
    # conditions are such that both branches read the same shuffled rows.
    edges = local.where("CASE WHEN prev IS NULL OR is_last THEN chunk IS NOT NULL ELSE false END").selectExpr(
        *columns, "prev", f"{carried} OVER (PARTITION BY username ORDER BY ts, event_id) AS carried"
    )
    inner = local.where("CASE WHEN prev IS NULL THEN chunk IS NULL ELSE true END").select(*columns, "prev")
    out = inner.unionByName(edges.where("prev IS NULL").selectExpr(*columns, "carried AS prev"))
    return out.where(keep) if keep is not None else out


def account_points(events: DataFrame) -> DataFrame:
    """One row per account and second: ``failures``, ``wins`` and the instant in micros."""
    points = events.groupBy("username", "ts").agg(
        F.expr("count_if(success = 0) AS failures"), F.expr("count_if(success = 1) AS wins")
    )
    return points.selectExpr("*", "unix_micros(ts) AS at")


def trailing_total(rows: DataFrame, key: str, value: str, span_micros: int) -> DataFrame:
    """Per key and instant ``at``: the sum of ``value`` over ``[at - span, at]``.

    Each row arrives at its instant and expires one microsecond after its span, so
    exactly ``span`` ago still counts.
    """
    moves = rows.selectExpr(
        key,
        f"""inline(array(
            struct(unix_micros(ts) AS t, {value} AS delta, true AS arrives),
            struct(unix_micros(ts) + {span_micros + 1}L AS t, -({value}) AS delta, false AS arrives)))""",
    )
    return running_total(moves, key)


# The span of one sort of a key: a day, at two rows per second.
BLOCK_MICROS = 86_400_000_000


def running_total(moves: DataFrame, key: str, block_micros: int = BLOCK_MICROS) -> DataFrame:
    """Running sum of ``delta`` by ``t`` per key, reported at arrivals.

    Moves are netted per key and instant first, which combines map-side and leaves at most
    two rows per key and second. They are summed in order within blocks of time; what the
    blocks before add is a scan over one total per key and block. So no task sorts more of
    a key than a block, however long the log.
    """
    netted = moves.groupBy(key, "t").agg(
        F.expr("sum(delta) AS delta"), F.expr("max(arrives) AS arrives")
    ).selectExpr("*", f"cast(floor(t / {block_micros}D) AS bigint) AS block")
    totals = netted.groupBy(key, "block").agg(F.expr("sum(delta) AS total"))
    before = f"sum(total) OVER (PARTITION BY {key} ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = totals.selectExpr(f"{key} AS block_key", "block AS block_no", f"coalesce({before}, 0) AS before")
    inside = f"sum(delta) OVER (PARTITION BY {key}, block ORDER BY t ROWS UNBOUNDED PRECEDING)"
    local = netted.selectExpr(key, "block", "t AS at", f"{inside} AS local", "arrives").where("arrives")
    return local.join(offsets, F.expr(f"{key} <=> block_key AND block = block_no")).selectExpr(
        key, "at", "local + before AS trailing"
    )


def merge_instants(instants: DataFrame, key: str, gap_micros: int, measure: str) -> DataFrame:
    """Fold instants at most ``gap`` apart into spans: first, last, count, peak measure."""
    order = f"OVER (PARTITION BY {key} ORDER BY at"
    opens = f"if(at - lag(at) {order}) <= {gap_micros}L, 0, 1)"
    spans = instants.selectExpr("*", f"{opens} AS opens").selectExpr(
        "*", f"sum(opens) {order} ROWS UNBOUNDED PRECEDING) AS span_no"
    )
    return spans.groupBy(key, "span_no").agg(
        F.expr("min(at) AS first_at"), F.expr("max(at) AS last_at"), F.expr("count(1) AS instants"),
        F.expr(f"max({measure}) AS peak"),
    ).drop("span_no")
