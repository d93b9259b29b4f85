"""Joins in which one key may hold a third of the rows.

A shuffle join sends all rows of a key to one task. ``split_join`` counts the keys first:
hot ones are so few that their side of the join is broadcast, and their rows stay where
they are; only the rest is shuffled. ``dealt_join`` is for a side of few rows per key
that is worth copying: rows are dealt by a hash, and the side is copied to every hand.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task may see before the key counts as hot.
HOT_ROWS = 4_000_000
#: Hands that rows of one key are dealt to.
HANDS = 64


class HotKeys(NamedTuple):
    """Keys with more than ``rows`` rows; ``listed`` is None if there are none.

    By counting there are at most (all rows / ``rows``) of them: 250,000 for 10^12 rows,
    which is what bounds the list and every broadcast made with it.
    """

    listed: DataFrame | None
    rows: int

    @classmethod
    def of(cls, frame: DataFrame, keys: Sequence[str], rows: int | None = None) -> HotKeys:
        """Counts the keys of ``frame``: one aggregate that combines map-side. NULL is no key."""
        rows = HOT_ROWS if rows is None else rows
        known = frame.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys)
        found = known.agg(F.count(F.lit(1)).alias("n")).where(f"n > {rows}").select(*keys)
        listed = found.collect()
        return cls(frame.sparkSession.createDataFrame(listed, found.schema) if listed else None, rows)

    def within(self, frame: DataFrame, keys: Sequence[str]) -> HotKeys:
        """Hot values of more ``keys``, which only hot values of the fewer can have."""
        if self.listed is None:
            return self
        few = self.listed.columns
        return HotKeys.of(frame.join(F.broadcast(self.listed), few, "left_semi"), keys, self.rows)


def split_join(
    rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", hot: HotKeys | None = None
) -> DataFrame:
    """``rows.join(side, keys, how)`` in which no task gathers a hot key of ``rows``.

    ``side`` has one row per key; ``how`` is ``inner``, ``left`` or ``left_semi``. What ``side``
    has for hot keys is broadcast, bounded as :class:`HotKeys` says. Without hot keys (known
    from ``hot``, or counted here) this is the plain join. Rows with a NULL key match
    nothing and are never shuffled.
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"no split join {how!r}")
    listed = (HotKeys.of(rows, keys) if hot is None else hot).listed
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    rest, shuffled = rows.where(known), side.where(known)
    done = []
    if listed is not None:
        listed = F.broadcast(listed.select(*keys))
        few = F.broadcast(shuffled.join(listed, keys, "left_semi"))
        busy = rest.join(listed, keys, "left_semi") if how == "left" else rest
        done.append(busy.join(few, keys, how))
        rest = rest.join(listed, keys, "left_anti")
    done.append(rest.join(shuffled, keys, how))
    if how == "left":
        done.append(rows.where(f"NOT ({known})"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def dealt_join(rows: DataFrame, side: DataFrame, on: str, by: str, how: str = "inner", hands: int = HANDS) -> DataFrame:
    """``rows.join(side, on, how)`` with the rows of each key dealt by a hash of column ``by``.

    ``side`` is copied ``hands`` times, so it should be much smaller than ``rows``; ``how`` is
    ``inner`` or ``left_semi``. ``on`` may be any condition with equalities, null-safe ones too.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"no dealt join {how!r}")
    dealt = rows.withColumn("_hand", F.expr(f"pmod(xxhash64({by}), {hands}L)"))
    copied = side.withColumn("_side_hand", F.expr(f"explode(sequence(0L, {hands - 1}L))"))
    return dealt.join(copied, F.expr(f"({on}) AND _hand = _side_hand"), how).drop("_hand", "_side_hand")
