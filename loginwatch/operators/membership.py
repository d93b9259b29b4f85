"""A bit table of accounts that thins a log before the exact join.

Where many accounts are flagged, their list is too large to broadcast and a semi join
shuffles the whole log for it. A bit table is far smaller: each account sets four bits of
one 64-bit word. It is broadcast, rows that it excludes are dropped where they are read,
and only what is left goes through the exact join, which removes the few let through.
"""

from __future__ import annotations

from math import exp
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.operators.skew import HotKeys, split_join
from loginwatch.plans.session import stored

#: Words of the largest table, and with that the rows of its broadcast (16 bytes each).
MAX_WORDS = 1 << 22
#: Keys per word that the size aims at.
KEYS_PER_WORD = 2
#: A table that would let more of the others pass is not worth its lookups.
MAX_SHARE = 0.25
BITS = 4


def passing_share(keys: int, words: int) -> float:
    """The share of other keys that pass, on average over hashes.

    A word gets a Poisson number of keys; ``filled`` holds the chance of each number of set
    bits after so many. All bits asked for must be among them.
    """
    load = keys / words
    if load > 64:
        return 1.0
    filled, chance, share = [1.0] + [0.0] * 64, exp(-load), 0.0
    for n in range(1, 200):
        for _ in range(BITS):
            filled = [f * s / 64 + (filled[s - 1] * (65 - s) / 64 if s else 0.0) for s, f in enumerate(filled)]
        chance *= load / n
        share += chance * sum(f * (s / 64) ** BITS for s, f in enumerate(filled))
    return share


def _word(key: str, words: int) -> str:
    return f"shiftrightunsigned(xxhash64({key}), 32) & {words - 1}L"


def _mask(key: str) -> str:
    bits = [f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({key}), {6 * i}) & 63L AS int))" for i in range(BITS)]
    return " | ".join(bits)


class Membership(NamedTuple):
    """Keys, exactly in ``keys`` (one row each) and roughly in ``bits``.

    ``bits`` is None where it would not pay; ``share`` is the part of other keys that pass.
    """

    keys: DataFrame
    bits: DataFrame | None
    words: int
    share: float

    @classmethod
    def of(cls, frame: DataFrame, key: str, max_words: int = MAX_WORDS) -> Membership:
        """The distinct values of ``key``; NULL is none. Both tables are written once, and the
        bit table, folded map-side, has at most ``max_words`` rows."""
        keys = stored(frame.where(f"{key} IS NOT NULL").select(key).distinct(), "members")
        n, words = keys.count(), 64
        while words < max_words and words * KEYS_PER_WORD < n:
            words *= 2
        share = passing_share(n, words)
        if share > MAX_SHARE:
            return cls(keys, None, words, 1.0)
        bits = keys.groupBy(F.expr(f"{_word(key, words)} AS _member_word")).agg(F.expr(f"bit_or({_mask(key)}) AS _member_bits"))
        return cls(keys, stored(bits, "member_bits"), words, share)

    @property
    def key(self) -> str:
        return self.keys.columns[0]

    def thin(self, rows: DataFrame) -> DataFrame:
        """``rows`` less most of those of other keys. One lookup per row, no shuffle; rows of
        the keys all stay, those with a NULL key go."""
        if self.bits is None:
            return rows
        known = rows.where(f"{self.key} IS NOT NULL")
        bits = F.broadcast(self.bits)
        mask = f"({_mask(self.key)})"
        return known.join(bits, F.expr(f"({_word(self.key, self.words)}) = _member_word AND (_member_bits & {mask}) = {mask}"), "left_semi")

    def only(self, rows: DataFrame, hot: HotKeys | None = None) -> DataFrame:
        """Exactly the ``rows`` of the keys: thinned, then joined; hot keys are not shuffled."""
        return split_join(self.thin(rows), self.keys, [self.key], "left_semi", hot)
