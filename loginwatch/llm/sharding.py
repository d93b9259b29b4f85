"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.llm.common import numbered

ROUNDS = 6
WORD = (1 << 64) - 1


def _mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply); every output bit depends on every input bit."""
    x = values.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A bijection of 0 .. size - 1, computable in both directions for any single number.

    A balanced Feistel network permutes the least even power of two that holds ``size``
    (less than 4 * ``size``); a result beyond ``size`` is put through again until it falls
    inside, which keeps the map one to one.
    """

    def __init__(self, size: int, seed: int):
        self.size = size
        self.half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.keys = _mix(np.array([(seed * ROUNDS + r + 1) & WORD for r in range(ROUNDS)], dtype=np.uint64))

    def _network(self, values: np.ndarray, keys: np.ndarray, swap: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = values >> half, values & mask
        if swap:
            left, right = right, left
        for key in keys:
            left, right = right, left ^ (_mix(right ^ key) & mask)
        if swap:
            left, right = right, left
        return (left << half) | right

    def _walk(self, values, keys: np.ndarray, swap: bool) -> np.ndarray:
        out = self._network(np.asarray(values).astype(np.uint64), keys, swap)
        while (beyond := out >= np.uint64(self.size)).any():
            out[beyond] = self._network(out[beyond], keys, swap)
        return out.astype(np.int64)

    def forward(self, rows) -> np.ndarray:
        return self._walk(rows, self.keys, False)

    def inverse(self, places) -> np.ndarray:
        return self._walk(places, self.keys[::-1], True)


def locate(row: int, size: int, n_shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of one row number, without any table."""
    place = int(Permutation(size, seed).forward([row])[0])
    return place % n_shards, place // n_shards


def row_at(shard: int, slot: int, size: int, n_shards: int, seed: int) -> int:
    """The row number that sits in a slot: the inverse of ``locate``."""
    return int(Permutation(size, seed).inverse([slot * n_shards + shard])[0])


def shard(frame: DataFrame, keys: list[str], n_shards: int, seed: int = 0) -> DataFrame:
    """``frame`` (narrow) with ``row``, ``shard`` and ``slot``.

    Rows are numbered in the order of ``keys`` (nulls first), the numbers permuted, and
    place p goes to shard p mod ``n_shards``, slot p div ``n_shards``: shard sizes differ
    by one at most and slots have no gaps. The result depends on the key values, their
    number and the seed alone; rows equal in all keys are interchangeable. An empty
    frame gives an empty result. Columns named ``row``, ``shard`` or ``slot`` are replaced.
    """
    rows = numbered(frame.drop("row", "shard", "slot"), keys, "sharding")
    size = rows.count()
    permutation = Permutation(size, seed)

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward(numbers.to_numpy()))

    return (
        rows.withColumn("_place", place("row"))
        .withColumn("shard", F.expr(f"cast(_place % {n_shards} as int)"))
        .withColumn("slot", F.expr(f"_place div {n_shards}"))
        .drop("_place")
    )


def document_shards(documents: DataFrame, n_shards: int = 16, seed: int = 20240601) -> DataFrame:
    """Every document with its shard; the law that holds is ``rows``.

    A null text has size 1 and the checksum of the empty text. Repeated and null ids are
    ordered by size and checksum. Only three numbers per row are shuffled, never the text.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = documents.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
    )
    return shard(narrow, ["doc_id", "size", "text_crc32"], n_shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row",
    )
