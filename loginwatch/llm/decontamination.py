"""Benchmark passages in documents, by Wu-Manber search over words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW = 13
#: Words of a block, the unit of the shift tables.
BLOCK = 2
#: Bytes of benchmark text whose tables are broadcast together; more text, more tables.
TABLE_BYTES = 8 << 20

_LETTERS = bytes(range(97, 123))
_KEPT = bytes(range(48, 58)) + _LETTERS + bytes(range(128, 256))
#: Lower case for A-Z, a space for what is in no word.
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + bytes(b for b in range(128) if b not in _KEPT and not 65 <= b <= 90),
    _LETTERS + b" " * (128 - 10 - 26 - 26),
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


class Patterns:
    """Shift tables and buckets for the windows of some items, one set per length.

    ``shift``: how far the search may move on when it sees a block that ends ``shift``
    words before the end of some window at the latest; an unknown block moves it past
    itself. At a block that ends a window the shift is 0, and the bucket of that block
    holds the windows to compare, kept apart by their first block.
    """

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW):
        by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, words in items:
            m = min(window, len(words))
            for i in range(len(words) - m + 1) if m else ():
                by_length[m][tuple(words[i: i + m])].add(item)
        self.tables = []
        for m, windows in by_length.items():
            size = min(BLOCK, m)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
            for text, owners in windows.items():
                for end in range(size, m + 1):
                    block = text[end - size: end]
                    shift[block] = min(shift.get(block, m), m - end)
                buckets[text[-size:]][text[:size]].append((list(text), list(owners)))
            self.tables.append((m, size, shift, {k: dict(v) for k, v in buckets.items()}))

    def find(self, words: list[bytes]) -> Iterator[tuple[int | None, int, int]]:
        """(item, first word, end) of each occurrence."""
        n = len(words)
        for m, size, shift, buckets in self.tables:
            far, end = m - size + 1, m
            while end <= n:
                block = tuple(words[end - size: end])
                step = shift.get(block, far)
                if step:
                    end += step
                    continue
                start = end - m
                for text, owners in buckets[block].get(tuple(words[start: start + size]), ()):
                    if words[start:end] == text:
                        for item in owners:
                            yield item, start, end
                end += 1

    def spans(self, words: list[bytes]) -> list[tuple[int | None, int, int]]:
        """Occurrences of an item that overlap or touch, as one span."""
        found: dict[int | None, list[list[int]]] = {}
        for item, start, end in sorted(self.find(words), key=lambda x: x[1:]):
            own = found.setdefault(item, [])
            if own and start <= own[-1][1]:
                own[-1][1] = max(own[-1][1], end)
            else:
                own.append([start, end])
        return [(item, a, b) for item, own in found.items() for a, b in own]


def _tables(spark: SparkSession, benchmark: DataFrame, limit: int) -> list:
    """Broadcast tables of at most ``limit`` bytes of text (or one item) each."""
    out, items, size = [], [], 0
    for item, text in benchmark.select("item_id", "text").toLocalIterator():
        items.append((item, words_of(text)))
        size += len(text or "")
        if size >= limit:
            out.append(spark.sparkContext.broadcast(Patterns(items)))
            items, size = [], 0
    return [*out, spark.sparkContext.broadcast(Patterns(items))]


def contamination(documents: DataFrame, benchmark: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``documents`` with ``n_words``, ``spans`` (item, start, end in words), ``n_hit``,
    ``items`` and ``contaminated``.

    The benchmark is the query set: it is cut into tables of a bounded size, each of
    which is searched in every document; what they find is united per document. Documents
    are not shuffled. A null text has no words and is clean; items without a word or with
    a null text have no window; occurrences of items with a null id are hits but are not
    listed. Clashing columns are replaced.
    """
    added = ("n_words", "spans", "n_hit", "items", "contaminated")
    other = [c for c in documents.columns if c not in added]

    def search(patterns):
        @F.pandas_udf("n_words long, spans array<struct<item: long, start: int, end: int>>")
        def run(texts: pd.Series) -> pd.DataFrame:
            counts, spans = [], []
            for text in texts:
                words = words_of(text)
                counts.append(len(words))
                spans.append([{"item": i, "start": a, "end": b} for i, a, b in patterns.value.spans(words)])
            return pd.DataFrame({"n_words": counts, "spans": pd.Series(spans, dtype=object)})
        return run("text")

    tables = _tables(documents.sparkSession, benchmark, table_bytes)
    searched = documents.select(*other, *[search(t).alias(f"_found{k}") for k, t in enumerate(tables)])
    spans = searched.select(
        *other, F.col("_found0.n_words").alias("n_words"),
        F.array_sort(F.concat(*[F.col(f"_found{k}.spans") for k in range(len(tables))])).alias("spans"),
    )
    covered = """
        aggregate(
            array_sort(transform(spans, s -> struct(s.start as start, s.end as end))),
            struct(0L as hit, 0 as upto),
            (acc, s) -> struct(
                acc.hit + greatest(0, s.end - greatest(s.start, acc.upto)) as hit,
                greatest(acc.upto, s.end) as upto),
            acc -> acc.hit)
    """
    items = "array_sort(array_distinct(transform(filter(spans, s -> s.item is not null), s -> cast(s.item as string))))"
    return (
        spans.withColumn("n_hit", F.expr(covered)).withColumn("items", F.expr(items))
        .withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
    )


def contamination_report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The result of the query: counts and a digest of the items found, per document."""
    return contamination(documents.select("doc_id", "text"), benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are clean, with their own columns, whatever their names."""
    rows = documents.select(F.struct("*").alias("_row"), "text")
    return contamination(rows, benchmark).where("NOT contaminated").select("_row.*")
