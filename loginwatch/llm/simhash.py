"""Near copies by SimHash, found through the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loginwatch.llm.common import split_join, stored
from loginwatch.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
#: The perfect binary code of length 23: 12 free bits, covering radius 3.
LENGTH, RADIUS = 23, 3
#: Its generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a fixed value.
GENERATOR = 0b101011100011
#: Two blocks of the code and 18 bits that every anchor leaves open.
BLOCKS = (0, LENGTH)
#: Members of an anchor up to which they are compared directly.
CROWD = 256


def fingerprint(text: str | None) -> int:
    """Majority bits of the XXH64 of every word shingle, repeats included; 0 if no word."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(data[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    values = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
    return pd.Series(values.view(np.int64))


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` (signed 64 bits) of every document; text is not shuffled."""
    return documents.select("doc_id", _fingerprints("text").alias("fp"))


@cache
def _cosets() -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """Syndrome of each single bit, and for each syndrome the error patterns by extra weight.

    Patterns of extra weight e lead from a word to the codewords that become its nearest
    one after e bit changes at best: weight up to ``RADIUS`` for 0, one more for each bit.
    """
    def syndrome(x: int) -> int:
        for bit in range(LENGTH - 1, 10, -1):
            if x >> bit & 1:
                x ^= GENERATOR << (bit - 11)
        return x

    single = np.array([syndrome(1 << b) for b in range(LENGTH)], np.int64)
    by: list[list[list[int]]] = [[[] for _ in range(DISTANCE + 1)] for _ in range(1 << 11)]

    def grow(pattern: int, synd: int, start: int, weight: int) -> None:
        by[synd][max(0, weight - RADIUS)].append(pattern)
        if weight < RADIUS + DISTANCE:
            for b in range(start, LENGTH):
                grow(pattern | 1 << b, synd ^ int(single[b]), b + 1, weight + 1)

    grow(0, 0, 0, 0)
    return single, [[np.array(p, np.uint64) for p in row] for row in by]


def _block(words: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits of a block and their syndromes."""
    single, _ = _cosets()
    bits = (words >> np.uint64(at)) & np.uint64((1 << LENGTH) - 1)
    synd = np.zeros(len(bits), np.int64)
    for b in range(LENGTH):
        synd ^= np.where((bits >> np.uint64(b)) & np.uint64(1), single[b], 0)
    return bits, synd


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each fingerprint at its nearest anchor (``home``) and at all it may share with others."""
    _, cosets = _cosets()
    for frame in batches:
        words = frame["fp"].to_numpy().view(np.uint64)
        (low, low_s), (high, high_s) = (_block(words, at) for at in BLOCKS)
        anchors, owners, homes = [], [], []
        for i in range(len(words)):
            found = [
                ((low[i] ^ one)[:, None] | ((high[i] ^ two) << np.uint64(LENGTH))[None, :]).ravel()
                for extra, one in enumerate(cosets[low_s[i]])
                for two in cosets[high_s[i]][: DISTANCE + 1 - extra]
            ]
            reach = np.concatenate(found)
            home = np.zeros(len(reach), bool)
            home[0] = True  # the nearest codewords, of no extra weight, come first
            anchors.append(reach)
            owners.append(np.full(len(reach), words[i]))
            homes.append(home)
        if anchors:
            yield pd.DataFrame({
                "anchor": np.concatenate(anchors).view(np.int64),
                "fp": np.concatenate(owners).view(np.int64), "home": np.concatenate(homes),
            })


def links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fp``) that connect
    exactly those within ``DISTANCE`` of each other, directly or over further links.

    The anchors are the words of a covering code: two blocks of the perfect code of
    length 23, the other bits open. Every fingerprint lies within the radius of its home
    anchor, and whatever differs from it in two bits lies within the radius plus two of
    that anchor. So each fingerprint is replicated to all anchors within the radius plus
    two (62 on average, counted block by block) and compared with those at home there.

    Where many near copies crowd an anchor, comparing all would be quadratic. Their
    fingerprints go to the anchors of the finest code instead, in which every word is an
    anchor: two fingerprints differ in two bits or fewer exactly when some word lies
    within one bit of both, so each is replicated to its 65 words, and the at most 65
    fingerprints of a word are linked to the least of them. No pair is lost either way.
    """
    # Each row grows by two orders: many tasks, however few files hold the fingerprints.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.select("fp").repartition(parts, "fp")
    placed = stored(spread.mapInPandas(_anchors, "anchor long, fp long, home boolean"), "anchors")
    sizes = placed.groupBy("anchor").agg(F.count(F.lit(1)).alias("members"), F.max("home").alias("lived"))
    used = placed.join(sizes.where("lived AND members > 1"), "anchor")
    home, reach = used.where(f"home AND members <= {CROWD}"), used.where(f"members <= {CROWD}")
    near = (
        home.select("anchor", F.col("fp").alias("a"))
        .join(reach.select("anchor", F.col("fp").alias("b")), "anchor")
        .where(f"a <> b AND bit_count(a ^ b) <= {DISTANCE}")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    crowded = used.where(f"members > {CROWD}").select("fp").distinct()
    words = crowded.select("fp", F.explode(F.expr(
        "concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))"
    )).alias("word"))
    stars = words.groupBy("word").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all"))
    spokes = stars.where("size(all) > 1").select("a", F.explode("all").alias("b")).where("a <> b")
    return near.unionByName(spokes).distinct()


def near_copies(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every document.

    Exact copies share a fingerprint, so only distinct fingerprints are placed, compared
    and connected; a fingerprint's class is then joined back, hot ones by broadcast.
    Texts without a word (null, empty) have fingerprint 0. ``component_id`` is the
    smallest id reachable; null ids count for nothing and a class of only null ids has a
    null one. Repeated rows are kept.
    """
    return with_classes(stored(fingerprints(documents), "fingerprints"))


def with_classes(prints: DataFrame) -> DataFrame:
    """``component_id`` for rows with ``doc_id`` and ``fp`` (a stored table)."""
    distinct = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")),
        "distinct_fingerprints",
    )
    member = components(stored(links(distinct), "fingerprint_links")).withColumnRenamed("node", "fp")
    rooted = stored(
        distinct.join(member, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        .withColumnRenamed("n", "copies"),
        "fingerprint_roots",
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    classes = split_join(rooted, least, "root", rooted.count()).select(
        "fp", "component_id", F.col("copies").alias("n")
    )
    return split_join(prints, stored(classes, "fingerprint_classes"), "fp", prints.count()).drop("n")


def near_copy_classes(documents: DataFrame) -> DataFrame:
    """The result of the query: the fingerprint as 16 hex digits, and the class."""
    return near_copies(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def first_of_each(documents: DataFrame) -> DataFrame:
    """One document of each class, with its own columns: the one whose id names the class.

    A class of only null ids keeps the least text by hash. Of repeated rows with one id
    and text, one stays. Only keys of kept rows are joined to the texts, which are
    shuffled once and not sorted.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.xxhash64("text").alias("hash"))
    keyed = documents.select(F.struct("*").alias("_row"), key.alias("_key"))
    prints = stored(documents.select("doc_id", _fingerprints("text").alias("fp"), key.alias("_key")), "fingerprints")
    classes = with_classes(prints)
    # The class of a fingerprint is named by its least id; classes without ids, by themselves.
    best = classes.groupBy("component_id", F.expr("if(component_id is null, fp, null)").alias("lone")).agg(
        F.min("_key").alias("_key")
    )
    rows = prints.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    keep = stored(best.select("_key").distinct().join(rows, "_key"), "kept_keys")
    kept = keyed.alias("d").join(
        keep.select("_key").alias("k").hint("shuffle_hash"),
        (F.col("d._key.hash") == F.col("k._key.hash")) & F.col("d._key.doc_id").eqNullSafe(F.col("k._key.doc_id")),
        "left_semi",
    )
    # Texts are shuffled a second time only if a kept row is repeated.
    if not keep.where("n > 1").isEmpty():
        kept = kept.dropDuplicates(["_key"])
    return kept.select("_row.*")
