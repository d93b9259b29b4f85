"""Threat-intelligence and directory enrichment of login sources."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.functions import net
from loginwatch.operators.sizing import broadcast_if_small
from loginwatch.operators.skew import split_join
from loginwatch.plans.session import stored

# A range row is about 100 bytes; 200,000 of them are broadcast, more are shuffled.
BROADCAST_RANGES = 200_000

_INTEL = ["cidr", "is_malicious", "confidence", "source", "tags"]
_INTEL_TYPE = "STRUCT<cidr STRING, is_malicious INT, confidence DOUBLE, source STRING, tags STRING>"


@dataclass(frozen=True)
class ThreatFeed:
    """A feed with the facts a plan needs: the mask widths that occur, and its size.

    ``ranges`` has one row per listed range with ``width`` and ``key``: coded mask width
    and network digits, or, in ``prefix`` mode, octet count and dotted prefix text.
    ``rejected`` has the rows of the feed that are no range: a width beyond 32 or 128
    bits, a malformed address, no prefix.
    """

    ranges: DataFrame
    rejected: DataFrame
    widths: tuple[int, ...]
    rows: int
    unique: bool
    mode: str
    broadcast_rows: int | None = None
    sweep: bool = False

    @classmethod
    def load(
        cls, ip_enrichment: DataFrame, mode: str = "network", broadcast_rows: int | None = None, sweep: bool = False
    ) -> ThreatFeed:
        """Index a feed. One small aggregate runs here, of a row per width: at most 162.

        ``sweep`` matches by disjoint segments, whatever the number of widths; for feeds
        with many of them that are too large to broadcast.
        """
        if sweep and mode != "network":
            raise ValueError("only ranges of addresses can be swept")
        if mode == "network":
            width, key = net.cidr_code("cidr"), net.cidr_base("cidr", "width")
        elif mode == "prefix":
            width, key = f"size({net.OCTETS.format(address='ip_prefix')}) - 1", "ip_prefix"
        else:
            raise ValueError(f"unknown match mode {mode!r}")
        listed = ip_enrichment.selectExpr(
            "*", f"{width} AS width", f"cast(struct({', '.join(_INTEL)}) AS {_INTEL_TYPE}) AS intel"
        ).selectExpr("*", f"{key} AS key")
        ranges = listed.where("key IS NOT NULL AND width IS NOT NULL").select("width", "key", "intel")
        rejected = listed.where("key IS NULL OR width IS NULL").select(*ip_enrichment.columns)
        facts = ranges.groupBy("width").agg(
            F.expr("count(1) AS n"), F.expr("count(DISTINCT key) AS keys")
        ).collect()
        return cls(
            ranges, rejected, tuple(sorted(r["width"] for r in facts)), sum(r["n"] for r in facts),
            all(r["n"] == r["keys"] for r in facts), mode, broadcast_rows, sweep,
        )

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= (BROADCAST_RANGES if self.broadcast_rows is None else self.broadcast_rows)

    def key_for(self, width: int) -> str:
        """Key of ``source_ip`` at a width, given its digits as ``ip_bits``."""
        if self.mode == "prefix":
            return net.leading_octets("source_ip", width)
        return net.network_of("ip_number", "ip_bits", width)

    @cached_property
    def segments(self) -> DataFrame:
        """The ranges flattened into segments that do not overlap, written once.

        A segment begins at ``key`` and ends where the next one begins; ``owners`` are the
        ranges that hold it, or NULL for none. It begins where a range begins or right after
        a range ends, so there are at most two for each range, and the owners of one are
        nested: at most 33 widths of them, or 129. Widths are looked up here, for
        the feed alone.
        """
        first, last = net.range_ends("key", "width")
        listed = stored(self.ranges.selectExpr("width", "key", "intel", f"{first} AS first", f"{last} AS last"), "feed_ranges")
        # ``~`` follows all digits: such a key lies between the last address and the next one.
        edges = listed.selectExpr("first AS edge", "first AS at").unionByName(
            listed.selectExpr("concat(last, '~') AS edge", "last AS at")
        ).distinct()
        probe = edges.selectExpr(
            "edge", "if(at LIKE '4%', cast(conv(substring(at, 2), 16, 10) AS bigint), NULL) AS ip_number",
            "if(at LIKE '6%', substring(at, 2), NULL) AS ip_bits",
        )
        keys = ", ".join(f"struct({w} AS width, {self.key_for(w)} AS key)" for w in self.widths)
        held = (
            probe.selectExpr("edge", f"inline(array({keys}))").join(listed, ["width", "key"])
            .where("edge <= last").groupBy("edge").agg(F.collect_list("intel").alias("owners"))
        )
        return stored(edges.select("edge").join(held, "edge", "left").withColumnRenamed("edge", "key"), "feed_segments")


def with_intel(rows: DataFrame, feed: ThreatFeed, outer: bool) -> DataFrame:
    """Add ``intel``, one output row per matching range; ``outer`` keeps misses once.

    A feed within the broadcast bound costs no shuffle: one hash lookup per mask width
    in the scan stage. A larger one is matched against the distinct addresses first.
    """
    if not feed.widths:
        unmatched = rows.selectExpr("*", f"cast(NULL AS {_INTEL_TYPE}) AS intel")
        return unmatched if outer else unmatched.where("false")
    if feed.sweep:
        return _swept_match(rows, feed, outer)
    match = _broadcast_match if feed.fits_broadcast else _address_match
    return match(rows, feed, outer)


def _with_bits(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "*", f"{net.ipv4_number('source_ip')} AS ip_number",
        f"if(instr(source_ip, ':') > 0, {net.ipv6_bits('source_ip')}, NULL) AS ip_bits",
    )


def _broadcast_match(rows: DataFrame, feed: ThreatFeed, outer: bool) -> DataFrame:
    columns = rows.columns
    rows = _with_bits(rows).selectExpr(*columns, *[f"{feed.key_for(w)} AS key_{w}" for w in feed.widths])
    for width in feed.widths:
        ranges = feed.ranges.where(f"width = {width}")
        if feed.unique:
            ranges = ranges.selectExpr(f"key AS key_{width}", f"array(intel) AS intel_{width}")
        else:
            ranges = ranges.groupBy(F.expr(f"key AS key_{width}")).agg(
                F.expr(f"collect_list(intel) AS intel_{width}")
            )
        rows = rows.join(F.broadcast(ranges), f"key_{width}", "left")
    every = f"flatten(array_compact(array({', '.join(f'intel_{w}' for w in feed.widths)})))"
    return rows.selectExpr(*columns, f"{'explode_outer' if outer else 'explode'}({every}) AS intel")


def _address_match(rows: DataFrame, feed: ThreatFeed, outer: bool) -> DataFrame:
    keys = ", ".join(f"struct({w} AS width, {feed.key_for(w)} AS key)" for w in feed.widths)
    known = rows.where("source_ip IS NOT NULL")
    addresses = known.select("source_ip").distinct()
    matched = (
        _with_bits(addresses).selectExpr("source_ip", f"inline(array({keys}))")
        .join(feed.ranges, ["width", "key"]).select("source_ip", "intel")
    )
    found = known.join(matched, "source_ip", "left" if outer else "inner").select(*rows.columns, "intel")
    if not outer:
        return found
    # Unknown sources stay out of the shuffle, where they would meet in one task.
    unknown = rows.where("source_ip IS NULL").selectExpr("*", f"cast(NULL AS {_INTEL_TYPE}) AS intel")
    return found.unionByName(unknown)


def swept(addresses: DataFrame, segments: DataFrame) -> DataFrame:
    """``source_ip`` and ``owners`` of the addresses that lie in a segment with owners.

    Addresses and beginnings of segments are range-partitioned together and sorted; every
    address takes the last beginning before it. What reaches over from one partition to the
    next is the last beginning of each, one row per partition. An address is one row, however
    many widths the feed has.
    """
    spark = addresses.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _with_bits(addresses.select("source_ip")).selectExpr("source_ip", f"{net.order_key('ip_number', 'ip_bits')} AS key")
    both = segments.selectExpr("key", "0 AS kind", "struct(owners) AS held", "cast(NULL AS string) AS source_ip").unionByName(
        keyed.where("key IS NOT NULL").selectExpr("key", "1 AS kind", "cast(NULL AS struct<owners: array<" + _INTEL_TYPE + ">>) AS held", "source_ip")
    )
    dealt = stored(both.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "swept_ranges")
    # One row per partition: the beginning that is in force at its end.
    ends = dealt.where("kind = 0").groupBy("part").agg(F.expr("max_by(held, key) AS held")).orderBy("part").collect()
    carried, open_now, last = [], None, {r["part"]: r["held"] for r in ends}
    for part in range(max(last, default=-1) + 1):
        carried.append((part, open_now))
        open_now = last.get(part, open_now)
    # Partitions after the last one that holds a beginning.
    carried += [(part, open_now) for part in range(len(carried), parts)]
    before = F.broadcast(spark.createDataFrame(carried, f"part int, before struct<owners: array<{_INTEL_TYPE}>>"))
    held = "last(held, true) OVER (PARTITION BY part ORDER BY key, kind ROWS UNBOUNDED PRECEDING)"
    return dealt.selectExpr("part", "kind", "source_ip", f"{held} AS held").where("kind = 1").join(before, "part").selectExpr(
        "source_ip", "coalesce(held, before).owners AS owners"
    ).where("owners IS NOT NULL")


def _swept_match(rows: DataFrame, feed: ThreatFeed, outer: bool) -> DataFrame:
    known = rows.where("source_ip IS NOT NULL") if not outer else rows
    found = stored(swept(rows.where("source_ip IS NOT NULL").select("source_ip").distinct(), feed.segments), "swept_sources")
    matched = split_join(known, found, ["source_ip"], "left" if outer else "inner")
    return matched.selectExpr(*rows.columns, f"{'explode_outer' if outer else 'explode'}(owners) AS intel")


def ip_enrichment(events: DataFrame, feed: ThreatFeed) -> DataFrame:
    """Events whose source lies in a listed range, once per matching range."""
    rows = with_intel(events.select("event_id", "source_ip"), feed, outer=False)
    return rows.select("event_id", "source_ip", "intel.*")


def classify_source(events: DataFrame, feed: ThreatFeed) -> DataFrame:
    """Every event with INTERNAL, the feed's tags, or an external-unknown label."""
    columns = ["event_id", "username", "login_date", "source_ip", "country"]
    return with_intel(events.select(*columns), feed, outer=True).selectExpr(
        *columns,
        """CASE WHEN startswith(source_ip, '10.') THEN 'INTERNAL' WHEN intel.tags IS NOT NULL THEN intel.tags
                ELSE 'EXTERNAL (no intel match)' END AS ip_classification""",
        "intel.source AS intel_source", "intel.confidence AS confidence",
    )


def account_status(events: DataFrame, employees: DataFrame) -> DataFrame:
    """Events with the directory status the terminated-account rule needs.

    Works on a streaming ``events`` too: a stream-static join without state.
    """
    status = employees.selectExpr("employee_id AS username", "status AS account_status")
    return events.join(broadcast_if_small(status), "username", "left")
