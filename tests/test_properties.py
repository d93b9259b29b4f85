"""Rewrites against direct definitions on random small inputs full of ties."""

import ipaddress
import random
from datetime import timedelta

import pytest
from conftest import at, config, day

from loginwatch.operators import brute_force, correlate, impossible_travel
from loginwatch.operators.enrich import ThreatFeed, ip_enrichment, with_intel
from loginwatch.operators.normalize import failures
from loginwatch.schemas import IP_ENRICHMENT


def random_rows(seed, n=160, users=4, span=400):
    rnd = random.Random(seed)
    base = day(0, "00:00:00")
    return [
        (i, f"u{rnd.randrange(users)}", at(base, rnd.randrange(-60, span)), rnd.choice(["US", "DE", "CA"]),
         int(rnd.random() < 0.3), f"10.0.0.{rnd.randrange(3)}")
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_failure_runs_match_the_definition(tables, seed):
    cfg = config(bf_min_failures=2, bf_window_minutes=1)
    rows = random_rows(seed)
    start = day(0, "00:00:00")
    seconds = {r[0]: r for r in rows}
    want = {}
    for i, u, t, _, s, _ in rows:
        if not s or t < start:
            continue
        prior = [
            f for f in rows if f[1] == u and not f[4] and f[2] <= t and at(f[2], 60) >= t
            and not any(m[1] == u and m[4] and f[2] < m[2] < t for m in rows)
        ]
        if len(prior) >= 2:
            want[i] = (len(prior), min(f[2] for f in prior))
    frame = brute_force.detect_brute_force(tables.events(rows), tables.employees([]), cfg)
    got = {r["event_id"]: (r["failure_count"], r["first_failure"]) for r in frame.collect()}
    assert got == want and seconds


@pytest.mark.parametrize("hot_rows", [0, 30, 10**6])
def test_previous_success_across_chunks(tables, hot_rows):
    rows = random_rows(7)
    want, last = {}, {}
    for i, u, t, _, s, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        if s:
            want[i] = last.get(u)
            last[u] = i
    frame = impossible_travel.travel_transitions(tables.events(rows), hot_rows)
    assert {r["event_id"]: r["prev_event_id"] for r in frame.collect()} == want


@pytest.mark.parametrize("seed", [4, 5])
def test_rolling_counts_match_the_definition(tables, seed):
    rows = random_rows(seed, n=120)
    span = timedelta(seconds=45)
    lost = [r for r in rows if not r[4]]
    events, values = {}, {}
    for _, u, t, _, _, ip in lost:
        near = [f for f in lost if f[2] <= t <= at(f[2], 45)]
        events[(u, t)] = sum(f[1] == u for f in near)
        values[(ip, t)] = len({f[1] for f in near if f[5] == ip})
    stamp = "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS at"
    base = failures(tables.events(rows))
    counts = correlate.correlate_event_count(base, timespan=span, gte=3).selectExpr("username", stamp, "event_count")
    assert {(r[0], r[1]): r[2] for r in counts.collect()} == {k: v for k, v in events.items() if v >= 3}
    distinct = correlate.correlate_value_count(base, timespan=span, gte=2).selectExpr("source_ip", stamp, "value_count")
    assert {(r[0], r[1]): r[2] for r in distinct.collect()} == {k: v for k, v in values.items() if v >= 2}


def test_burst_edges(tables):
    rows = [(i, "ann", at(day(1), s), "US", 0, "1.1.1.1") for i, s in enumerate([0, 3600, 7201])]
    got = correlate.correlate_event_count(failures(tables.events(rows)), gte=2).collect()
    assert [(r["event_count"]) for r in got] == [2]      # exactly one hour counts, one second more does not
    bursts = correlate.merge_alerts(
        correlate.correlate_event_count(failures(tables.events(rows)), gte=1), "username", "event_count"
    ).collect()
    assert [(r["instants"], r["event_count"]) for r in bursts] == [(2, 2), (1, 1)]


RANGES = [
    ("10.1.1.", "10.1.1.0/24", 1, 0.5, "a", "x"), ("10.1.", "10.1.0.0/16", 0, 0.4, "b", "y"),
    ("172.16.", "172.16.16.0/20", 1, 0.9, "c", "z"), ("9.9.9.", "9.9.9.9/32", 1, 0.1, "d", "w"),
]
ADDRESSES = [
    "10.1.1.7", "10.1.10.7", "10.10.1.7", "172.16.16.1", "172.16.31.255", "172.16.32.0", "9.9.9.9", "9.9.9.8",
    "2001:db8::1", "10.1.1", "10.1.1.256", "", None,
]


@pytest.mark.parametrize("limit, sweep", [(10**6, False), (0, False), (0, True)])
@pytest.mark.parametrize("duplicate", [False, True])
def test_masked_join_matches_address_arithmetic(tables, monkeypatch, limit, sweep, duplicate):
    monkeypatch.setattr("loginwatch.operators.enrich.BROADCAST_RANGES", limit)
    ranges = RANGES + ([("10.1.1.", "10.1.1.0/24", 0, 0.2, "e", "v")] if duplicate else [])
    feed = ThreatFeed.load(tables.table(ranges, IP_ENRICHMENT), sweep=sweep)
    events = tables.events([(i, "u", day(1), "US", 1, ip) for i, ip in enumerate(ADDRESSES)])

    def inside(ip, cidr):
        try:
            return ipaddress.IPv4Address(ip) in ipaddress.ip_network(cidr)
        except ValueError:
            return False

    want = sorted((i, r[4]) for i, ip in enumerate(ADDRESSES) for r in ranges if ip and inside(ip, r[1]))
    got = sorted((r["event_id"], r["source"]) for r in ip_enrichment(events, feed).collect())
    assert got == want
    outer = with_intel(events.select("event_id", "source_ip"), feed, outer=True)
    missed = len(ADDRESSES) - len({i for i, _ in want})
    assert outer.count() == len(want) + missed


def test_prefix_mode_and_empty_feed(tables):
    events = tables.events([(i, "u", day(1), "US", 1, ip) for i, ip in enumerate(ADDRESSES)])
    prefix = ThreatFeed.load(tables.table(RANGES[:2], IP_ENRICHMENT), "prefix")
    got = sorted((r["event_id"], r["cidr"]) for r in ip_enrichment(events, prefix).collect())
    assert got == [(0, "10.1.0.0/16"), (0, "10.1.1.0/24"), (1, "10.1.0.0/16"), (9, "10.1.0.0/16"),
                   (10, "10.1.0.0/16"), (10, "10.1.1.0/24")]
    empty = ThreatFeed.load(tables.table([], IP_ENRICHMENT))
    assert ip_enrichment(events, empty).count() == 0
    assert with_intel(events, empty, outer=True).count() == len(ADDRESSES)


def test_history_merges_and_replaces_the_old_days(tables):
    from loginwatch.operators import after_hours, baselines, unfamiliar_country
    from loginwatch.operators.history import account_history, merge_history
    from loginwatch.operators.normalize import since_day
    from loginwatch.schemas import COUNTRY_DISTANCE, TRAVEL_EXCEPTIONS

    cfg = config(hour_baseline_min_samples=3, baseline_end="2024-05-09")   # a day between the two
    rnd = random.Random(11)
    rows = [
        (i, f"u{rnd.randrange(6)}", day(rnd.randrange(-4, 3), f"{rnd.randrange(24):02d}:00:0{rnd.randrange(3)}"),
         rnd.choice(["US", "DE", "CA", "RU"]), int(rnd.random() < 0.6), "1.1.1.1") for i in range(90)
    ]
    rows = [r for r in rows if not (r[1] == "u5" and r[2] < day(0, "00:00:00"))]
    events, staff = tables.events(rows), tables.employees([(f"u{i}", "Sales", "Active") for i in range(6)])
    cut = "login_date < date'2024-05-08'"
    parts = [account_history(events.where(c), cfg) for c in (cut, f"NOT {cut}")]
    history = merge_history(*parts)
    as_set = lambda frame: sorted(map(str, frame.collect()))
    assert as_set(history.orderBy("username")) == as_set(account_history(events, cfg).orderBy("username"))
    window = since_day(events, cfg.detection_start)
    km = tables.table([("DE", "US", 7800), ("CA", "US", 1900), ("CA", "RU", 6650)], COUNTRY_DISTANCE)
    excused = tables.table([], TRAVEL_EXCEPTIONS)
    assert as_set(baselines.hour_windows(events, staff, cfg)) == as_set(
        baselines.account_windows(window, staff, cfg, history).select(
            "username", "baseline_source", "window_start", "window_end"))
    pairs = [
        (unfamiliar_country.detect_unfamiliar_country(events, staff, cfg),
         unfamiliar_country.detect_unfamiliar_country(window, staff, cfg, history)),
        (after_hours.detect_after_hours(events, staff, cfg),
         after_hours.detect_after_hours(window, staff, cfg, history)),
        (impossible_travel.detect_impossible_travel(events, staff, km, excused, cfg),
         impossible_travel.detect_impossible_travel(window, staff, km, excused, cfg, history=history)),
    ]
    for whole, from_history in pairs:
        assert as_set(whole) == as_set(from_history) and whole.count() > 0


def test_addresses_of_both_families_match_ranges_like_whole_numbers(tables):
    from loginwatch.functions import net

    rnd = random.Random(3)
    six = [ipaddress.IPv6Address(rnd.choice([0, 1, 0x20010DB8 << 96]) + rnd.choice([rnd.getrandbits(k) for k in (1, 16, 64, 127)]) % (1 << 127)) for _ in range(60)]
    texts = [t for a in six for t in (a.compressed, a.exploded, a.compressed.upper())]
    texts += ["::", "::1", "1::", "::ffff:1.2.3.4", "64:ff9b::10.0.0.1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4"]
    texts += ["1.2.3.4", "255.255.255.255", "0.0.0.0", "10.2.15.255", "10.2.16.0"]
    bad = ["", ":", ":::", "1:2:3", "1::2::3", "12345::", "g::", "1.2.3", "1.2.3.256", "::1.2.3", "1:2:3:4:5:6:7:8:9",
           "1::2:3:4:5:6:7:8:9", "fe80::1%eth0", "1.2.3.4.5", "a.b.c.d"]
    frame = tables.table([(t,) for t in texts + bad], "a STRING").selectExpr("a", f"{net.address_bits('a')} AS bits")
    got = {r["a"]: r["bits"] for r in frame.collect()}
    for t in texts:
        assert got[t] == ipaddress.ip_address(t.lower()).packed.hex(), t
    assert not [t for t in bad if got[t] is not None]
    ranges = [(None, f"{a.compressed}/{w}", 1, 0.5, f"s{i}", "t") for i, (a, w) in enumerate(zip(six, [0, 3, 32, 47, 64, 65, 66, 67, 113, 128] * 6))]
    ranges += [(None, "10.2.0.0/20", 1, 0.5, "v4", "t"), (None, "0.0.0.0/0", 1, 0.5, "all4", "t")]
    wrong = [(None, c, 1, 0.5, "bad", "t") for c in ("1.2.3.0/40", "1.2.3.0/-1", "::/129", "1.2.3.4", "x/8", "1.2.3.0/8/8", "1.2.3.0/", None)]
    feed = ThreatFeed.load(tables.table(ranges + wrong, IP_ENRICHMENT))
    swept = ThreatFeed.load(tables.table(ranges + wrong, IP_ENRICHMENT), sweep=True)
    events = tables.events([(i, "u", day(1), "US", 1, t) for i, t in enumerate(texts + bad)])
    found = sorted((r["event_id"], r["source"]) for r in ip_enrichment(events, feed).collect())
    assert found == sorted((r["event_id"], r["source"]) for r in ip_enrichment(events, swept).collect())
    want = sorted(
        (i, r[4]) for i, t in enumerate(texts) for r in ranges
        if ipaddress.ip_address(t.lower()) in ipaddress.ip_network(r[1], strict=False)
    )
    assert found == want and len(want) > 100
    assert feed.rejected.count() == len(wrong)


def test_many_nested_ranges_are_swept(spark, tables, capsys):
    """200,000 nested ranges: each address is one row, and none is multiplied by widths."""
    rnd = random.Random(9)
    nets = {ipaddress.ip_network((rnd.getrandbits(32) & (2**32 - 1) << 32 - w & 2**32 - 1, w)) for w in (8, 12, 16, 20, 24, 27, 32) for _ in range(35_000)}
    nets = sorted(nets, key=lambda n: (n.prefixlen, n))[:200_000]
    listed = {(int(n.network_address), n.prefixlen) for n in nets}
    frame = spark.createDataFrame([(None, str(n), 1, 0.5, str(n), "t") for n in nets], "ip_prefix string, cidr string, is_malicious int, confidence double, source string, tags string")
    assert frame.count() > 150_000
    feed = ThreatFeed.load(frame, sweep=True)
    inside = [int(n.network_address) + rnd.randrange(n.num_addresses) for n in rnd.sample(nets, 300)]
    edges = [int(x) + d for n in rnd.sample(nets, 200) for x in (n.network_address, n.broadcast_address) for d in (-1, 0, 1)]
    addresses = [x for x in inside + edges if 0 <= x < 2**32]
    events = tables.events([(i, "u", day(1), "US", 1, str(ipaddress.IPv4Address(x))) for i, x in enumerate(addresses)])
    matched = ip_enrichment(events, feed)
    want = sorted(
        (i, str(ipaddress.ip_network((x >> 32 - w << 32 - w, w)))) for i, x in enumerate(addresses) for w in range(33)
        if (x >> 32 - w << 32 - w, w) in listed
    )
    assert sorted((r["event_id"], r["source"]) for r in matched.collect()) == want and len(want) > 600
    capsys.readouterr()
    matched.explain("formatted")
    plan = capsys.readouterr().out
    # The only Generate left is the one that lists the owners of an address.
    assert "inline(" not in plan and plan.split("== Initial Plan ==")[-1].count("Generate (") == 1
