"""Each rule on hand-written edge cases."""

from conftest import at, by, config, day, ids

from loginwatch.operators import after_hours, baselines, brute_force, impossible_travel
from loginwatch.operators import inactive_account, password_spray, unfamiliar_country
from loginwatch.schemas import COUNTRY_DISTANCE, TRAVEL_EXCEPTIONS


def test_unfamiliar_country(tables, cfg):
    events = tables.events([
        (1, "ann", day(-3), "US", 1, "10.0.0.1"),
        (2, "ann", day(-2), "FR", 0, "10.0.0.1"),      # a failure teaches nothing
        (3, "ann", day(1), "FR", 1, "10.0.0.1"),       # new, MEDIUM
        (4, "ann", day(1, "11:00:00"), "KP", 1, None),  # new, HIGH
        (5, "ann", day(2), "US", 1, "10.0.0.1"),       # known
        (6, "ann", day(2), "RU", 0, "10.0.0.1"),       # failures never fire
        (7, "ben", day(1), "US", 1, "10.0.0.2"),       # no baseline: first success
        (8, "ben", day(2), "DE", 1, "10.0.0.2"),       # second success does not fire
        (9, "cat", day(1), "DE", 1, "10.0.0.3"),       # two first successes at one instant
        (10, "cat", day(1), "US", 1, "10.0.0.4"),
        (11, "dan", day(-1), "US", 0, "10.0.0.5"),     # failed before, so still no baseline
        (12, "dan", day(0, "00:00:00"), "CN", 1, "10.0.0.5"),
    ])
    staff = tables.employees([("ann", "Sales", "Active")])
    got = by(unfamiliar_country.detect_unfamiliar_country(events, staff, cfg), "event_id")
    assert sorted(got) == [3, 4, 7, 9, 10, 12]
    assert got[3]["severity"] == "MEDIUM" and got[4]["severity"] == "HIGH"
    assert got[3]["baseline_countries"] == "US" and got[3]["baseline_state"] == "baseline"
    assert got[3]["user_name"] == "Firstann Lastann" and got[7]["user_name"] is None
    assert got[7]["baseline_state"] == "no_baseline" and got[7]["baseline_countries"] is None
    assert got[3]["reason"] == "Unfamiliar login location: FR not in baseline [US]"
    assert got[12]["severity"] == "HIGH"


def travel(tables, rows, cfg, **kw):
    km = tables.table([("CA", "US", 1900), ("DE", "US", 7800), ("CN", "US", 9000)], COUNTRY_DISTANCE)
    excused = tables.table([("CA", "US", "corridor")], TRAVEL_EXCEPTIONS)
    return by(
        impossible_travel.detect_impossible_travel(tables.events(rows), tables.employees([]), km, excused, cfg, **kw),
        "event_id",
    )


TRAVEL_ROWS = [
    (1, "ann", day(-1, "23:00:00"), "DE", 1, "1.1.1.1"),
    (2, "ann", day(0, "03:15:00"), "US", 1, "1.1.1.2"),   # 4.25 h after a pre-window login
    (3, "ann", day(0, "23:00:00"), "DE", 1, "1.1.1.3"),   # 19.75 h: under the gate
    (4, "ben", day(1, "00:00:00"), "US", 1, "2.1.1.1"),
    (5, "ben", day(1, "10:00:00"), "CN", 1, "2.1.1.2"),   # exactly 900 km/h: not over
    (6, "cat", day(1, "10:00:00"), "US", 1, "3.1.1.1"),
    (7, "cat", day(1, "10:00:00"), "DE", 1, "3.1.1.2"),   # same instant
    (8, "cat", day(1, "10:30:00"), "BR", 1, "3.1.1.3"),   # unknown pair drops
    (9, "dan", day(1, "10:00:00"), "US", 1, "4.1.1.1"),
    (10, "dan", day(1, "10:30:00"), "CA", 1, "4.1.1.2"),  # excepted pair: MEDIUM
    (11, "eve", day(-2, "10:00:00"), "US", 1, "5.1.1.1"),
    (12, "eve", day(-2, "10:30:00"), "DE", 1, "5.1.1.2"),  # arrival before the window
    (13, "fay", day(1, "10:00:00"), "US", 1, "6.1.1.1"),
    (14, "fay", day(1, "10:10:00"), "DE", 0, "6.1.1.2"),  # failures are no arrival
]


def test_impossible_travel(tables, cfg):
    got = travel(tables, TRAVEL_ROWS, cfg)
    assert sorted(got) == [2, 7, 10]
    assert got[2]["prev_event_id"] == 1 and got[2]["hours_apart"] == 4.3 and got[2]["required_kmh"] == 1835
    assert got[2]["severity"] == "HIGH" and got[10]["severity"] == "MEDIUM"
    assert got[7]["hours_apart"] == 0.0 and got[7]["required_kmh"] == 468000
    assert got[2]["reason"] == "Impossible travel: DE -> US in 4.3h requires ~1835 km/h (gate: 900 km/h)"
    assert got[10]["reason"].endswith(" [exception: corridor]")


def test_impossible_travel_is_the_same_when_every_account_is_hot(tables, cfg):
    assert travel(tables, TRAVEL_ROWS, cfg, hot_rows=0) == travel(tables, TRAVEL_ROWS, cfg)


def test_hour_windows_and_after_hours(tables):
    cfg = config(hour_baseline_min_samples=2)
    events = tables.events([
        (1, "ann", day(-3, "09:10:00"), "US", 1, "10.0.0.1"),
        (2, "ann", day(-2, "17:10:00"), "US", 1, "10.0.0.1"),
        (3, "ben", day(-2, "12:00:00"), "US", 1, "10.0.0.2"),       # thin: department tier
        (4, "svc_job", day(-2, "02:00:00"), "US", 1, "10.0.0.3"),   # kept out of the department
        (5, "svc_job", day(-1, "02:00:00"), "US", 1, "10.0.0.3"),
        (6, "ann", day(1, "07:00:00"), "US", 1, "10.0.0.1"),        # on the lower bound
        (7, "ann", day(1, "19:59:59"), "US", 1, "10.0.0.1"),        # on the upper bound
        (8, "ann", day(1, "20:00:00"), "US", 1, "10.0.0.1"),        # outside
        (9, "ben", day(1, "06:30:00"), "US", 1, "10.0.0.2"),        # outside department hours
        (10, "cat", day(1, "05:59:00"), "US", 1, "10.0.0.4"),       # outside the default
        (11, "cat", day(1, "20:30:00"), "US", 1, "10.0.0.4"),       # inside the default
        (12, "svc_job", day(1, "23:00:00"), "US", 1, "10.0.0.3"),   # service accounts are exempt
        (13, "SVC_Job", day(1, "23:00:00"), "US", 1, "10.0.0.3"),
        (14, "ghost", day(1, "03:00:00"), "US", 1, "10.0.0.9"),     # not in the directory
        (15, "ann", day(1, "23:00:00"), "US", 0, "10.0.0.1"),       # a failure
    ])
    staff = tables.employees([
        ("ann", "IT Security", "Active"), ("ben", "IT Security", "Active"), ("cat", "Legal", "Active"),
        ("svc_job", "IT Security", "Active"), ("SVC_Job", "IT Security", "Active"),
    ])
    windows = by(baselines.hour_windows(events, staff, cfg), "username")
    assert windows["ann"] == {"username": "ann", "baseline_source": "user", "window_start": 7, "window_end": 19}
    assert windows["ben"]["baseline_source"] == "department" and windows["ben"]["window_start"] == 7
    assert windows["cat"] == {
        "username": "cat", "baseline_source": "global-default", "window_start": 6, "window_end": 20
    }
    got = by(after_hours.detect_after_hours(events, staff, cfg), "event_id")
    assert sorted(got) == [8, 9, 10]
    assert got[8]["severity"] == "LOW" and got[10]["severity"] == "MEDIUM"
    assert got[8]["reason"] == "Login at 20:00:00 UTC outside user hour window [7:00-19:59]"


def test_brute_force(tables):
    cfg = config(bf_min_failures=3, bf_window_minutes=60)
    base = day(1, "10:00:00")
    rows = []

    def add(user, offset, success, ip="9.9.9.9"):
        rows.append((len(rows) + 1, user, at(base, offset), "US", success, ip))
        return len(rows)

    for s in (0, 60, 3660 - 60):          # the first failure is exactly 60 minutes old: counts
        add("ann", s, 0)
    hit_edge = add("ann", 3600, 1)
    for s in (0, 60, 120):                # one second too old: two left
        add("ben", s, 0)
    add("ben", 3601, 1)
    for s in (0, 60):                     # a success in between resets
        add("cat", s, 0)
    add("cat", 90, 1)
    add("cat", 100, 0)
    add("cat", 200, 1)
    for s in (0, 10):                     # a failure in the same second as a success counts
        add("dan", s, 0)                  # for it and for the next one
    hit_tie = add("dan", 20, 1)
    add("dan", 20, 0)
    for s in (30, 40):
        add("dan", s, 0, "8.8.8.8")       # another source counts too
    hit_next = add("dan", 50, 1)
    for s in (-20, -10, -5):              # failures before the window count
        rows.append((len(rows) + 1, "eve", at(day(0, "00:00:00"), s), "US", 0, "7.7.7.7"))
    rows.append((len(rows) + 1, "eve", day(0, "00:00:00"), "US", 1, "7.7.7.7"))
    hit_window = len(rows)
    for s in (0, 1, 2):                   # two successes in one second share the run
        add("fay", s, 0)
    twins = [add("fay", 9, 1), add("fay", 9, 1)]
    got = by(brute_force.detect_brute_force(tables.events(rows), tables.employees([]), cfg), "event_id")
    assert sorted(got) == sorted([hit_edge, hit_tie, hit_next, hit_window, *twins])
    assert got[hit_edge]["failure_count"] == 3 and got[hit_edge]["first_failure"] == base
    assert got[hit_tie]["failure_count"] == 3 and got[hit_next]["failure_count"] == 3
    assert got[hit_edge]["reason"] == (
        "Brute force: 3 uninterrupted failures within 60 min preceding success from 9.9.9.9"
    )


def test_bruteforce_failed(tables):
    cfg = config(bf_failed_min_failures=2)
    rows = [
        (1, "ann", day(1, "10:00:00"), "US", 0, "1.1.1.1"),
        (2, "ann", day(1, "10:00:09"), "US", 0, "1.1.1.1"),
        (3, "ann", day(1, "11:00:00"), "US", 1, "2.2.2.2"),   # success elsewhere does not excuse
        (4, "ben", day(1), "US", 0, "1.1.1.1"),
        (5, "ben", day(1), "US", 0, "1.1.1.1"),
        (6, "ben", day(1, "23:00:00"), "US", 1, "1.1.1.1"),   # success from there does
        (7, "cat", day(1), "US", 0, "1.1.1.1"),               # below the threshold
        (8, "dan", day(1), "US", 0, None),
        (9, "dan", day(1), "US", 0, None),
        (10, "dan", day(1), "US", 1, None),                   # an unknown source excuses nothing
        (11, "eve", day(-1), "US", 0, "1.1.1.1"),
        (12, "eve", day(-1), "US", 0, "1.1.1.1"),             # before the window
    ]
    frame = brute_force.detect_bruteforce_failed(tables.events(rows), tables.employees([]), cfg)
    got = by(frame, "username")
    assert sorted(got) == ["ann", "dan"]
    assert got["ann"]["campaign_key"] == f"ann|1.1.1.1|{day(1)[:10]}"
    assert (got["ann"]["first_attempt"], got["ann"]["last_attempt"]) == ("10:00:00", "10:00:09")
    assert got["dan"]["campaign_key"] is None and got["dan"]["failure_count"] == 2


def test_password_spray(tables):
    cfg = config(spray_min_accounts=3)
    rows = [(i, f"u{i}", day(1, f"10:00:0{i}"), "US", 0, "1.1.1.1") for i in range(3)]
    rows += [(10, "boss", day(1, "09:00:00"), "US", 1, "1.1.1.1")]             # success only: named, not targeted
    rows += [(20 + i, f"u{i}", day(2), "US", 0, "1.1.1.1") for i in range(3)]  # the next day is a campaign of its own
    rows += [(30 + i, f"u{i}", day(1), "US", 0, "2.2.2.2") for i in range(2)]  # one account short
    rows += [(40 + i, "u0", day(1), "US", 0, "3.3.3.3") for i in range(9)]     # depth is not breadth
    got = by(password_spray.detect_password_spray(tables.events(rows), cfg), "campaign_key")
    first, second = f"1.1.1.1|{day(1)[:10]}", f"1.1.1.1|{day(2)[:10]}"
    assert sorted(got) == [first, second]
    assert got[first]["usernames"] == "boss,u0,u1,u2" and got[first]["accounts_targeted"] == 3
    assert got[first]["severity"] == "HIGH" and got[second]["severity"] == "MEDIUM"
    assert got[first]["first_attempt"] == "09:00:00" and got[first]["successes"] == 1
    assert got[first]["reason"].endswith(" - INCLUDES 1 SUCCESS(ES)")
    accounts = password_spray.spray_accounts(tables.events(rows), cfg)
    assert accounts.count() == 7


def test_inactive_account_and_rule_form(tables):
    from loginwatch.operators.enrich import account_status

    events = tables.events([
        (1, "gone", day(-9), "US", 0, "1.1.1.1"), (2, "gone", day(1), "US", 1, "1.1.1.1"),
        (3, "leave", day(1), "US", 1, "1.1.1.1"), (4, "odd", day(1), "US", 1, "1.1.1.1"),
        (5, "ok", day(1), "US", 1, "1.1.1.1"), (6, "ghost", day(1), "US", 1, "1.1.1.1"),
    ])
    staff = tables.employees([
        ("gone", "Sales", "Terminated"), ("leave", "Sales", "On Leave"), ("odd", "Sales", None),
        ("ok", "Sales", "Active"),
    ])
    got = by(inactive_account.detect_inactive_account(events, staff), "event_id")
    assert sorted(got) == [1, 2, 3]
    assert got[1]["outcome"] == "FAILED" and got[1]["reason"] == "Login attempt on Terminated account from US"
    assert got[2]["reason"] == "CRITICAL: Successful login on Terminated account from US"
    assert ids(inactive_account.select_terminated(account_status(events, staff))) == [1, 2]
