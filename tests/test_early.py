"""Alerts told before the watermark: raised, revised, confirmed, and in the end the same."""

from __future__ import annotations

import os

from conftest import at, day

from loginwatch import schemas
from loginwatch.operators import correlate
from loginwatch.operators.normalize import failures, login_events
from loginwatch.streaming.early import confirmed, early_event_count

NOON = day(1, "12:00:00")


class Inbox:
    """A folder to which attempts come in, one file per call of ``add``."""

    def __init__(self, tables, home):
        self.tables, self.folder, self.home, self.count, self.ids = tables, home / "in", str(home / "home"), 0, 0

    def add(self, *stamps, user="u"):
        rows = [(self.ids + i, user, at(NOON, s), "US", 0, "1.1.1.1") for i, s in enumerate(stamps)]
        self.ids += len(rows)
        self.tables.attempts(rows).coalesce(1).write.mode("append").parquet(str(self.folder))
        # Files are taken in the order of their times.
        for path in self.folder.glob("*.parquet"):
            if path.stat().st_mtime > 1e6:
                os.utime(path, (1000 + self.count, 1000 + self.count))
        self.count += 1

    def run(self, spark, gte=3, **more):
        log = spark.readStream.schema(schemas.LOG_IN_ATTEMPTS).option("maxFilesPerTrigger", 1).parquet(str(self.folder))
        return early_event_count(spark, failures(login_events(log)), gte=gte, home=self.home, **more)

    def all(self, spark, gte=3):
        log = spark.read.schema(schemas.LOG_IN_ATTEMPTS).parquet(str(self.folder))
        return correlate.correlate_event_count(failures(login_events(log)), gte=gte)


def told(notices):
    return [
        (r.batch, r.username, r.ts.strftime("%H:%M:%S"), r.event_count, r.first_batch, r.status)
        for r in notices.orderBy("batch", "username", "ts").collect()
    ]


def test_an_alert_is_raised_at_once_revised_and_confirmed(spark, tables, tmp_path):
    inbox = Inbox(tables, tmp_path)
    inbox.add(0, 60, 120)
    inbox.add(30)          # late, but allowed
    inbox.add(3_600)       # an hour after: the watermark passes the first alerts
    inbox.add(90)          # too late now
    assert told(inbox.run(spark)) == [
        (0, "u", "12:02:00", 3, 0, "raised"),
        (1, "u", "12:01:00", 3, 1, "raised"), (1, "u", "12:02:00", 4, 0, "revised"),
        (2, "u", "12:01:00", 3, 1, "confirmed"), (2, "u", "12:02:00", 4, 0, "confirmed"),
        (2, "u", "13:00:00", 5, 2, "raised"),
    ]


def test_a_run_goes_on_in_the_same_folder_and_equals_the_batch_form(spark, tables, tmp_path):
    inbox = Inbox(tables, tmp_path)
    for k in range(4):
        inbox.add(*range(900 * k, 900 * k + 1500, 170), user="a")
        inbox.add(*range(900 * k + 100, 900 * k + 1300, 400), 900 * k + 100, user=None if k % 2 else "b")
        inbox.run(spark)
    inbox.add(90_000, user="end")
    got = confirmed(inbox.run(spark))
    want = sorted(map(repr, inbox.all(spark).select("username", "ts", "event_count").collect()))
    assert sorted(map(repr, got.select("username", "ts", "event_count").collect())) == want and len(want) > 20
    assert got.where("first_batch > confirmed_batch").count() == 0 and got.where("first_batch < confirmed_batch").count() > 10
    again = inbox.run(spark)
    assert confirmed(again).count() == len(want)


def test_nothing_comes_in(spark, tables, tmp_path):
    inbox = Inbox(tables, tmp_path)
    inbox.add()
    assert told(inbox.run(spark)) == []
    inbox.add(0, 0, 0)
    assert told(inbox.run(spark)) == [(inbox.count - 1, "u", "12:00:00", 3, inbox.count - 1, "raised")]
