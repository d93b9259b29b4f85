"""The kept history: late days, merged folds, commits, and what is read."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import timedelta

import pytest

from loginwatch.operators import history as kept
from loginwatch.operators.normalize import login_events

from conftest import START, config, day


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def log(rnd, n, days, first=0):
    return [
        (first + i, f"u{rnd.randrange(4)}", day(-rnd.choice(days), f"{rnd.randrange(24):02d}:00:{rnd.randrange(60):02d}"),
         rnd.choice(["US", "DE", "CA"]), int(rnd.random() < 0.7), "1.1.1.1") for i in range(n)
    ]


@pytest.fixture()
def cfg():
    return config(baseline_end=str(START), detection_start=str(START))


def test_late_events_enter_and_only_their_days_are_folded(tables, cfg, tmp_path):
    rnd, path = random.Random(1), str(tmp_path)
    early = log(rnd, 120, range(1, 20))
    late = log(rnd, 15, [3, 11], 1000)
    kept.update_history(tables.events(early), cfg, path)
    before = kept.read_manifest(tables.spark, path)
    events = tables.events(early + late)
    assert set(kept.stale_days(events, cfg, before)) == {START - timedelta(days=d) for d in (3, 11)}
    assert rows_of(kept.update_history(events, cfg, path)) == rows_of(kept.account_history(events, cfg))
    after = kept.read_manifest(tables.spark, path)
    changed = {d for d, f in after.days().items() if before.days().get(d) != f}
    assert changed == {START - timedelta(days=d) for d in (3, 11)} and after.version == before.version + 1
    # Nothing new: nothing is written.
    kept.update_history(events, cfg, path)
    assert kept.read_manifest(tables.spark, path) == after


def test_days_named_dirty_are_folded_again(tables, cfg, tmp_path):
    """An event that replaces another leaves the count as it was."""
    path, rows = str(tmp_path), [(1, "u", day(-2), "US", 1, "x"), (2, "u", day(-1), "US", 1, "x")]
    kept.update_history(tables.events(rows), cfg, path)
    other = tables.events([(3, "u", day(-2), "DE", 1, "x"), rows[1]])
    assert rows_of(kept.update_history(other, cfg, path)) != rows_of(kept.account_history(other, cfg))
    again = kept.update_history(other, cfg, path, [START - timedelta(days=2)])
    assert rows_of(again) == rows_of(kept.account_history(other, cfg))


def test_merged_folds_are_few_and_follow_their_days(tables, cfg, tmp_path):
    rnd, path = random.Random(2), str(tmp_path)
    early = log(rnd, 400, range(1, 100)) + [(5000 + d, "u0", day(-d), "US", 1, "x") for d in range(1, 100)]
    events = tables.events(early)
    assert rows_of(kept.update_history(events, cfg, path)) == rows_of(kept.account_history(events, cfg))
    manifest = kept.read_manifest(tables.spark, path)
    assert len(manifest.days()) == 99 and {f.level for f in manifest.folds} >= {0, 1}
    assert len(manifest.cover(START)) < 30
    # An earlier window is read from other folds of the same folder.
    earlier = replace(cfg, detection_start=START - timedelta(days=37), baseline_end=START)
    with pytest.raises(ValueError, match="baseline ends after"):
        kept.update_history(events, earlier, path)
    earlier = replace(earlier, baseline_end=earlier.detection_start)
    assert rows_of(kept.read_history(tables.spark, path, earlier)) == rows_of(kept.account_history(events, earlier))
    more = tables.events(early + [(9000, "late", day(-50), "CA", 1, "x")])
    assert rows_of(kept.update_history(more, cfg, path)) == rows_of(kept.account_history(more, cfg))
    now = kept.read_manifest(tables.spark, path)
    late = START - timedelta(days=50)
    assert {(f.level, f.first) for f in now.folds if f not in manifest.folds} == {
        (f.level, f.first) for f in manifest.folds if f.first <= late <= f.last
    }


@pytest.mark.parametrize("point", ["_merged", "_commit"])
def test_a_run_that_dies_has_no_effect_and_can_be_repeated(tables, cfg, tmp_path, monkeypatch, point):
    rnd, path = random.Random(3), str(tmp_path)
    early = log(rnd, 60, range(1, 12))
    kept.update_history(tables.events(early), cfg, path)
    was = rows_of(kept.read_history(tables.spark, path, cfg))
    events = tables.events(early + log(rnd, 10, [2], 500))

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(kept, point, die)
        with pytest.raises(RuntimeError, match="killed"):
            kept.update_history(events, cfg, path)
    assert rows_of(kept.read_history(tables.spark, path, cfg)) == was
    assert rows_of(kept.update_history(events, cfg, path)) == rows_of(kept.account_history(events, cfg))


def test_a_second_writer_is_refused(tables, cfg, tmp_path):
    path = str(tmp_path)
    kept.update_history(tables.events(log(random.Random(4), 9, [1, 2])), cfg, path)
    with pytest.raises(RuntimeError, match="another writer"):
        kept._commit(tables.spark, path, kept.read_manifest(tables.spark, path))


def test_a_moved_baseline_is_noticed(tables, cfg, tmp_path):
    rnd, path = random.Random(5), str(tmp_path)
    events = tables.events(log(rnd, 80, range(1, 9)))
    kept.update_history(events, cfg, path)
    moved = replace(cfg, baseline_end=START - timedelta(days=3))
    with pytest.raises(ValueError, match="another baseline"):
        kept.read_history(tables.spark, path, moved)
    assert rows_of(kept.update_history(events, moved, path)) == rows_of(kept.account_history(events, moved))
    with pytest.raises(ValueError, match="update it"):
        kept.read_history(tables.spark, path, replace(cfg, detection_start=START + timedelta(days=1)))


def test_no_events_and_no_successes(tables, cfg, tmp_path):
    empty = tables.events([])
    assert kept.update_history(empty, cfg, str(tmp_path / "a")).count() == 0
    failed = tables.events([(1, "u", day(-1), "US", 0, "x")])
    assert kept.update_history(failed, cfg, str(tmp_path / "b")).count() == 0
    gone = kept.update_history(tables.events([(1, "u", day(-1), "US", 1, "x")]), cfg, str(tmp_path / "c"))
    assert gone.count() == 1 and kept.update_history(empty, cfg, str(tmp_path / "c")).count() == 0


def test_only_stale_days_reach_the_scan(tables, cfg, tmp_path, capsys):
    attempts = tables.attempts(log(random.Random(6), 90, range(1, 10)))
    attempts.write.partitionBy("login_date").parquet(str(tmp_path / "log"))
    events = login_events(tables.spark.read.schema(attempts.schema).parquet(str(tmp_path / "log")))
    days = [START - timedelta(days=d) for d in (2, 5)]
    kept.on_days(events, days).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [login_date" in plan and all(str(d) in plan.split("PartitionFilters")[1].split("\n")[0] for d in days)
    kept.on_days(events, []).explain("formatted")
    assert kept.on_days(events, []).count() == 0
