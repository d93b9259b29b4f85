"""What a hunt needs from the time before its window: one row per account and country.

Three rules look back at the whole log: known countries, usual hours, and the last
success before the window. Kept in a folder, this table replaces their scans of the
history. It is kept as one fold per day and merged folds of eight, sixty-four, ... days, so
that a day whose log has changed is folded anew, and only that day is read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loginwatch.config import HuntConfig
from loginwatch.operators.normalize import successes

_MERGE = {
    "first_ts": "min(first_ts)",
    "baseline_logins": "sum(baseline_logins)",
    "min_hour": "min(min_hour)",
    "max_hour": "max(max_hour)",
    "last_success": "max(last_success)",
}
_SCHEMA = (
    "username STRING, country STRING, first_ts TIMESTAMP, baseline_logins BIGINT, min_hour INT, max_hour INT, "
    "last_success STRUCT<ts: TIMESTAMP, event_id: BIGINT, login_date: DATE, login_time: STRING, source_ip: STRING>"
)
#: Folds of a level that are merged into one of the next.
FANOUT = 8


def _folded(events: DataFrame, in_baseline: str, before_window: str, *more: str) -> DataFrame:
    last = "struct(ts, event_id, login_date, login_time, source_ip)"
    return events.groupBy("username", "country", *more).agg(
        F.expr("min(ts) AS first_ts"),
        F.expr(f"count_if({in_baseline}) AS baseline_logins"),
        F.expr(f"min(if({in_baseline}, login_hour, NULL)) AS min_hour"),
        F.expr(f"max(if({in_baseline}, login_hour, NULL)) AS max_hour"),
        F.expr(f"max(if({before_window}, {last}, NULL)) AS last_success"),
    )


def account_history(events: DataFrame, cfg: HuntConfig) -> DataFrame:
    """Fold the successes before the window, or before the baseline ends if that is later."""
    in_baseline = f"login_date < date'{cfg.baseline_end}'"
    before_window = f"login_date < date'{cfg.detection_start}'"
    return _folded(successes(events).where(f"{in_baseline} OR {before_window}"), in_baseline, before_window)


def merge_history(*parts: DataFrame) -> DataFrame:
    """Combine histories built with the same dates over disjoint sets of events."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("username", "country").agg(*[F.expr(f"{v} AS {c}") for c, v in _MERGE.items()])


# ------------------------------------------------------------------------- kept in folders

class Fold(NamedTuple):
    """A fold in force: level 0 is a day, level n is a block of ``FANOUT ** n`` days.

    ``folder`` is NULL for a day without successes. ``events`` counts what the day had when it
    was folded, ``in_baseline`` says on which side of the baseline's end it was then;
    ``parts`` are the folders that a merged fold was made from.
    """
    level: int
    first: date
    last: date
    folder: str | None
    events: int
    in_baseline: bool
    parts: list[str]


_FOLD = (
    "level INT, first DATE, last DATE, folder STRING, events BIGINT, in_baseline BOOLEAN, parts ARRAY<STRING>"
)


class Manifest(NamedTuple):
    """The folds in force, and the day that they reach (not included)."""
    version: int
    until: date | None
    folds: list[Fold]

    def days(self) -> dict[date, Fold]:
        return {f.first: f for f in self.folds if f.level == 0}

    def cover(self, until: date) -> list[Fold]:
        """The fewest folds that hold all days before ``until``, larger ones first."""
        chosen: list[Fold] = []
        for fold in sorted(self.folds, key=lambda f: (-f.level, f.first)):
            if fold.last < until and not any(c.first <= fold.first and fold.last <= c.last for c in chosen):
                chosen.append(fold)
        return [f for f in chosen if f.folder]


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, whichever store it names, and a function for paths in it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest at ``path``; an empty one if there is none."""
    files, make = _files(spark, path)
    home = make(f"{path}/manifest")
    names = [s.getPath().getName() for s in files.listStatus(home)] if files.exists(home) else []
    versions = sorted(int(n[2:]) for n in names if n.startswith("v="))
    if not versions:
        return Manifest(0, None, [])
    rows = spark.read.schema(f"until DATE, {_FOLD}").json(f"{path}/manifest/v={versions[-1]}").collect()
    folds = [Fold(*r[1:]) for r in rows if r["level"] is not None]
    return Manifest(versions[-1], rows[0]["until"], folds)


def _commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Puts a manifest in force by renaming it to its version; a version exists once."""
    files, make = _files(spark, path)
    draft, final = f"{path}/manifest/draft-{uuid.uuid4().hex}", make(f"{path}/manifest/v={manifest.version}")
    rows = [(manifest.until, *f) for f in manifest.folds] or [(manifest.until, *[None] * len(Fold._fields))]
    spark.createDataFrame(rows, f"until DATE, {_FOLD}").coalesce(1).write.json(draft)
    if files.exists(final) or not files.rename(make(draft), final):
        raise RuntimeError(f"another writer has committed version {manifest.version} of {path}")


def read_history(spark: SparkSession, path: str, cfg: HuntConfig) -> DataFrame:
    """The kept history of all days before the window, merged from the fewest folds.

    Refused if the folder does not reach the window, or if days have changed sides of the
    baseline's end since they were folded: an update mends both.
    """
    manifest, until = read_manifest(spark, path), cfg.detection_start
    if manifest.until is None or manifest.until < until:
        raise ValueError(f"the history at {path} reaches {manifest.until}, not {until}: update it")
    moved = [d for d, f in manifest.days().items() if d < until and f.in_baseline != (d < cfg.baseline_end)]
    if moved:
        raise ValueError(f"the history at {path} has another baseline on {moved[0]}: update it")
    folders = [f"{path}/folds/{f.folder}" for f in manifest.cover(until)]
    if not folders:
        return spark.createDataFrame([], _SCHEMA)
    return merge_history(*[spark.read.schema(_SCHEMA).parquet(f) for f in folders])


def _block(day: date, level: int) -> tuple[date, date]:
    size = FANOUT**level
    first = day.toordinal() // size * size
    return date.fromordinal(first), date.fromordinal(first + size - 1)


def _merged(spark: SparkSession, path: str, folds: list[Fold], until: date) -> list[Fold]:
    """``folds`` with the merged folds that are complete and not there yet, level by level."""
    level = 0
    while FANOUT ** (level + 1) <= (until - date.min).days:
        blocks: dict[tuple[date, date], list[Fold]] = {}
        for fold in folds:
            if fold.level == level:
                blocks.setdefault(_block(fold.first, level + 1), []).append(fold)
        there = {(f.first, f.last) for f in folds if f.level == level + 1}
        added = []
        for (first, last), parts in blocks.items():
            held = sorted(f.folder for f in parts if f.folder)
            if last < until and (first, last) not in there and len(parts) > 1:
                folder = uuid.uuid4().hex if held else None
                if held:
                    read = [spark.read.schema(_SCHEMA).parquet(f"{path}/folds/{p}") for p in held]
                    merge_history(*read).write.parquet(f"{path}/folds/{folder}")
                added.append(Fold(level + 1, first, last, folder, sum(f.events for f in parts), parts[0].in_baseline, held))
        folds = folds + added
        if not any(f.level == level + 1 for f in folds):
            break
        level += 1
    return folds


def stale_days(events: DataFrame, cfg: HuntConfig, manifest: Manifest, dirty: Iterable[date] = ()) -> dict[date, int]:
    """Days before the window to be folded (anew), with their numbers of events.

    New days, days that have another number of events than when they were folded (late
    ones came in), days that changed sides of the baseline's end, and those named
    ``dirty``. One count per day is read; no column of the log but its day is.
    """
    counts = events.where(f"login_date < date'{cfg.detection_start}'").groupBy("login_date").agg(F.count(F.lit(1)).alias("n"))
    known, found = manifest.days(), {r["login_date"]: r["n"] for r in counts.collect()}
    dirty = set(dirty)
    gone = {d: 0 for d, f in known.items() if d < cfg.detection_start and d not in found and f.events}
    return {
        d: n for d, n in sorted((found | gone).items())
        if d in dirty or d not in known or known[d].events != n or known[d].in_baseline != (d < cfg.baseline_end)
    }


def on_days(events: DataFrame, days: Iterable[date]) -> DataFrame:
    """The events of some days: their partitions are all that is read."""
    listed = ", ".join(f"date'{d}'" for d in days)
    return events.where(f"login_date IN ({listed})" if listed else "false")


def update_history(events: DataFrame, cfg: HuntConfig, path: str, dirty: Sequence[date] = ()) -> DataFrame:
    """Bring the history at ``path`` up to ``cfg.detection_start`` and return it.

    Only the days that :func:`stale_days` names are read from ``events``: one job folds all of
    them, a folder per day. Merged folds that hold an old fold of such a day go out of force
    and are made again from the folds below them. Nothing is in force before the new
    manifest is renamed to its version, so a run that dies leaves folders without effect
    and is repeated as it was; one writer at a time. The baseline must not end after the
    window starts, as such days are not over yet.
    """
    spark, until = events.sparkSession, cfg.detection_start
    if cfg.baseline_end > until:
        raise ValueError("the baseline ends after the window starts")
    manifest = read_manifest(spark, path)
    stale = stale_days(events, cfg, manifest, dirty)
    reach = max(until, manifest.until or until)
    if stale or manifest.until is None or reach > manifest.until:
        home, held = uuid.uuid4().hex, set()
        if stale:
            in_baseline = f"login_date < date'{cfg.baseline_end}'"
            daily = _folded(successes(on_days(events, stale)), in_baseline, "true", "login_date")
            daily.write.partitionBy("login_date").parquet(f"{path}/folds/{home}")
            written = spark.read.parquet(f"{path}/folds/{home}") if _has_parts(spark, f"{path}/folds/{home}") else None
            held = {r[0] for r in written.select(F.col("login_date").cast("date")).distinct().collect()} if written else set()
        folds = [f for f in manifest.folds if not any(f.first <= d <= f.last for d in stale)]
        for day, n in stale.items():
            folder = f"{home}/login_date={day}" if day in held else None
            folds.append(Fold(0, day, day, folder, n, day < cfg.baseline_end, []))
        _commit(spark, path, Manifest(manifest.version + 1, reach, _merged(spark, path, folds, reach)))
    return read_history(spark, path, cfg)


def _has_parts(spark: SparkSession, folder: str) -> bool:
    files, make = _files(spark, folder)
    return any(s.isDirectory() for s in files.listStatus(make(folder)))
