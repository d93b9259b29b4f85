"""All inputs of a hunt, and the detections over them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date, timedelta
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from loginwatch import schemas
from loginwatch.config import HuntConfig
from loginwatch.functions import clock
from loginwatch.operators import after_hours, baselines, brute_force, impossible_travel, incidents, integrity
from loginwatch.operators import inactive_account, metrics, password_spray, triage, unfamiliar_country
from loginwatch.operators.enrich import ThreatFeed
from loginwatch.operators.history import account_history, read_history, update_history
from loginwatch.operators.membership import Membership
from loginwatch.operators.normalize import login_events, since_day
from loginwatch.operators.skew import HotKeys
from loginwatch.plans.session import stored
from loginwatch.sources import demo, reference
from loginwatch.sources.tables import read_login_log, read_table


class Hunt:
    """The tables of one hunt, and what is built over them; all of it lazy.

    ``tables`` maps table names to functions, so a query only plans what it reads.
    """

    def __init__(
        self,
        tables: Mapping[str, Callable[[], DataFrame]],
        cfg: HuntConfig,
        history: DataFrame | None = None,
        window: DataFrame | None = None,
        names: bool = True,
    ):
        self._tables = tables
        self._built: dict[str, DataFrame] = {}
        self.cfg = cfg
        self.history = history
        self._window = window
        self._names = names

    @property
    def unnamed(self) -> Hunt:
        """The same hunt without display columns: for scores, counts and the hand-off."""
        other = Hunt(self._tables, self.cfg, self.history, self._window, names=False)
        if "hot" in self.__dict__:
            other.hot = self.hot
        return other

    @property
    def _shown(self) -> DataFrame | None:
        return self.employees if self._names else None

    def with_stored_history(self) -> Hunt:
        """The same hunt over a stored account history: later steps skip the old days."""
        return Hunt(self._tables, self.cfg, stored(account_history(self.events, self.cfg), "history"), self._window)

    def update_history(self, path: str, dirty: Sequence[date] = ()) -> DataFrame:
        """Bring the history at ``path`` up to the window; reads only the days it lacks, days
        that late events have changed, and those named ``dirty``."""
        return update_history(self.events, self.cfg, path, dirty)

    def with_history(self, path: str) -> Hunt:
        """The same hunt over the history at ``path``, which must reach the window."""
        spark = self.events.sparkSession
        return Hunt(self._tables, self.cfg, read_history(spark, path, self.cfg), self._window)

    @cached_property
    def prepared(self) -> Hunt:
        """The same hunt over two stored folds of the log.

        The log is read once for the days before the window, folded per account and
        country (unless a history is given), and once for the window, with the
        reach of the brute-force rule before it; rules start from these, however
        many they are. Only the inactive-account rule looks at the whole log.
        """
        if self._window is not None:
            return self
        reach = clock.dates_from(clock.utc(self.cfg.detection_start) - timedelta(minutes=self.cfg.bf_window_minutes))
        window = stored(since_day(self.events, reach), "window")
        history = self.history
        if history is None:
            history = stored(account_history(self.events, self.cfg), "history")
        return Hunt(self._tables, self.cfg, history, window)

    @property
    def recent(self) -> DataFrame:
        """What the window's rules read: the stored window if there is one, else the log."""
        return self.events if self._window is None else self._window

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._tables[name]()
        return self._built[name]

    attempts = property(lambda self: self.table("log_in_attempts"))
    employees = property(lambda self: self.table("employees"))
    machines = property(lambda self: self.table("machines"))
    machines_backup = property(lambda self: self.table("machines_backup"))
    country_distance = property(lambda self: self.table("country_distance"))
    travel_exceptions = property(lambda self: self.table("travel_exceptions"))
    labels = property(lambda self: self.table("ground_truth"))
    asset_labels = property(lambda self: self.table("ground_truth_assets"))

    @cached_property
    def events(self) -> DataFrame:
        return login_events(self.attempts)

    @property
    def window_events(self) -> DataFrame:
        return since_day(self.recent, self.cfg.detection_start)

    @cached_property
    def hot(self) -> HotKeys:
        """Accounts too busy for one task in the window, counted once for all rules."""
        return HotKeys.of(self.window_events, ["username"])

    @cached_property
    def feed(self) -> ThreatFeed:
        return ThreatFeed.load(self.table("ip_enrichment"))

    def unfamiliar_country(self) -> DataFrame:
        return unfamiliar_country.detect_unfamiliar_country(
            self.recent, self._shown, self.cfg, self.history, self.hot
        )

    def impossible_travel(self) -> DataFrame:
        return impossible_travel.detect_impossible_travel(
            self.recent, self._shown, self.country_distance, self.travel_exceptions, self.cfg,
            history=self.history,
        )

    def after_hours(self) -> DataFrame:
        return after_hours.detect_after_hours(self.recent, self.employees, self.cfg, self.history, self.hot)

    def brute_force(self) -> DataFrame:
        return brute_force.detect_brute_force(self.recent, self._shown, self.cfg)

    def bruteforce_failed(self) -> DataFrame:
        return brute_force.detect_bruteforce_failed(self.recent, self._shown, self.cfg)

    def password_spray(self) -> DataFrame:
        """Findings without the account names, which no consumer of the queue needs."""
        return password_spray.spray_findings(self.recent, self.cfg)

    def password_spray_named(self) -> DataFrame:
        return password_spray.detect_password_spray(self.recent, self.cfg)

    def inactive_account(self) -> DataFrame:
        return inactive_account.detect_inactive_account(self.events, self.employees)

    def detections(self, rules: Iterable[str] = tuple(triage.RULE_TAGS)) -> dict[str, DataFrame]:
        return {rule: getattr(self, rule)() for rule in rules}

    def event_findings(self) -> DataFrame:
        return metrics.event_findings(self.unnamed.detections(metrics.rules_of("event")))

    def campaign_findings(self) -> dict[str, DataFrame]:
        return self.unnamed.detections(metrics.rules_of("campaign"))

    def findings_by_user(self) -> DataFrame:
        """Findings per account; neither names nor the feed take part in them."""
        return incidents.findings_by_user(triage.all_findings(self.prepared.unnamed.detections()))

    @cached_property
    def by_user(self) -> DataFrame:
        """The same written once: what the hand-off steps start from."""
        return stored(self.findings_by_user(), "findings_by_user")

    @cached_property
    def flagged(self) -> Membership:
        """Accounts with findings, for joins with the log; see :class:`Membership`."""
        return Membership.of(self.by_user, "username")

    def queue(self) -> DataFrame:
        return triage.triage_queue(self.prepared.detections(), self.feed)

    def patches(self) -> DataFrame:
        return baselines.patch_status(self.machines, self.employees, self.cfg)

    def orphans(self) -> DataFrame:
        return integrity.orphan_devices(self.machines, self.employees)

    def mismatches(self) -> DataFrame:
        return integrity.inventory_mismatch(self.machines, self.machines_backup, self.employees)

    def mismatched(self) -> DataFrame:
        return integrity.mismatched_devices(self.machines, self.machines_backup)

    def deviceless(self) -> DataFrame:
        return integrity.users_without_devices(self.employees, self.machines)

    def scores(self) -> DataFrame:
        ready = self.prepared
        return metrics.rule_scores(
            metrics.event_metrics(ready.event_findings(), self.labels),
            metrics.campaign_metrics(ready.campaign_findings(), ready.window_events, self.labels),
        )

    def summary(self) -> DataFrame:
        return metrics.dataset_summary(
            self.events, self.labels, self.employees, self.machines, self.queue(),
            [self.orphans(), self.mismatched(), self.deviceless()], self.patches(),
        )


def demo_hunt(spark: SparkSession, sf_dir: str, cfg: HuntConfig = demo.DEMO_CONFIG) -> Hunt:
    """A hunt over the demo log of ``sf_dir``."""
    derived = ["log_in_attempts", "employees", "machines", "machines_backup", "ground_truth",
               "ground_truth_assets", "ip_enrichment"]
    fixed = ["country_distance", "travel_exceptions"]
    tables = {name: partial(getattr(demo, name), spark, sf_dir) for name in derived}
    tables |= {name: partial(getattr(reference, f"{name}_table"), spark) for name in fixed}
    # A real hunt has its labels as a table; here they are derived from the log, once.
    tables["ground_truth"] = lambda: stored(demo.ground_truth(spark, sf_dir), "labels")
    return Hunt(tables, cfg)


def stored_hunt(spark: SparkSession, path: str) -> Hunt:
    """A hunt over stored tables: one Parquet folder per table name below ``path``."""
    names = ["employees", "machines", "machines_backup", "ip_enrichment", "country_distance",
             "travel_exceptions", "ground_truth", "ground_truth_assets"]
    tables = {
        n: partial(read_table, spark, f"{path}/{n}", getattr(schemas, n.upper())) for n in names
    }
    tables["log_in_attempts"] = partial(read_login_log, spark, f"{path}/log_in_attempts")
    config = read_table(spark, f"{path}/hunt_config", schemas.HUNT_CONFIG)
    return Hunt(tables, HuntConfig.from_table(config))
