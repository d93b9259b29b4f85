"""One source trying many accounts in a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.config import HuntConfig
from loginwatch.functions import messages
from loginwatch.functions.text import joined
from loginwatch.operators.normalize import since_day
from loginwatch.operators.skew import dealt_join


#: Names on a page.
NAMES_PER_PAGE = 1000


def source_day_accounts(events: DataFrame) -> DataFrame:
    """First level: one row per source, day and account.

    It combines map-side and spreads a busy source over its accounts, and it turns the
    distinct count of the second level into a plain one.
    """
    return events.groupBy("source_ip", "login_date", "username").agg(
        F.expr("count_if(success = 0) AS failures"), F.expr("count_if(success = 1) AS wins"),
        F.expr("min(ts) AS first_ts"), F.expr("max(ts) AS last_ts"),
    )


def spray_groups(events: DataFrame, cfg: HuntConfig) -> DataFrame:
    """Second level: sources and days broad enough to fire, without account names."""
    accounts = source_day_accounts(since_day(events, cfg.detection_start))
    return (
        accounts.groupBy("source_ip", "login_date")
        .agg(
            F.expr("count_if(failures > 0 AND username IS NOT NULL) AS accounts_targeted"), F.expr("count(1) AS accounts"),
            F.expr("sum(failures) AS total_failures"), F.expr("sum(wins) AS successes"),
            F.expr("min(first_ts) AS first_ts"), F.expr("max(last_ts) AS last_ts"),
        )
        .where(f"accounts_targeted >= {cfg.spray_min_accounts}")
    )


def _keyed(groups: DataFrame, *columns: str) -> DataFrame:
    """The group key under other names, for joins in which an unknown source matches itself."""
    return groups.selectExpr("source_ip AS key_ip", "login_date AS key_date", *columns)


_SAME_KEY = "source_ip <=> key_ip AND login_date = key_date"


def spray_accounts(events: DataFrame, cfg: HuntConfig) -> DataFrame:
    """Accounts a firing source touched that day, one row each: the unbounded form."""
    accounts = source_day_accounts(since_day(events, cfg.detection_start))
    return dealt_join(accounts, _keyed(spray_groups(events, cfg)), _SAME_KEY, "username", "left_semi").select(
        "source_ip", "login_date", "username", "failures", "wins"
    )


def spray_findings(events: DataFrame, cfg: HuntConfig, *more: str) -> DataFrame:
    """Everything about a firing source but the account names."""
    return spray_groups(events, cfg).selectExpr(
        *more,
        "source_ip", "login_date", "accounts_targeted", "total_failures", "successes",
        "date_format(first_ts, 'HH:mm:ss') AS first_attempt",
        "date_format(last_ts, 'HH:mm:ss') AS last_attempt",
        "concat(source_ip, '|', login_date) AS campaign_key",
        "if(successes > 0, 'HIGH', 'MEDIUM') AS severity",
        f"{messages.PASSWORD_SPRAY} AS reason",
    )


def with_name_pages(groups: DataFrame, accounts: DataFrame, page: int = NAMES_PER_PAGE) -> DataFrame:
    """``groups`` with their account names: one row per ``page``, ``usernames`` in order.

    ``groups`` has the number of ``accounts`` per source and day. A group of up to ``page``
    accounts is one page, number 0; a wider one is dealt by a hash of the name to as many
    pages as hold about ``page`` names each. Every name is on a page, and no row or task
    gathers a whole spray.
    """
    pages = _keyed(groups, f"cast(ceil(accounts / {page}D) AS bigint) AS pages")
    dealt = dealt_join(accounts, pages, _SAME_KEY, "username").selectExpr(
        "source_ip", "login_date", "username", "pmod(crc32(coalesce(username, '')), pages) AS page"
    ).groupBy("source_ip", "login_date", "page").agg(F.expr(f"{joined('collect_list(username)')} AS usernames"))
    return groups.join(_keyed(dealt, "page", "usernames"), F.expr(_SAME_KEY)).drop("key_ip", "key_date")


def detect_password_spray(events: DataFrame, cfg: HuntConfig, page: int = NAMES_PER_PAGE) -> DataFrame:
    """Firing sources with the names of all accounts they touched, page by page.

    Use :func:`spray_accounts` for rows; the triage queue builds no names at all.
    """
    accounts = source_day_accounts(since_day(events, cfg.detection_start))
    return with_name_pages(spray_findings(events, cfg, "accounts"), accounts, page).select(
        "source_ip", "login_date", "accounts_targeted", "total_failures", "successes", "page", "usernames",
        "first_attempt", "last_attempt", "campaign_key", "severity", "reason",
    )
