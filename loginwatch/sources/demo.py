"""A login log derived from the generic ``events``, ``customer`` and ``orders`` tables.

Every event becomes one login attempt and every order one device; nothing is dropped.
Account numbers, the ``k`` property and order keys decide countries, addresses,
statuses and ownership, so that each rule has both hits and misses.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loginwatch import schemas
from loginwatch.config import HuntConfig
from loginwatch.sources import reference
from loginwatch.sources.tables import local_table

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)

SPLIT = date(2024, 1, 16)
ASOF_PATCH = date(2001, 8, 1)

# Thresholds loosened to the sparse demo log.
DEMO_CONFIG = HuntConfig(
    baseline_end=SPLIT,
    detection_start=SPLIT,
    asof_date=ASOF_PATCH,
    bf_window_minutes=1440,
    bf_min_failures=2,
    bf_failed_min_failures=2,
    spray_min_accounts=3,
    hour_baseline_min_samples=5,
    hour_tolerance=2,
    max_travel_speed_kmh=900.0,
)


# ``U000007``; one account number in 37 is a service account.
_ACCOUNT = "concat(if({n} % 37 = 36, 'svc_', 'U'), lpad(cast({n} AS string), 6, '0'))"

# One account number in ten never owns a device.
_OWNER = "if(o_custkey % 10 = 9, o_custkey - 1, o_custkey)"


def _with_attempt_columns(events: DataFrame) -> DataFrame:
    # props is {"k": n}
    k = "cast(substring_index(substring_index(props, ': ', -1), '}', 1) AS int) AS k"
    return events.selectExpr("event_id", "ts", "user_id", "event_type", k).selectExpr(
        "event_id",
        f"{_ACCOUNT.format(n='user_id')} AS username",
        "cast(ts AS date) AS login_date",
        "date_format(ts, 'HH:mm:ss') AS login_time",
        """CASE WHEN k < 70 THEN 'US' WHEN k < 82 THEN 'CA' WHEN k < 90 THEN 'DE'
                WHEN k < 95 THEN 'CN' ELSE 'RU' END AS country""",
        # Accounts that stay dormant until the split fail every earlier attempt.
        f"""CASE WHEN event_type = 'error' THEN 0
                 WHEN user_id % 11 = 10 AND cast(ts AS date) < date'{SPLIT}' THEN 0
                 ELSE 1 END AS success""",
        """CASE WHEN k = 93 THEN cast(NULL AS string)
                WHEN k = 94 THEN concat('2001:db8::', user_id % 16)
                WHEN event_type = 'error' OR k = 92 THEN concat('45.33.32.', user_id % 4)
                WHEN k >= 95 THEN concat('185.220.101.', k % 7)
                ELSE concat_ws('.', '10', user_id % 8, '1', user_id % 50) END AS source_ip""",
        "user_id AS account_no",
        "k",
    )


def attempts_with_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts plus the two source columns the demo labels are derived from."""
    return _with_attempt_columns(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def log_in_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempts_with_origin(spark, sf_dir).drop("account_no", "k")


def attempts_from(events: DataFrame) -> DataFrame:
    """The same mapping for any events frame, batch or streaming."""
    return _with_attempt_columns(events).drop("account_no", "k")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet").selectExpr(
        f"{_ACCOUNT.format(n='c_custkey')} AS employee_id",
        "substring_index(c_name, '#', 1) AS first_name",
        "substring_index(c_name, '#', -1) AS last_name",
        """CASE c_mktsegment WHEN 'MACHINERY' THEN 'IT Security'
                WHEN 'HOUSEHOLD' THEN 'IT Infrastructure' ELSE c_mktsegment END AS department""",
        "concat('Office-', c_nationkey) AS office",
        """CASE WHEN c_custkey % 43 = 42 THEN cast(NULL AS string) WHEN c_custkey % 7 = 6 THEN 'Terminated'
                WHEN c_custkey % 41 = 40 THEN 'On Leave' ELSE 'Active' END AS status""",
        "date_add(date'2015-01-01', cast(c_custkey % 2000 AS int)) AS hire_date",
    )


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One device per order; some have no recorded owner or one the directory lacks."""
    return spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "concat('DEV-', o_orderkey) AS device_id",
        f"""CASE WHEN o_orderkey % 89 = 0 THEN cast(NULL AS string)
                 WHEN o_orderkey % 97 = 0 THEN concat('X', o_orderkey)
                 ELSE {_ACCOUNT.format(n=_OWNER)} END AS employee_id""",
        "o_orderpriority AS operating_system",
        "cast(o_orderdate AS date) AS os_patch_date",
        "o_orderstatus AS device_type",
    )


def machines_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second inventory: one device in 50 names the next account as owner.

    One in 53 is listed under an old device id, so it exists in one inventory only.
    """
    return spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "concat(if(o_orderkey % 53 = 52, 'OLD-', 'DEV-'), o_orderkey) AS device_id",
        f"""if(o_orderkey % 50 = 0, {_ACCOUNT.format(n=f'({_OWNER} + 1)')},
               {_ACCOUNT.format(n=_OWNER)}) AS employee_id""",
    )


def identity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees(spark, sf_dir).selectExpr("employee_id AS principal", "status AS account_status")


# Beside the published ranges: one inside another, one off an octet boundary, IPv6, and
# two rows that are no range.
EXTRA_RANGES = [
    (None, "45.33.32.2/31", 1, 0.65, "demo-overlap", "overlap"),
    (None, "10.2.0.0/20", 0, 0.30, "demo-office", "office-lab"),
    (None, "2001:db8::8/125", 1, 0.60, "demo-v6", "v6-range"),
    (None, "1.2.3.0/40", 1, 0.50, "demo-bad", "bad-width"),
    (None, "nonsense", 1, 0.50, "demo-bad", "no-address"),
]


def ip_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.ip_enrichment_table(spark).unionByName(local_table(spark, EXTRA_RANGES, schemas.IP_ENRICHMENT))


def flawed_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempts with planted errors: impossible and short times, gaps, repeated ids."""
    rows = log_in_attempts(spark, sf_dir).where("event_id % 97 <> 5").withColumn("login_time", F.expr(
        "CASE WHEN event_id % 101 = 7 THEN '25:00:00' WHEN event_id % 103 = 8 THEN left(login_time, 5) ELSE login_time END"
    ))
    return rows.unionByName(rows.where("event_id % 49 = 3"))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema("n_nationkey INT, n_name STRING").parquet(f"{sf_dir}/nation.parquet")


def flawed_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configuration of eight keys, one per nation, so that the others are missing."""
    keys = ", ".join(f"'{k}'" for k in sorted(HuntConfig.keys()))
    return _nations(spark, sf_dir).where("n_nationkey < 8").selectExpr(f"array({keys})[n_nationkey] AS key", "n_name AS value")


def flawed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the nations' initials with M: some out of order, some repeated."""
    return _nations(spark, sf_dir).selectExpr("left(n_name, 1) AS country_a", "'M' AS country_b", "n_nationkey AS distance_km")


def _labelled(rows: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """One row per label that applies; each is ``if(condition, struct, NULL)``."""
    found = rows.selectExpr(key, f"explode(array({', '.join(labels)})) AS l")
    return found.where("l IS NOT NULL").selectExpr(key.split(" AS ")[-1], "l.*")


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-label ground truth; most events carry none."""
    won = f"success = 1 AND login_date >= date'{SPLIT}'"
    lost = f"success = 0 AND login_date >= date'{SPLIT}' AND source_ip LIKE '45.33.32.%'"
    bf = "concat('bf-', username, '-', login_date)"
    spray = "concat('spray-', source_ip, '-', login_date)"

    def label(when: str, malicious: int, name: str, anchor: str, campaign: str = "NULL") -> str:
        return (
            f"if({when}, named_struct('is_malicious', {malicious}, 'anomaly_class', '{name}', "
            f"'is_anchor', {anchor}, 'campaign_id', cast({campaign} AS string), 'notes', 'demo {name}'), NULL)"
        )

    return _labelled(attempts_with_origin(spark, sf_dir), "event_id", [
        label(f"{won} AND k BETWEEN 90 AND 99", 1, "unfamiliar_country", "if(k >= 97, 1, 0)"),
        label(f"{won} AND k IN (91, 97, 99)", 1, "impossible_travel", "1"),
        label(f"{won} AND k >= 95 AND login_time LIKE '03%'", 1, "after_hours", "1"),
        label(f"{won} AND k % 20 = 19", 1, "brute_force_success", "1"),
        label(f"{lost} AND account_no % 3 = 0", 1, "brute_force_failed", "0", bf),
        label(f"{lost} AND account_no % 4 <> 2", 1, "password_spray", "0", spray),
        label("account_no % 7 = 6", 1, "terminated_account", "1"),
        label("k = 50", 0, "benign_no_baseline", "0"),
    ])


def ground_truth_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset labels for devices and accounts, some of them deliberately wrong."""
    def label(when: str, name: str) -> str:
        return f"if({when}, named_struct('anomaly_class', '{name}', 'notes', 'demo'), NULL)"

    devices = _labelled(
        spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet"), "concat('DEV-', o_orderkey) AS asset_id", [
            label("o_orderkey % 97 = 0", "orphan_device"),
            label("o_orderkey % 150 = 0", "inventory_mismatch"),
            label("cast(o_orderdate AS date) < date'2000-01-01'", "critical_patch_age"),
        ],
    )
    people = _labelled(
        spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet"),
        f"{_ACCOUNT.format(n='c_custkey')} AS asset_id",
        [label("c_custkey % 10 = 9", "user_without_device")],
    )
    return devices.unionByName(people)
