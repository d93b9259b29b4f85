"""Asset-inventory checks to run before containment, and dataset invariants."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.config import HuntConfig
from loginwatch.functions import messages
from loginwatch.functions.accounts import FULL_NAME, is_service, text_list
from loginwatch.functions.clock import is_time_of_day


def orphan_devices(machines: DataFrame, employees: DataFrame) -> DataFrame:
    """Devices whose owner is unknown to the directory, or not recorded."""
    return machines.join(employees.select("employee_id"), "employee_id", "left_anti").selectExpr(
        "device_id", "employee_id AS listed_owner", "operating_system", "os_patch_date",
        f"{messages.ORPHAN_DEVICE} AS issue",
    )


def mismatched_devices(machines: DataFrame, machines_backup: DataFrame) -> DataFrame:
    """Devices in both inventories under different owners: the keys only."""
    backup = machines_backup.selectExpr("device_id", "employee_id AS backup_owner")
    return machines.selectExpr("device_id", "employee_id AS primary_owner").join(
        backup, "device_id"
    ).where("primary_owner != backup_owner")


def inventory_mismatch(machines: DataFrame, machines_backup: DataFrame, employees: DataFrame) -> DataFrame:
    """The same with the owners' names."""
    both = mismatched_devices(machines, machines_backup)
    for side in ("primary_owner", "backup_owner"):
        names = employees.selectExpr(f"employee_id AS {side}", f"{FULL_NAME} AS {side}_name")
        both = both.join(names, side, "left")
    return both.selectExpr(
        "device_id", "primary_owner", "primary_owner_name", "backup_owner", "backup_owner_name",
        f"{messages.INVENTORY_MISMATCH} AS issue",
    )


def users_without_devices(employees: DataFrame, machines: DataFrame) -> DataFrame:
    """Active people without a device. Owners are de-duplicated before the join."""
    owners = machines.select("employee_id").distinct()
    people = employees.where(f"status = 'Active' AND NOT {is_service('employee_id')}")
    return people.join(owners, "employee_id", "left_anti").selectExpr(
        "employee_id", f"{FULL_NAME} AS employee_name", "department", "status",
        f"{messages.USER_WITHOUT_DEVICE} AS issue",
    )


def containment_preflight(
    targets: DataFrame, machines: DataFrame, machines_backup: DataFrame, employees: DataFrame
) -> DataFrame:
    """The playbook's three look-ups for a whole list of ``(device_id, username)`` targets.

    ``stop`` is set when the inventories disagree, the device has no valid owner, or the
    account is unknown.
    """
    mismatched = mismatched_devices(machines, machines_backup).selectExpr(
        "device_id", "true AS mismatch"
    )
    orphaned = orphan_devices(machines, employees).selectExpr("device_id", "true AS orphan")
    accounts = employees.selectExpr("employee_id AS username", "status", "department")
    return (
        targets.select("device_id", "username")
        .join(mismatched, "device_id", "left")
        .join(orphaned, "device_id", "left")
        .join(accounts, "username", "left")
        .selectExpr(
            "device_id", "username", "status", "department",
            "mismatch IS NOT NULL AS ownership_mismatch", "orphan IS NOT NULL AS orphan_device",
            "mismatch IS NOT NULL OR orphan IS NOT NULL OR status IS NULL AS stop",
        )
    )


def mismatch_live_subjects(mismatches: DataFrame, travel: DataFrame) -> DataFrame:
    """Conflicting devices whose backup owner is under investigation for travel."""
    subjects = travel.selectExpr("username AS backup_owner").distinct()
    return mismatches.join(subjects, "backup_owner", "left_semi").select(
        "device_id", "primary_owner", "backup_owner"
    )


def _violations(check: str, rows: DataFrame, value: str = "count(1)") -> DataFrame:
    return rows.agg(F.expr(f"cast({value} AS bigint) AS value")).selectExpr(f"'{check}' AS check", "value")


def dataset_invariants(
    log_in_attempts: DataFrame,
    labels: DataFrame,
    hunt_config: DataFrame,
    pair_tables: Mapping[str, DataFrame],
    first_id: int = 1,
    rejected_ranges: DataFrame | None = None,
) -> DataFrame:
    """``(check, value)`` rows: violations per invariant, and the label totals.

    Attempts whose time does not parse have no instant and take part in no rule about
    time; feed rows that are no range match nothing. Both are counted here.
    """
    # An id below first_id is out of sequence; one missing up to the largest is a gap.
    below = f"count_if(event_id < {first_id})"
    gaps = f"greatest(coalesce(max(event_id) - {first_id} + 1, 0), 0) - (count(1) - {below}) + {below}"
    ids = log_in_attempts.groupBy("event_id").agg(F.expr("count(1) AS n"))
    id_checks = ids.agg(
        F.expr(f"cast({gaps} AS bigint) AS gaps"), F.expr("count_if(n > 1) AS duplicates"),
        F.expr("coalesce(sum(n), 0L) AS total"),
    ).selectExpr(
        "stack(3, 'non_contiguous_ids', gaps, 'duplicate_event_ids', duplicates, 'total_events', total)"
        " AS (check, value)"
    )
    keys = HuntConfig.keys()
    found = f"count(DISTINCT if(key IN ({text_list(keys)}), key, NULL))"
    unlabelled = log_in_attempts.join(labels.select("event_id").distinct(), "event_id", "left_anti")
    malicious = labels.where("is_malicious = 1").select("event_id").distinct()
    checks = [
        id_checks,
        _violations("malformed_times", log_in_attempts.where(
            f"login_date IS NULL OR NOT {is_time_of_day()}"
        )),
        _violations("unlabelled_events", unlabelled),
        _violations("malicious_events", malicious),
        _violations("missing_config_keys", hunt_config, f"{len(keys)} - {found}"),
    ]
    if rejected_ranges is not None:
        checks.append(_violations("rejected_feed_ranges", rejected_ranges))
    for name, table in pair_tables.items():
        pairs = table.groupBy("country_a", "country_b").agg(F.expr("count(1) AS n"))
        checks.append(_violations(f"{name}_unordered_pairs", table.where("country_a >= country_b")))
        checks.append(_violations(f"{name}_duplicate_pairs", pairs.where("n > 1")))
    return reduce(DataFrame.unionByName, checks)
