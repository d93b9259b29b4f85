"""Any activity on an account the directory does not list as active."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loginwatch.functions import clock, messages
from loginwatch.functions.accounts import FULL_NAME, text_list
from loginwatch.operators.sizing import broadcast_if_small

# Statuses the terminated-account rule selects.
TERMINATED_STATUSES = ["Terminated", "Disabled", "Suspended"]


def detect_inactive_account(events: DataFrame, employees: DataFrame) -> DataFrame:
    """The whole history, success or not. A NULL status is not evidence and stays out.

    Without a shuffle as long as the inactive accounts fit the checked broadcast bound.
    """
    inactive = employees.where("status != 'Active'").selectExpr(
        "employee_id AS username", f"{FULL_NAME} AS user_name", "department", "status AS account_status"
    )
    return events.join(broadcast_if_small(inactive), "username").selectExpr(
        "event_id", "username", "user_name", "department", "account_status", f"{clock.stamp()} AS timestamp",
        "country", "source_ip", "if(success = 1, 'SUCCESS', 'FAILED') AS outcome", "'HIGH' AS severity",
        f"{messages.INACTIVE_ACCOUNT} AS reason",
    )


def select_terminated(events_with_status: DataFrame) -> DataFrame:
    """The rule form: enriched events whose status is on the rule's list."""
    return events_with_status.where(f"account_status IN ({text_list(TERMINATED_STATUSES)})")
