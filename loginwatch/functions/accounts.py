"""Account names and severities, as SQL text."""

from __future__ import annotations

# Fixed values.
SERVICE_PATTERN = "svc_%"
SERVICE_PREFIX = "svc_"
HIGH_RISK_COUNTRIES = ["RU", "CN", "KP", "IR"]
IT_DEPARTMENTS = ["IT Security", "IT Infrastructure"]
SEVERITIES = ["HIGH", "MEDIUM", "LOW"]


def text_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def is_service(username: str = "username") -> str:
    """Case-insensitive pattern match in which ``_`` stands for any one character."""
    return f"{username} ILIKE '{SERVICE_PATTERN}'"


def starts_as_service(username: str = "username") -> str:
    """The hunts' literal prefix test, case-insensitive."""
    return f"startswith(lower({username}), '{SERVICE_PREFIX}')"


FULL_NAME = "concat(first_name, ' ', last_name)"


def country_severity(country: str = "country") -> str:
    return f"if({country} IN ({text_list(HIGH_RISK_COUNTRIES)}), 'HIGH', 'MEDIUM')"


# 1 for HIGH, 2 for MEDIUM, 3 for anything else: queue order.
SEVERITY_RANK = "CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END"
