"""Explicit schemas of the tables the operators read. Nothing is inferred."""

LOG_IN_ATTEMPTS = (
    "event_id BIGINT, username STRING, login_date DATE, login_time STRING, "
    "country STRING, success INT, source_ip STRING"
)
EMPLOYEES = (
    "employee_id STRING, first_name STRING, last_name STRING, department STRING, "
    "office STRING, status STRING, hire_date DATE"
)
MACHINES = (
    "device_id STRING, employee_id STRING, operating_system STRING, "
    "os_patch_date DATE, device_type STRING"
)
MACHINES_BACKUP = "device_id STRING, employee_id STRING"
HUNT_CONFIG = "key STRING, value STRING"
IP_ENRICHMENT = (
    "ip_prefix STRING, cidr STRING, is_malicious INT, confidence DOUBLE, "
    "source STRING, tags STRING"
)
COUNTRY_DISTANCE = "country_a STRING, country_b STRING, distance_km INT"
TRAVEL_EXCEPTIONS = "country_a STRING, country_b STRING, rationale STRING"
GROUND_TRUTH = (
    "event_id BIGINT, is_malicious INT, anomaly_class STRING, is_anchor INT, "
    "campaign_id STRING, notes STRING"
)
GROUND_TRUTH_ASSETS = "asset_id STRING, anomaly_class STRING, notes STRING"
IDENTITY_FEED = "principal STRING, account_status STRING"

# Column order of a finding, shared by every branch of the triage queue.
FINDING_COLUMNS = [
    "detection_type", "event_id", "campaign_key", "username", "user_name", "department",
    "timestamp", "source_ip", "severity", "mitre_technique", "reason",
]
