"""Small reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loginwatch import schemas
from loginwatch.sources.tables import local_table

# Configuration defaults, address ranges, distances, centroids.
DEFAULT_CONFIG = {
    "baseline_end": "2025-01-13",
    "detection_start": "2025-01-13",
    "asof_date": "2025-01-20",
    "bf_window_minutes": "60",
    "bf_min_failures": "5",
    "bf_failed_min_failures": "10",
    "spray_min_accounts": "5",
    "hour_baseline_min_samples": "5",
    "hour_tolerance": "2",
    "max_travel_speed_kmh": "900",
}

IP_RANGES = [
    ("185.220.101.", "185.220.101.0/24", 1, 0.85, "mock-tor-list", "tor-exit"),
    ("45.33.32.", "45.33.32.0/24", 1, 0.75, "mock-scanner-feed", "scanner,brute-force"),
    ("198.51.100.", "198.51.100.0/24", 1, 0.95, "mock-c2-feed", "c2"),
    ("203.0.113.", "203.0.113.0/24", 1, 0.70, "mock-miner-feed", "cryptominer"),
    ("100.64.", "100.64.0.0/16", 0, 0.45, "mock-proxy-feed", "residential-proxy"),
    ("192.0.2.", "192.0.2.0/24", 0, 0.40, "mock-hosting-feed", "bulletproof-hosting"),
]

COUNTRY_DISTANCES = [
    ("CA", "CN", 9400),
    ("CA", "DE", 6750),
    ("CA", "RU", 6650),
    ("CA", "US", 1900),
    ("CN", "DE", 7250),
    ("CN", "RU", 2850),
    ("CN", "US", 11250),
    ("DE", "RU", 5450),
    ("DE", "US", 7800),
    ("RU", "US", 8550),
]

CENTROIDS = {
    "US": (39.8, -98.6),
    "CA": (56.1, -106.3),
    "CN": (35.9, 104.2),
    "DE": (51.2, 10.4),
    "RU": (61.5, 105.3),
}

TRAVEL_EXCEPTIONS = [("CA", "US", "Known business corridor; centroids overstate border hops.")]


def ip_enrichment_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, IP_RANGES, schemas.IP_ENRICHMENT)


def country_distance_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, COUNTRY_DISTANCES, schemas.COUNTRY_DISTANCE)


def travel_exceptions_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, TRAVEL_EXCEPTIONS, schemas.TRAVEL_EXCEPTIONS)


def hunt_config_table(spark: SparkSession, values: dict[str, str] | None = None) -> DataFrame:
    merged = {**DEFAULT_CONFIG, **(values or {})}
    return local_table(spark, sorted(merged.items()), schemas.HUNT_CONFIG)
