"""Ground-truth labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COLUMNS = ["event_id", "is_malicious", "anomaly_class", "is_anchor", "campaign_id", "notes"]


def complete_labels(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels plus one plain benign label for every event that has none."""
    missing = events.select("event_id").join(labels.select("event_id"), "event_id", "left_anti")
    benign = missing.select(
        "event_id", F.lit(0).alias("is_malicious"), F.lit("benign").alias("anomaly_class"),
        F.lit(0).alias("is_anchor"), F.lit(None).cast("string").alias("campaign_id"),
        F.lit(None).cast("string").alias("notes"),
    )
    return labels.select(*_COLUMNS).unionByName(benign)


def label_campaign(
    events: DataFrame, members: Column, anomaly_class: str, campaign_id: Column | str, notes: str
) -> DataFrame:
    """Malicious, non-anchor labels for the events ``members`` selects."""
    campaign = campaign_id if isinstance(campaign_id, Column) else F.lit(campaign_id)
    return events.where(members).select(
        "event_id", F.lit(1).alias("is_malicious"), F.lit(anomaly_class).alias("anomaly_class"),
        F.lit(0).alias("is_anchor"), campaign.alias("campaign_id"), F.lit(notes).alias("notes"),
    )
