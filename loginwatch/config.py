"""Typed hunt configuration, read once from the key/value table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MissingConfigKey(ValueError):
    """A tunable the rules need is absent from the configuration table."""


@dataclass(frozen=True)
class HuntConfig:
    """The ten tunables. They enter plans as literals, so date bounds reach the scan."""

    baseline_end: date
    detection_start: date
    asof_date: date
    bf_window_minutes: int
    bf_min_failures: int
    bf_failed_min_failures: int
    spray_min_accounts: int
    hour_baseline_min_samples: int
    hour_tolerance: int
    max_travel_speed_kmh: float

    @classmethod
    def keys(cls) -> list[str]:
        return [f.name for f in fields(cls)]

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> HuntConfig:
        missing = [k for k in cls.keys() if values.get(k) is None]
        if missing:
            raise MissingConfigKey(f"hunt_config lacks: {', '.join(missing)}")
        casts = {"date": date.fromisoformat, "int": int, "float": float}
        return cls(**{f.name: casts[f.type](str(values[f.name])) for f in fields(cls)})

    @classmethod
    def from_table(cls, hunt_config: DataFrame) -> HuntConfig:
        """Read the table; only the known keys travel to the driver."""
        known = hunt_config.where(F.col("key").isin(cls.keys())).select("key", "value")
        return cls.from_mapping({r["key"]: r["value"] for r in known.distinct().collect()})

    def speed_text(self) -> str:
        return f"{self.max_travel_speed_kmh:g}"
