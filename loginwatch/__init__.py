"""Authentication threat hunting as Spark DataFrame jobs.

Every operator takes DataFrames plus a typed configuration and returns a lazy
DataFrame. Sessions are expected to run with ``spark.sql.session.timeZone=UTC``.
"""

from loginwatch.config import HuntConfig, MissingConfigKey

__all__ = ["HuntConfig", "MissingConfigKey"]
