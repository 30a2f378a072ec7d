"""Cloud-spend analytics on Spark: landing, staging, marts, reports and checks."""

from spendlake.settings import Settings, prepare_session

__all__ = ["Settings", "prepare_session"]
