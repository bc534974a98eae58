"""blockloom: training-corpus preparation and analysis as Spark DataFrame jobs."""

from blockloom.session import build_session

__all__ = ["build_session"]
