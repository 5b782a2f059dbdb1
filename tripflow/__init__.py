"""Trip data from raw files to a weekly report, on Spark."""

from tripflow.session import get_session

__all__ = ["get_session"]
