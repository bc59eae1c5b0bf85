"""Access-log and file-catalog analytics as PySpark DataFrame jobs."""

from accesslake.session import get_session

__all__ = ["get_session"]
