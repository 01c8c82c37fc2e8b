"""Monthly valuation of short-term insurance reserves as Spark DataFrame transforms."""

from remanente.config import RunConfig

__all__ = ["RunConfig"]
