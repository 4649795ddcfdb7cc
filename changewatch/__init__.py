"""changewatch: review analytics over wiki recent changes, written as Spark jobs."""

from changewatch.config import Settings

__all__ = ["Settings"]
