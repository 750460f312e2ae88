"""marketflow: marketplace report loading and analysis, written for Spark."""

__all__ = ["functions", "operators", "plans", "sinks", "sources", "streaming"]
