"""eventsieve: event quality, risk scoring and BI export as Spark jobs."""

__version__ = "0.1.0"
