"""sackcast: Spark-first monthly demand planning (panel, ABC/XYZ/FSN segments,
18-month quantile forecast, partitioned sink, monitoring)."""

__version__ = "0.1.0"
