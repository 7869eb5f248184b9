"""tierlake: medallion analytics (raw CSV -> Silver -> Gold -> quality) on Spark."""

__version__ = "0.1.0"
