"""Rate-series and web-capture analytics as Spark DataFrame jobs."""
