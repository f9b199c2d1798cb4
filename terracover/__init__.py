"""Per-pixel land-cover analytics as Spark DataFrame jobs."""
