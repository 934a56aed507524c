"""Review-text analytics as Spark DataFrame jobs."""
