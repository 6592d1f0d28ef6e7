"""Record coverage and quality analytics, written as Spark DataFrame jobs."""
