"""Text retrieval, ranking and evaluation as Spark DataFrame jobs."""
