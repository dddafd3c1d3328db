"""Text preparation, ranking and classification as Spark DataFrame jobs."""
