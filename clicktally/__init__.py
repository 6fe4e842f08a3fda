"""Click and conversion statistics as Spark DataFrame jobs."""
