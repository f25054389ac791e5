"""Cinema box-office analytics as Spark DataFrame jobs."""
