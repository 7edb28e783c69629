"""Review analytics expressed as composable Spark DataFrame jobs."""
