"""Statistics, checks and serving tables of water-planning scenarios as Spark DataFrame jobs."""
