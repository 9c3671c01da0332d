"""barloom: market-bar analytics written as Spark DataFrame jobs."""
