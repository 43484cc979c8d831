"""Directory quality and corpus preparation as Spark jobs."""
