"""Message indexing and ranked search as Spark jobs."""
