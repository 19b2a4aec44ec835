"""Plans: the batch pipeline and the query registry (Spark and SQL oracle)."""
