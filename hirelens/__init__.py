"""Labour-market analytics expressed as Spark DataFrame, SQL, streaming and ML jobs."""
