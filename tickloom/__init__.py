"""tickloom: market-tick analytics written as Spark DataFrame, SQL, streaming and ML jobs."""
