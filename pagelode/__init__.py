"""Search, ranking and link analysis over a page corpus, as Spark DataFrame jobs."""
