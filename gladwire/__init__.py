"""gladwire: curation of news articles as Spark DataFrame jobs."""
