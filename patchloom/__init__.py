"""Pull request curation for hardware repositories, as Spark DataFrame jobs."""
