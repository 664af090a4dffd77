"""Statistical tables and large text corpora as ordinary Spark jobs."""
