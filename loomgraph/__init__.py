"""Records to semantic graphs, and training-data preparation, as Spark jobs."""
