"""A Spark engine for source-grounded knowledge tables and training corpora."""
