"""Training-data operators: deduplication, scoring, filtering and tokenising of whole corpora."""
