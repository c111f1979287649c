"""Search analytics on PySpark: full-text predicates, relevance scores and bucket aggregations as DataFrame plans."""
