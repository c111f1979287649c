"""Text analysis, the query language, and matching and scores as column expressions."""
