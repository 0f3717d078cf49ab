"""Training-data operators: one module each, plus ``queries`` (the registered opN queries and their SQL)."""
