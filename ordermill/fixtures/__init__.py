"""Order data derived from the given test tables, for Spark and as SQL for the check engine."""
