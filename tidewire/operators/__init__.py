"""DataFrame operators: preparing, classifying, joining, counting, series, recency, archiving."""
