"""Change tables: one partitioned dataset, or catalog tables."""
