"""Independent SQL for every registered query, over the same Parquet tables."""
