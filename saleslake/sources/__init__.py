"""Reading and writing: delimited feed, Parquet layers, catalog, scratch tables."""
