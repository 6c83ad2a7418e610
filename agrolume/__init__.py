"""Agricultural open data on Spark: readers, cleaners, key resolution,
idempotent star-schema loads and cross-fact questions, all as DataFrames."""
