"""Operators over DataFrames: dedupe, lookups, reshaping, ranking, storage, checks."""
