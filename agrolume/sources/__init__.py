"""Readers for the raw files, and one cleaning and loading job per source."""
