"""Operators for training-data corpora, each built by one stated method.

Every module holds one operator with its own general interface; ``queries`` holds the
thin queries over the test tables.  Nothing outside this package imports it.
"""
