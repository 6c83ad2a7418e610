"""The operators, jobs and questions run over the test tables, each beside the SQL
that gives the same answer.

The test tables hold orders and parts, not harvests; ``views`` reshapes them into
the raw files and the star schema this package works on.
"""

from agrolume.checks import files, jobs, operators, questions, stored, values
from agrolume.checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "files", "jobs", "operators", "questions", "stored", "values"]
