"""Grade ladders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume.functions.text import as_col

# Fixed values: (lower bound, label) from high to low, then the label below all.
TECHNOLOGY = ((100, "Alto"), (30, "Médio"))
TECHNOLOGY_FLOOR = "Baixo"
CAPACITY = ((50, "Alta"), (15, "Média"), (1, "Baixa"))
CAPACITY_FLOOR = "Sem cobertura"
# Upper bounds of the absolute variation in percent.
ACCURACY = ((5, "Excelente (≤5%)"), (15, "Boa (5–15%)"), (30, "Regular (15–30%)"))
ACCURACY_CEILING = "Fraca (>30%)"
ACCURACY_LABELS = tuple(label for _, label in ACCURACY) + (ACCURACY_CEILING,)


def grade_at_least(c: str | Column, ladder: Sequence[tuple[float, str]], floor: str) -> Column:
    """Label of the first bound the value reaches."""
    c = as_col(c)
    rungs = [F.when(c >= bound, label) for bound, label in ladder]
    return F.coalesce(*rungs, F.when(c.isNotNull(), floor))


def technology_grade(c: str | Column, ladder=TECHNOLOGY) -> Column:
    return grade_at_least(c, ladder, TECHNOLOGY_FLOOR)


def capacity_grade(c: str | Column, ladder=CAPACITY) -> Column:
    return grade_at_least(c, ladder, CAPACITY_FLOOR)


def estimate_accuracy(variation: str | Column, ladder=ACCURACY) -> Column:
    """Label for a variation in percent; null stays null."""
    size = F.abs(as_col(variation))
    rungs = [F.when(size <= bound, label) for bound, label in ladder]
    return F.coalesce(*rungs, F.when(size.isNotNull(), ACCURACY_CEILING))
