"""Column functions: text, numbers, dates, grades.  Built-in expressions only."""

from agrolume.functions.dates import day, month_label, parse_date, year_of
from agrolume.functions.grading import (
    ACCURACY_LABELS,
    capacity_grade,
    estimate_accuracy,
    grade_at_least,
    technology_grade,
)
from agrolume.functions.numbers import (
    crop_year_start,
    int_coerce,
    nonzero,
    parse_number,
    to_int_or_zero,
    to_number,
    to_number_or_zero,
)
from agrolume.functions.text import (
    NULL_TOKENS,
    STRICT_NULL_TOKENS,
    classify_setor,
    clean_text,
    code7,
    fold,
    fold_crop,
    fold_header,
    null_tokens,
    replace_values,
    snake_columns,
    split_name,
    strip,
    trim_all,
    uf_from_json,
)

__all__ = [n for n in dir() if not n.startswith("_")]
