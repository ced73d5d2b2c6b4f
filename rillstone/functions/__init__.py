"""Column expressions shared by the operators; all are built-in Spark functions."""

from rillstone.functions.conditions import CONDITIONS, classify_condition
from rillstone.functions.measures import safe_ratio, whole_mean
from rillstone.functions.text import iso_utc, row_text

__all__ = [
    "CONDITIONS",
    "classify_condition",
    "iso_utc",
    "row_text",
    "safe_ratio",
    "whole_mean",
]
