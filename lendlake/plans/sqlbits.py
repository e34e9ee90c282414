"""Small SQL-text helpers for writing the DuckDB twins."""

from __future__ import annotations


def mean(x: str) -> str:
    """Double mean of an exact sum, the same formula the Spark side uses."""
    return f"(CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0))"


def rate(flag: str) -> str:
    return mean(f"CAST({flag} AS INTEGER)")


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0))"


def median(x: str) -> str:
    """Median of a decimal(12,2) expression (midpoint truncated toward zero), as double."""
    return f"CAST(median({x}) AS DOUBLE)"
