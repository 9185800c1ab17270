"""Labels for ranges. Boundaries and labels are fixed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def statement_bucket(n: Column) -> Column:
    """Number of statements sent; fractions between the ranges have no label."""
    return (
        F.when(n < 3, "less than 3 statements")
        .when(n.between(3, 4), "3-4 statements")
        .when(n.between(5, 6), "5-6 statements")
        .when(n > 6, "over 6 statements")
    )


def hold_age_bucket(days: Column) -> Column:
    """Days on hold; 15 days already belong to the fourth range."""
    return (
        F.when(days <= 5, "0-5 days")
        .when(days <= 10, "6-10 days")
        .when(days < 15, "11-14 days")
        .when(days <= 21, "15-21 days")
        .when(days <= 30, "22-30 days")
        .when(days <= 45, "31-45 days")
        .when(days <= 60, "46-60 days")
        .when(days <= 90, "61-90 days")
        .when(days > 90, "over 90 days")
    )
