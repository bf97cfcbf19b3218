"""Rounding that does not depend on the order in which doubles were added up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_stable(value: Column, digits: int) -> Column:
    """Round half away from zero, on the value's decimal form.

    A sum of doubles changes in its last bits with the order of its rows, which a retried
    task changes too, and at a tie that noise flips the rounded result. Going through nine
    decimal places first absorbs it. Values a decimal cannot hold (NaN, infinity, 1e19 and
    more) are rounded as doubles.
    """
    exact = F.round(value.try_cast("decimal(28,9)"), digits).cast("double")
    return F.coalesce(exact, F.round(value, digits))
