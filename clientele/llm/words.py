"""Words and small expression helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of characters other than these six.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN)),
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def total(values: Column) -> Column:
    """Sum of an array of integers."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
