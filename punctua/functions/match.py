"""Text predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column


def full_match(value: Column, pattern: str) -> Column:
    """The whole text matches, as ``SIMILAR TO`` does; ``rlike`` alone only finds."""
    return value.rlike(rf"^(?:{pattern})\z")


def any_of(value: Column, choices: Iterable[str]) -> Column:
    return value.isin(list(choices))


def none_of(value: Column, choices: Iterable[str]) -> Column:
    """Not in the list; a NULL value is dropped, as in SQL."""
    return ~value.isin(list(choices))
