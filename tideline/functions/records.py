"""Aggregates that pick a whole record of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _place(order: Sequence[str]) -> Column:
    """A plain column where it will do: structs keep Spark from aggregating in a hash table."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def first_record(order: Sequence[str], fields: Sequence[str], name: str) -> Column:
    """The earliest record of the group, as a struct. `order` is unique within the group."""
    at = _place(order)
    return F.struct(*[F.min_by(f, at).alias(f) for f in fields]).alias(name)


def last_record(order: Sequence[str], fields: Sequence[str], name: str) -> Column:
    """The latest record of the group, as a struct. `order` is unique within the group."""
    at = _place(order)
    return F.struct(*[F.max_by(f, at).alias(f) for f in fields]).alias(name)


def lowest_record(value: str, order: Sequence[str], fields: Sequence[str], name: str) -> Column:
    """The record with the lowest value, the earliest on ties, as a struct; null without values."""
    place = F.when(F.col(value).isNotNull(), F.struct(value, *order))
    return F.min_by(F.struct(*fields), place).alias(name)
