"""Predicates used by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_safe_contains(items: Column | str, value: Column | str) -> Column:
    """True when ``items`` holds ``value``; a null value is found when the list holds null.

    ``array_contains`` would give NULL for a null value; list membership by ``equals`` does not.
    A null list gives NULL (treated as false by a filter).
    """
    items = F.col(items) if isinstance(items, str) else items
    value = F.col(value) if isinstance(value, str) else value
    return F.exists(items, lambda x: x.eqNullSafe(value))
