"""Reading vector columns without making sparse ones dense."""

from pyspark.sql import Column, functions as F


def vector_sum(name: str) -> Column:
    return F.aggregate(F.unwrap_udt(name)["values"], F.lit(0.0), lambda a, x: a + x)


def sparse_entries(name: str) -> Column:
    """The entries of a sparse vector as an array of ``(slot, value)``."""
    parts = F.unwrap_udt(name)
    return F.arrays_zip(parts["indices"].alias("slot"), parts["values"].alias("value"))
