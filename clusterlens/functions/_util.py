from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or_lit(c) -> Column:
    """A Column as is, a str as a column name."""
    return c if isinstance(c, Column) else F.col(c)
