"""Names for helper columns that a caller's table does not use yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free(docs: DataFrame, *wanted: str) -> list[str]:
    """Each wanted name, with underscores in front until no column of ``docs`` (compared
    without case, as Spark does) and no name before it is the same."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
