"""Column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column called exactly ``name``, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def any_null(columns: list[str]) -> Column:
    """True where at least one of ``columns`` is null."""
    return reduce(lambda left, right: left | right, [named(c).isNull() for c in columns])


def json_key(columns: list[str]) -> Column:
    """The key columns as one JSON object; null members are left out of it."""
    return F.to_json(F.struct(*[named(c) for c in columns]))
