"""Several rows out of one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_array(names: Sequence[str], *rows: Sequence[Column]) -> Column:
    """An array of structs, one per row, with the same field names in each."""
    return F.array(*[F.struct(*[c.alias(n) for n, c in zip(names, row)]) for row in rows])


def inline_rows(names: Sequence[str], *rows: Sequence[Column]) -> Column:
    """Generator of one output row per given row."""
    return F.inline(row_array(names, *rows))
