"""First-match categories: an ordered list of rules, the first true one names the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[Column, Column | str]], default: Column | str | None) -> Column:
    """``CASE WHEN rule THEN label ... ELSE default``; a null condition does not match."""
    named = [F.when(condition, label) for condition, label in rules]
    return F.coalesce(*named, default if isinstance(default, Column) else F.lit(default))
