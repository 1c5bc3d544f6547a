"""Column helpers shared by the operators that stay in DataFrame expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space (space, \t, \n, \v, \f, \r).
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def space_word_count(text: Column) -> Column:
    """Number of white-space separated words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on columns of the same name in which null equals null; the left side's keys are kept."""
    side = right.select(*[named(c).alias(f"__r_{c}") if c in on else named(c) for c in right.columns])
    cond = None
    for c in on:
        one = named(c).eqNullSafe(named(f"__r_{c}"))
        cond = one if cond is None else cond & one
    return left.join(side, cond, how).drop(*[f"__r_{c}" for c in on])


def fresh(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so (case-insensitive)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
