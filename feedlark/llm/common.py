"""Words and keys that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[\x20\x09-\x0D]+"  # between the words of statistics and shingles


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def pieces(text: Column, between: str) -> Column:
    """The non-empty parts of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between, -1), "")


def shield(df: DataFrame, *needed: str) -> tuple[DataFrame, dict[str, str]]:
    """`df` with the columns that an operator does not need under names that clash with nothing."""
    names = {c: f"__{i}__{c}" for i, c in enumerate(df.columns) if c not in needed}
    return df.withColumnsRenamed(names), names


def unshield(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The old names; an input column of the name of an added one is replaced by that."""
    added = {c.lower() for c in df.columns} - {hidden.lower() for hidden in names.values()}
    lost = [hidden for c, hidden in names.items() if c.lower() in added]
    return df.drop(*lost).withColumnsRenamed({hidden: c for c, hidden in names.items() if hidden not in lost})


def small(df: DataFrame, most: int) -> DataFrame:
    """A stored table marked for broadcast if it has at most `most` rows, else as it is; what follows
    must be right, and not collect anything, either way."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
