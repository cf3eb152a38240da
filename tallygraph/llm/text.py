"""Columns and small string helpers that the text operators share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of every text rule here, and the letters it folds.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def without_white(text: Column) -> Column:
    """The text without any white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def fold_case(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def split_lines(text: Column) -> Column:
    """The lines of a text; null or empty gives one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of a table in one struct, so that no new column can clash with them."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], replace: dict[str, Column], name: str = "row") -> DataFrame:
    """The columns that ``packed`` put away, some of them replaced."""
    return df.select(
        *[(replace[c] if c in replace else F.col(name)[c]).alias(c) for c in columns]
    )
