"""Column expressions shared by the operators. All of them stay in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted_column(name: str) -> Column:
    """Refer to a column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_guard(text: Column, data_type: str) -> Column:
    """Digits-only text as ``data_type``; anything else, overflow included, is null.

    Only spaces are trimmed. ``try_cast`` is needed because sessions run in ANSI mode,
    where a plain cast of an out-of-range number is an error.
    """
    trimmed = F.trim(text)
    return F.when(trimmed.rlike("^[0-9]+$"), trimmed.try_cast(data_type))


def count_when(condition: Column) -> Column:
    """Number of rows for which ``condition`` is true, 0 on empty input."""
    return F.count_if(condition)


def format_offsets(offsets: Column) -> Column:
    """``array<bigint>`` as ``[1,2,3]``; an empty array is ``[]``."""
    return F.concat(F.lit("["), F.array_join(offsets.cast("array<string>"), ","), F.lit("]"))
