"""Deterministic ledgers in the landed layout, of any size.

Rows are expressions over an id column, so Spark generates them in parallel:
``spark.range(n)`` gives a ledger of n records, and any table with a dense id gives one of
its own size.
"""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import InputError
from tidemark.operators.metadata import DEFAULT_METADATA_COLUMN
from tidemark.sources.discovery import DEFAULT_DATE_COLUMN

COLUMN_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def check_column_names(names) -> None:
    """Names must be plain identifiers and must differ."""
    names = list(names)
    for name in names:
        if not COLUMN_NAME.fullmatch(name):
            raise InputError(f"invalid column name: {name!r}")
    if len(set(names)) != len(names):
        raise InputError(f"column names clash: {names}")


def synth_ledger(
    ids: DataFrame,
    id_column: str = "id",
    partitions: int = 4,
    topic: str = "orders",
    first_date: str = "2026-07-01",
    ids_per_date: int = 1_000_000,
    lost_every: int | None = None,
    duplicate_every: int | None = None,
    corrupt_every: int | None = None,
    payload: bool = True,
    extra: dict | None = None,
    metadata_column: str = DEFAULT_METADATA_COLUMN,
    date_column: str = DEFAULT_DATE_COLUMN,
) -> DataFrame:
    """Ledger rows: metadata text, topic, optional payload, extra text columns, and the date.

    Id ``i`` becomes offset ``i div partitions`` of partition ``i % partitions``. Of the ids
    that are a multiple of the given numbers, ``lost_every`` drops them, ``duplicate_every``
    lands them twice and ``corrupt_every`` lands broken JSON instead.
    """
    extra = dict(extra or {})
    check_column_names([metadata_column, date_column, "topic", *(["payload"] if payload else []), *extra])
    i = F.col(id_column).cast("bigint")

    def every(n):
        return (i % n == 0) if n else F.lit(False)

    offset = F.expr(f"`{id_column}` div {partitions}").cast("string")
    text = F.concat(
        F.lit('{"partition":'), (i % partitions).cast("string"), F.lit(',"offset":'), offset, F.lit("}")
    )
    copies = F.when(every(duplicate_every), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    day = F.expr(f"cast(`{id_column}` div {ids_per_date} as int)")
    columns = [F.when(every(corrupt_every), "{bad-json").otherwise(text).alias(metadata_column)]
    columns.append(F.lit(topic).alias("topic"))
    if payload:
        columns.append(F.concat(F.lit("payload-"), i.cast("string")).alias("payload"))
    columns += [F.lit(value).alias(name) for name, value in extra.items()]
    columns.append(F.date_add(F.lit(first_date).cast("date"), day).alias(date_column))
    landed = ids.filter(~every(lost_every)).select("*", F.explode(copies).alias("_copy"))
    return landed.select(*columns)


def write_ledger(ledger: DataFrame, root: str, date_column: str = DEFAULT_DATE_COLUMN) -> None:
    """Write a ledger as ``<root>/<date_column>=<date>/*.parquet``."""
    ledger.write.mode("overwrite").partitionBy(date_column).parquet(root)
