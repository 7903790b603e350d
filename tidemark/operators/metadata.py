"""Metadata text to ``(partition, offset)`` rows, and a profile of the rows that fail."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import InputError
from tidemark.functions import count_when, numeric_guard, quoted_column
from tidemark.operators.sequences import pack_sequences

# Fixed value: the metadata column landed by the source connector.
DEFAULT_METADATA_COLUMN = "cactus__metadata"

CORRUPT = "_tidemark_corrupt_json"
METADATA_SCHEMA = T.StructType(
    [
        T.StructField("partition", T.StringType()),
        T.StructField("offset", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# The two fields as plain numbers and nothing else, which is how metadata mostly looks. Numbers
# of more than 18 digits go to the parser, which has a limit of its own for them.
PLAIN = r'^\{"partition": ?(0|[1-9][0-9]{0,17}), ?"offset": ?(0|[1-9][0-9]{0,17})\}\z'

# The names of the defects and counters. Bit of each defect in the ``defects`` mask of a row.
DEFECTS = {
    "missing_metadata": 1,
    "malformed_json": 2,
    "missing_partition": 4,
    "missing_offset": 8,
    "non_numeric_partition": 16,
    "non_numeric_offset": 32,
}

PROFILE_COLUMNS = [
    "eligible_row_count",
    *(f"{name}_count" for name in DEFECTS),
    "invalid_row_count",
    "valid_offset_row_count",
]


@dataclass(frozen=True)
class Parsed:
    """Column names of a parsed frame; underscores keep clear of the caller's columns."""

    raw: str = "_raw"
    json: str = "_json"
    partition_text: str = "_partition_text"
    offset_text: str = "_offset_text"
    partition: str = "_partition"
    offset: str = "_offset"


P = Parsed()


def parse_metadata(df: DataFrame, metadata_column: str = DEFAULT_METADATA_COLUMN, keep=()) -> DataFrame:
    """Parse the metadata text: its raw and trimmed parts, and the numbers they hold.

    Both fields are read as strings, so that a wrong type shows as a non-numeric value and
    not as malformed JSON. The parse sits behind ``explode`` of a one-element array, which
    keeps later filters from copying it: each row is parsed once. The JSON parser is the
    dearest step of a whole check, so texts of the plain form are cut apart without it.
    """
    if metadata_column not in df.columns:
        raise InputError(f"column '{metadata_column}' not found in the landed data")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    raw = quoted_column(metadata_column).cast("string")
    plain = F.struct(
        F.substring_index(F.substring_index(P.raw, ",", 1), ":", -1).alias("partition"),
        F.rtrim(F.substring_index(P.raw, ":", -1), F.lit("}")).alias("offset"),
        F.lit(None).cast("string").alias(CORRUPT),
    )
    parsed = F.when(F.col(P.raw).rlike(PLAIN), plain).otherwise(
        F.from_json(F.col(P.raw), METADATA_SCHEMA, options)
    )
    partition_text, offset_text = F.trim(F.col(f"{P.json}.partition")), F.trim(F.col(f"{P.json}.offset"))
    return (
        df.select(raw.alias(P.raw), *keep)
        .withColumn(P.json, parsed)
        .select(P.raw, *keep, F.explode(F.array(P.json)).alias(P.json))
        .select(
            "*",
            partition_text.alias(P.partition_text),
            offset_text.alias(P.offset_text),
            numeric_guard(partition_text, "int").alias(P.partition),
            numeric_guard(offset_text, "bigint").alias(P.offset),
        )
    )


# -- row predicates over a parsed frame ------------------------------------------------------


def is_missing_metadata() -> Column:
    return F.col(P.raw).isNull()


def is_malformed_json() -> Column:
    return F.col(P.raw).isNotNull() & (F.col(P.json).isNull() | F.col(f"{P.json}.{CORRUPT}").isNotNull())


def _well_formed() -> Column:
    return F.col(P.raw).isNotNull() & F.col(P.json).isNotNull() & F.col(f"{P.json}.{CORRUPT}").isNull()


def is_missing_partition() -> Column:
    return _well_formed() & F.col(P.partition_text).isNull()


def is_missing_offset() -> Column:
    return _well_formed() & F.col(P.offset_text).isNull()


def is_non_numeric_partition() -> Column:
    return _well_formed() & F.col(P.partition_text).isNotNull() & F.col(P.partition).isNull()


def is_non_numeric_offset() -> Column:
    return _well_formed() & F.col(P.offset_text).isNotNull() & F.col(P.offset).isNull()


def is_valid() -> Column:
    return _well_formed() & F.col(P.partition).isNotNull() & F.col(P.offset).isNotNull()


def is_invalid() -> Column:
    return ~is_valid()


def _conditions() -> dict:
    return {
        "missing_metadata": is_missing_metadata(),
        "malformed_json": is_malformed_json(),
        "missing_partition": is_missing_partition(),
        "missing_offset": is_missing_offset(),
        "non_numeric_partition": is_non_numeric_partition(),
        "non_numeric_offset": is_non_numeric_offset(),
    }


def defect_mask() -> Column:
    """All defects of a row as one integer, 0 for a valid row. A row may have two."""
    bits = [F.when(condition, DEFECTS[name]).otherwise(0) for name, condition in _conditions().items()]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    return mask


# -- profile, normalized rows, packed ledger --------------------------------------------------


def _counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("eligible_row_count"),
        *(count_when(condition).alias(f"{name}_count") for name, condition in _conditions().items()),
        count_when(is_invalid()).alias("invalid_row_count"),
        count_when(is_valid()).alias("valid_offset_row_count"),
    ]


def metadata_quality(parsed: DataFrame) -> DataFrame:
    """One row of counters. The defect counts may add up to more than the invalid rows."""
    return parsed.agg(*_counters())


def observed_quality(parsed: DataFrame) -> tuple[DataFrame, Observation]:
    """``parsed`` with the counters of ``metadata_quality`` observed by the first job that reads it."""
    profile = Observation()
    return parsed.observe(profile, *_counters()), profile


def quality_frame(spark: SparkSession, counters: dict) -> DataFrame:
    """Observed counters as the one-row frame of ``metadata_quality``."""
    return spark.range(1).select(*(F.lit(counters[name]).cast("bigint").alias(name) for name in PROFILE_COLUMNS))


def normalize_offsets(parsed: DataFrame, source_file: str | None = None) -> DataFrame:
    """The valid rows as ``partition, offset, metadata_json, source_file``."""
    source = F.col(source_file) if source_file else F.lit(None).cast("string")
    return parsed.filter(is_valid()).select(
        F.col(P.partition).alias("partition"),
        F.col(P.offset).alias("offset"),
        F.col(P.raw).alias("metadata_json"),
        source.alias("source_file"),
    )


def pack_ledger(parsed: DataFrame) -> DataFrame:
    """One aggregation that keeps all that the profile and the gap analysis need.

    Valid rows are packed per partition and word; invalid rows are counted per defect mask
    under a null partition. One scan and one parse of the landed data thus serve every
    later step. Columns: ``partition, word, defects, row_count, bits``.
    """
    valid = is_valid()
    rows = parsed.select(
        F.when(valid, F.col(P.partition)).alias("partition"),
        F.when(valid, F.col(P.offset)).alias("offset"),
        defect_mask().alias("defects"),
    )
    return pack_sequences(rows, by=["defects"])


def ledger_quality(ledger: DataFrame) -> DataFrame:
    """The profile of ``metadata_quality``, from a packed ledger."""

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("row_count"))), F.lit(0))

    return ledger.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("eligible_row_count"),
        *(
            rows_where(F.col("defects").bitwiseAND(F.lit(bit)) != 0).alias(f"{name}_count")
            for name, bit in DEFECTS.items()
        ),
        rows_where(F.col("defects") != 0).alias("invalid_row_count"),
        rows_where(F.col("defects") == 0).alias("valid_offset_row_count"),
    )


def ledger_words(ledger: DataFrame) -> DataFrame:
    """The packed sequences of the valid rows of a ledger."""
    return ledger.filter("defects = 0").select("partition", "word", "row_count", "bits")


def input_guards(quality: DataFrame) -> DataFrame:
    """The profile as pass/fail facts about the input."""
    return quality.select(
        (F.col("eligible_row_count") > 0).alias("has_rows"),
        (F.col("valid_offset_row_count") > 0).alias("has_valid_rows"),
    )


def require_valid_rows(quality_row) -> None:
    """Raise for a profile row of an input that cannot be checked."""
    if quality_row["eligible_row_count"] == 0:
        raise InputError("the landed data has zero rows")
    if quality_row["valid_offset_row_count"] == 0:
        raise InputError("zero valid rows: no landed row has a usable partition and offset")
