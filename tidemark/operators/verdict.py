"""Pass or fail, decided on a one-row frame of counters.

The row holds ``invalid_row_count``, ``raw_gap_partition_count`` and ``side_topic_enabled``,
and with side topics ``unresolved_count``, ``bounded_unresolved_count``,
``bounded_missing_offset_count`` and ``missing_offsets_truncated``.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import InputError
from tidemark.functions.frames import one_row

# The texts of the reasons and messages, with their counters in braces.
INVALID_ROWS = "invalid metadata rows detected: invalid_row_count={invalid_row_count}"
RAW_GAPS = "offset gaps detected: gap_partition_count={raw_gap_partition_count}"
UNRESOLVED = (
    "unresolved offset gaps after side-topic reconciliation: raw_gap_partition_count={raw_gap_partition_count}"
    " unresolved_count={unresolved_count}"
)
TRUNCATED = (
    "missing offsets truncated after side-topic reconciliation: unresolved offsets may remain beyond materialized limit"
    "; raw_gap_partition_count={raw_gap_partition_count} bounded_missing_offset_count={bounded_missing_offset_count}"
    " missing_offsets_truncated={missing_offsets_truncated} unresolved_count={unresolved_count}"
)
NO_GAPS = "no gaps detected"
ALL_RESOLVED = "side-topic reconciliation resolved all bounded missing offsets"
# Own texts: what a run says that passes only because gaps are allowed.
GAPS_ALLOWED = "offset gaps detected but fail_on_gaps=false"
UNRESOLVED_ALLOWED = "unresolved offsets present but fail_on_gaps=false"

SIDE_TOPIC_COUNTERS = {
    "canary_explained_count": "bigint",
    "dead_letter_explained_count": "bigint",
    "unresolved_count": "bigint",
    "total_missing_offset_count": "bigint",
    "bounded_unresolved_count": "bigint",
    "bounded_missing_offset_count": "bigint",
    "missing_offsets_truncated": "boolean",
}


def check_flag(value, name: str) -> bool:
    """A boolean, or the text of one."""
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise InputError(f"{name} must be true or false: {value!r}")
    return text == "true"


def _filled(text: str) -> Column:
    """A text with the counters of the row in place of the names in braces."""
    parts = re.split(r"\{(\w+)\}", text)
    return F.concat(*(F.col(part).cast("string") if i % 2 else F.lit(part) for i, part in enumerate(parts)))


def gap_failure_reason(fail_on_gaps: bool = True) -> Column:
    """Why gaps fail the check, or null if they do not.

    With side topics, a listing that an explicit limit cuts short fails even if all listed
    offsets are explained.
    """
    gaps = F.col("raw_gap_partition_count")
    side = F.col("side_topic_enabled")
    if not fail_on_gaps:
        return F.lit(None).cast("string")
    return (
        F.when(gaps == 0, F.lit(None).cast("string"))
        .when(~side, _filled(RAW_GAPS))
        .when(F.col("bounded_unresolved_count") > 0, _filled(UNRESOLVED))
        .when(F.col("missing_offsets_truncated"), _filled(TRUNCATED))
    )


def invalid_rows_reason(fail_on_invalid_rows: bool = True) -> Column:
    """Why invalid metadata rows fail the check, or null if they do not."""
    invalid = F.col("invalid_row_count")
    if not fail_on_invalid_rows:
        return F.lit(None).cast("string")
    return F.when(invalid > 0, _filled(INVALID_ROWS))


def pass_message_text(fail_on_gaps: bool = True) -> Column:
    """What a passing run says.

    A run that passes only because gaps are allowed says so, also when side topics leave
    offsets unresolved or beyond the limit.
    """
    gaps = F.col("raw_gap_partition_count") > 0
    side = F.col("side_topic_enabled")
    unsettled = (F.col("unresolved_count") > 0) | F.col("missing_offsets_truncated")
    return (
        F.when(gaps & side & unsettled, UNRESOLVED_ALLOWED)
        .when(gaps & side, ALL_RESOLVED)
        .when(gaps & F.lit(not fail_on_gaps), GAPS_ALLOWED)
        .otherwise(NO_GAPS)
    )


def gap_verdict(facts: DataFrame, fail_on_gaps: bool = True) -> DataFrame:
    reason = gap_failure_reason(fail_on_gaps)
    return facts.select(reason.isNotNull().alias("failed"), reason.alias("reason"))


def invalid_rows_verdict(facts: DataFrame, fail_on_invalid_rows: bool = True) -> DataFrame:
    reason = invalid_rows_reason(fail_on_invalid_rows)
    return facts.select(reason.isNotNull().alias("failed"), reason.alias("reason"))


def pass_message(facts: DataFrame, fail_on_gaps: bool = True) -> DataFrame:
    return facts.select(pass_message_text(fail_on_gaps).alias("pass_message"))


def final_verdict(facts: DataFrame, fail_on_gaps: bool = True, fail_on_invalid_rows: bool = True) -> DataFrame:
    """One row: ``code`` 0 or 1, the ``reason`` (invalid rows first), and the counters."""
    reasons = F.array_compact(F.array(invalid_rows_reason(fail_on_invalid_rows), gap_failure_reason(fail_on_gaps)))
    failed = F.size(reasons) > 0
    return facts.select(
        F.when(failed, 1).otherwise(0).alias("code"),
        F.when(failed, F.array_join(reasons, "; ")).otherwise(pass_message_text(fail_on_gaps)).alias("reason"),
        F.lit(fail_on_gaps).alias("fail_on_gaps"),
        "invalid_row_count",
        "raw_gap_partition_count",
        "side_topic_enabled",
        *SIDE_TOPIC_COUNTERS,
    )


def verdict_facts(*frames: DataFrame, side_topic_enabled: bool) -> DataFrame:
    """The counters of several one-row frames as the row the verdicts read."""
    facts = one_row(*frames).withColumn("side_topic_enabled", F.lit(side_topic_enabled))
    absent = {name: F.lit(None).cast(kind) for name, kind in SIDE_TOPIC_COUNTERS.items() if name not in facts.columns}
    return facts.withColumns(absent) if absent else facts
