"""Gap analysis of integer sequences per key, for example Kafka offsets per partition.

Every operator starts from the *packed* form of a sequence: one row per key and per word of
``WORD`` consecutive values, with a bit for each value seen. Packing is an ordinary
aggregation, so repeated values collapse before the shuffle, a dense sequence shrinks to a
fraction of its rows, and a sparse one never grows.

Order within a key is needed to see gaps, but one key may hold most of the data, so no
window ever spans a whole key of values. The value range is cut into three levels of fixed
ranges (word in bucket, bucket in zone, zone in key); each window covers the children of one
range, which bounds it by the ranges themselves and not by the data:

    words per bucket <= 2**15, buckets per zone <= 2**20, zones per key <= 2**24

Only one summary row per range moves up a level. Where values lie so far apart that a bucket
holds hardly more than one word, its summary saves nothing; such a zone is one bucket, as long
as it has no more than ``SPARSE_WORDS`` words. That is decided per zone from its counts.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import InputError
from tidemark.functions import format_offsets

WORD_SHIFT = 5
WORD = 1 << WORD_SHIFT
BUCKET_SHIFT = 15
ZONE_SHIFT = 20
#: A zone is one bucket if its buckets would hold fewer words than this on average, ...
SPARSE_FILL = 64
#: ... and it has at most so many in all.
SPARSE_WORDS = 1 << 20
#: Zones to be cut into buckets are marked by hash in so many places. A zone that shares the
#: place of another is cut as well, which is right for every zone.
ZONE_MARKS = 1 << 12
# A listed gap is cut into runs of these lengths, one level after the other, so that no array
# grows with the gap. Runs of the last length but one are spread over the tasks.
RUNS = (1 << 46, 1 << 36, 1 << 26)
INNER_RUN = 1 << 13
STREAMS = 1 << 20
#: Listed values to a row of a report.
LIST_PART = 1 << 13

MAX_LIMIT = 1 << 62
DEFAULT_MISSING_LIMIT = None


# -- packed form ---------------------------------------------------------------------------


def pack_sequences(df: DataFrame, key: str = "partition", seq: str = "offset", by=()) -> DataFrame:
    """One row per ``key`` and word of values: ``(key, word, *by, row_count, bits)``.

    ``by`` adds grouping columns. Rows without a value get word 0 and null ``bits``, so that
    they can still be counted. ``word`` is never null: a nullable one would make the planner
    add a different null check for each use of the packed form, and then the uses could not
    share one shuffle.
    """
    value = F.col(seq).cast("bigint")
    word = F.coalesce(offset_word(value), F.lit(0))
    return (
        df.select(F.col(key), word.alias("word"), *by, offset_bit(value).alias("bit"))
        .groupBy(key, "word", *by)
        .agg(F.count(F.lit(1)).alias("row_count"), F.bit_or("bit").alias("bits"))
    )


def offset_word(value: Column) -> Column:
    """The word of a value."""
    return F.shiftright(value, WORD_SHIFT)


def offset_bit(value: Column) -> Column:
    """The bit of a value within its word."""
    return _lone_bit(value.bitwiseAND(F.lit(WORD - 1)).cast("int"))


def range_bits(word: Column, first: Column, last: Column) -> Column:
    """The bits of a word whose values lie between ``first`` and ``last``, ends included."""
    low = F.when(offset_word(first) < word, 0).when(offset_word(first) == word, first.bitwiseAND(F.lit(WORD - 1)))
    high = F.when(offset_word(last) > word, WORD - 1).when(offset_word(last) == word, last.bitwiseAND(F.lit(WORD - 1)))
    bits = _lone_bit((high + 1).cast("int")) - _lone_bit(low.cast("int"))
    return F.coalesce(bits, F.lit(0).cast("bigint"))


def _pack(df: DataFrame, key: str, seq: str) -> DataFrame:
    return pack_sequences(df.filter(F.col(key).isNotNull() & F.col(seq).isNotNull()), key, seq)


def _lone_bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def _low_bit(bits: Column) -> Column:
    """Position of the lowest set bit."""
    return F.bit_count(bits.bitwiseAND(-bits) - 1)


def _high_bit(bits: Column) -> Column:
    """Position of the highest set bit; the half keeps the logarithm off whole numbers."""
    return F.floor(F.log2(bits + F.lit(0.5))).cast("int")


def _base() -> Column:
    return F.shiftleft(F.col("word"), WORD_SHIFT)


def _first() -> Column:
    return _base() + _low_bit(F.col("bits"))


def _last() -> Column:
    return _base() + _high_bit(F.col("bits"))


# -- counts --------------------------------------------------------------------------------


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def distinct_offsets(df: DataFrame, key: str = "partition", seq: str = "offset") -> DataFrame:
    """The distinct ``(key, seq)`` pairs."""
    return df.select(key, seq).distinct()


def duplicate_summary(df: DataFrame, key: str = "partition", seq: str = "offset") -> DataFrame:
    """One row: rows, distinct pairs, and rows that repeat an earlier pair."""
    return packed_duplicate_summary(_pack(df, key, seq))


def packed_duplicate_summary(packed: DataFrame) -> DataFrame:
    rows = F.coalesce(F.sum("row_count"), F.lit(0))
    pairs = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))
    return packed.agg(
        rows.alias("normalized_offset_row_count"),
        pairs.alias("distinct_partition_offset_count"),
        (rows - pairs).alias("duplicate_offset_row_count"),
    )


def partition_gap_stats(df: DataFrame, key: str = "partition", seq: str = "offset") -> DataFrame:
    """Per key: distinct count, range, span, expected and missing count, ``has_gaps``.

    Values before the first or after the last one seen are outside the range and cannot be
    told from values that never existed. A span of exactly ``2**63`` does not fit a bigint
    and reads as null; the missing count and ``has_gaps`` are right even then. The largest and
    the smallest value of a key must be less than ``2**63`` apart; else the query fails.
    """
    return packed_gap_stats(_pack(df, key, seq), key)


def packed_gap_stats(packed: DataFrame, key: str = "partition") -> DataFrame:
    span = F.try_add(F.col("max_offset") - F.col("min_offset"), F.lit(1))
    missing = F.col("max_offset") - F.col("min_offset") - (F.col("distinct_offset_count") - 1)
    return (
        packed.groupBy(key)
        .agg(
            F.sum(F.bit_count("bits")).alias("distinct_offset_count"),
            F.min(_first()).alias("min_offset"),
            F.max(_last()).alias("max_offset"),
        )
        .select(
            key,
            "distinct_offset_count",
            "min_offset",
            "max_offset",
            span.alias("span"),
            span.alias("expected_count"),
            missing.alias("missing_offset_count"),
            (missing > 0).alias("has_gaps"),
        )
    )


def gap_partitions(stats: DataFrame) -> DataFrame:
    """The rows of the statistics that have gaps."""
    return stats.filter("has_gaps")


def gap_partition_count(stats: DataFrame) -> DataFrame:
    """One row with the number of keys that have gaps."""
    return stats.agg(F.count_if("has_gaps").alias("gap_partition_count"))


# -- order and gaps ------------------------------------------------------------------------


def _with_buckets(packed: DataFrame, key: str) -> DataFrame:
    """The packed form with each word's ``bucket``, that of a sparse zone being its first.

    Which zones are cut is a fixed number of marks, read as one value by every task; so words
    are neither joined with zones nor dealt by them.
    """
    zone = F.shiftright("word", BUCKET_SHIFT + ZONE_SHIFT)
    place = F.pmod(F.xxhash64(key, "zone"), F.lit(ZONE_MARKS)).cast("int")
    buckets = F.shiftright("last", BUCKET_SHIFT) - F.shiftright("first", BUCKET_SHIFT) + 1
    # counts the bits, so that the planner sees the same packed form here as in the other uses
    cut = (
        packed.groupBy(key, zone.alias("zone"))
        .agg(F.count("bits").alias("n"), F.min("word").alias("first"), F.max("word").alias("last"))
        .filter((F.col("n") > SPARSE_WORDS) | (F.col("n") >= buckets * SPARSE_FILL))
        .agg(F.collect_set(place).alias("places"))
        .select(F.transform(F.sequence(F.lit(0), F.lit(ZONE_MARKS - 1)), lambda i: F.array_contains("places", i)))
    )
    zoned = packed.withColumn("zone", zone)
    whole = ~F.get(cut.scalar(), place)
    first = F.shiftleft("zone", ZONE_SHIFT)
    return zoned.withColumn("bucket", F.when(whole, first).otherwise(F.shiftright("word", BUCKET_SHIFT))).drop("zone")


def _bucket_ranks(packed: DataFrame, key: str) -> DataFrame:
    """Per non-empty bucket: what lies before and after it in its key.

    ``key_start`` is the key's first value, ``bucket_start`` the bucket's own first value,
    ``before_bucket`` the number of distinct values in earlier buckets and ``after_bucket``
    the first value of the next non-empty bucket.
    """
    buckets = (
        packed.groupBy(key, "bucket")
        .agg(F.min(_first()).alias("bucket_start"), F.sum(F.bit_count("bits")).alias("n"))
        .withColumn("zone", F.shiftright("bucket", ZONE_SHIFT))
    )
    earlier = (Window.unboundedPreceding, -1)
    in_key = Window.partitionBy(key).orderBy("zone")
    zones = (
        buckets.groupBy(key, "zone")
        .agg(F.min("bucket_start").alias("zone_start"), F.sum("n").alias("n"))
        .select(
            key,
            "zone",
            F.first("zone_start").over(in_key).alias("key_start"),
            F.coalesce(F.sum("n").over(in_key.rowsBetween(*earlier)), F.lit(0)).alias("before_zone"),
            F.lead("zone_start").over(in_key).alias("after_zone"),
        )
    )
    in_zone = Window.partitionBy(key, "zone").orderBy("bucket")
    return (
        buckets.select(
            key,
            "zone",
            "bucket",
            "bucket_start",
            F.coalesce(F.sum("n").over(in_zone.rowsBetween(*earlier)), F.lit(0)).alias("before_in_zone"),
            F.lead("bucket_start").over(in_zone).alias("after_in_zone"),
        )
        .join(zones, [key, "zone"])
        .select(
            key,
            "bucket",
            "key_start",
            "bucket_start",
            (F.col("before_zone") + F.col("before_in_zone")).alias("before_bucket"),
            F.coalesce("after_in_zone", "after_zone").alias("after_bucket"),
        )
    )


def _ranked_words(packed: DataFrame, ranks: DataFrame, key: str) -> DataFrame:
    """Words with the value that follows them and the number of values before them."""
    in_bucket = Window.partitionBy(key, "bucket").orderBy("word")
    before = F.sum(F.bit_count("bits")).over(in_bucket.rowsBetween(Window.unboundedPreceding, -1))
    return (
        packed.join(ranks, [key, "bucket"])
        .select(
            key,
            "word",
            "bits",
            "key_start",
            (F.col("before_bucket") + F.coalesce(before, F.lit(0))).alias("before_word"),
            F.coalesce(F.lead(_first()).over(in_bucket), F.col("after_bucket")).alias("after_word"),
        )
    )


def _successors(words: DataFrame, key: str, positions: Column) -> DataFrame:
    """For the values at the bit ``positions`` of each word, the next value of the key.

    ``earlier`` counts the distinct values of the key before the value.
    """
    each = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(positions, i) == 1)
    at = F.when(F.bit_count(positions) == 1, F.array(_high_bit(positions))).otherwise(each)
    above = F.call_function("shiftright", F.col("bits"), F.col("at") + 1)
    value = _base() + F.col("at")
    below = F.col("bits").bitwiseAND(_lone_bit(F.col("at")) - 1)
    return words.select("*", F.explode(at).alias("at")).select(
        key,
        "key_start",
        value.alias("value"),
        F.when(above == 0, F.col("after_word")).otherwise(value + 1 + _low_bit(above)).alias("next_value"),
        (F.col("before_word") + F.bit_count(below)).alias("earlier"),
    )


def next_offset(df: DataFrame, key: str = "partition", seq: str = "offset") -> DataFrame:
    """Each distinct value with the next one of its key, null after the last."""
    packed = _with_buckets(_pack(df, key, seq), key)
    words = _ranked_words(packed, _bucket_ranks(packed, key), key)
    return _successors(words, key, F.col("bits")).select(
        key, F.col("value").alias(seq), F.col("next_value").alias("next_offset")
    )


def gap_intervals(df: DataFrame, key: str = "partition", seq: str = "offset") -> DataFrame:
    """Each run of missing values as ``(key, gap_start, gap_end, gap_size)``, ends included."""
    return packed_gaps(_pack(df, key, seq), key).drop("prior_missing_count")


def prior_missing(df: DataFrame, key: str = "partition", seq: str = "offset") -> DataFrame:
    """The gap intervals, each with the number of values missing before it in its key."""
    return packed_gaps(_pack(df, key, seq), key)


def packed_gaps(packed: DataFrame, key: str = "partition", limit: int | None = None) -> DataFrame:
    """Gap intervals with ``prior_missing_count``, only those below ``limit`` if one is given.

    What is missing before a gap follows from counts alone: the values a key could have up
    to there minus the values it has. That also tells from the bucket summaries which
    buckets lie beyond the limit, so those are dropped before any word is sorted.
    """
    packed = _with_buckets(packed, key)
    ranks = _bucket_ranks(packed, key)
    if limit is not None:
        missing_before = F.col("bucket_start") - F.col("key_start") - F.col("before_bucket")
        ranks = ranks.filter(missing_before < limit)
    words = _ranked_words(packed, ranks, key)

    has_hole = F.bit_count("bits") <= _last() - _first()
    followed_by_gap = F.coalesce(F.col("after_word") - _last() > 1, F.lit(False))
    ends_run = F.col("bits").bitwiseAND(F.bitwise_not(F.shiftright("bits", 1)))
    gaps = (
        _successors(words.filter(has_hole | followed_by_gap), key, ends_run)
        .filter(F.col("next_value") - F.col("value") > 1)
        .select(
            key,
            (F.col("value") + 1).alias("gap_start"),
            (F.col("next_value") - 1).alias("gap_end"),
            (F.col("next_value") - F.col("value") - 1).alias("gap_size"),
            (F.col("value") - F.col("key_start") - F.col("earlier")).alias("prior_missing_count"),
        )
    )
    return gaps if limit is None else gaps.filter(F.col("prior_missing_count") < limit)


# -- listed missing values -----------------------------------------------------------------


def check_limit(limit: int | None) -> int | None:
    """A bound on what is listed per key, or None for no bound."""
    if limit is None:
        return None
    if isinstance(limit, bool) or not isinstance(limit, int) or not 0 <= limit <= MAX_LIMIT:
        raise InputError(f"missing-offset limit must be an integer from 0 to {MAX_LIMIT}: {limit!r}")
    return limit


def missing_offsets(
    df: DataFrame, limit: int | None = DEFAULT_MISSING_LIMIT, key: str = "partition", seq: str = "offset"
) -> DataFrame:
    """The missing values of each key as ``(key, missing_offset)``, the smallest ``limit`` if one is given.

    A limit of 0 gives no rows.
    """
    return packed_missing_offsets(_pack(df, key, seq), limit, key)


def packed_missing_offsets(
    packed: DataFrame, limit: int | None = DEFAULT_MISSING_LIMIT, key: str = "partition"
) -> DataFrame:
    check_limit(limit)
    left = F.lit(limit).cast("bigint") - F.col("prior_missing_count")
    return expand_runs(packed_gaps(packed, key, limit).select(
        key,
        F.col("gap_start").alias("from"),
        (F.col("gap_size") if limit is None else F.least(F.col("gap_size"), left)).alias("take"),
    ), key)


def expand_runs(taken: DataFrame, key: str = "partition") -> DataFrame:
    """Runs ``(key, from, take)`` as ``(key, missing_offset)``, long ones spread over the tasks."""
    for length in RUNS:
        taken = _cut(taken, length, key)
    taken = taken.repartition(key, "from")
    return _cut(taken, INNER_RUN, key).select(
        key, F.explode(F.sequence("from", F.col("from") + F.col("take") - 1)).alias("missing_offset")
    )


def _cut(runs: DataFrame, length: int, key: str) -> DataFrame:
    """Runs ``from, take`` cut into pieces of at most ``length`` values.

    The rows made from one row are held until all are made. ``coalesce`` to more partitions
    than there are moves nothing, but keeps that apart from level to level.
    """
    pieces = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(take - 1) div {length}"))
    return runs.select("*", F.explode(pieces).alias("piece")).select(
        key,
        (F.col("from") + F.col("piece") * length).alias("from"),
        F.least(F.lit(length).cast("bigint"), F.col("take") - F.col("piece") * length).alias("take"),
    ).coalesce(STREAMS)


def _exceeds(limit: int | None) -> Column:
    return F.lit(False) if check_limit(limit) is None else F.col("missing_offset_count") > limit


def ordered_missing(missing: DataFrame, key: str = "partition") -> DataFrame:
    return missing.orderBy(key, "missing_offset")


def truncation_flag(stats: DataFrame, limit: int | None, key: str = "partition") -> DataFrame:
    """Per key with gaps: whether it misses more values than the limit lists."""
    return gap_partitions(stats).select(
        key, "missing_offset_count", _exceeds(limit).alias("truncated")
    )


def any_truncated(stats: DataFrame, limit: int | None) -> DataFrame:
    """One row: whether the listing of any key is cut short by the limit."""
    cut = F.bool_or(_exceeds(limit))
    return stats.agg(F.coalesce(cut, F.lit(False)).alias("missing_offsets_truncated"))


def listed_parts(gaps: DataFrame, limit: int, key: str = "partition", part: int = LIST_PART) -> DataFrame:
    """``(key, missing_offsets)``: the smallest ``limit`` missing values of each key, ``part`` to a row.

    A value's place in the list follows from its run's ``prior_missing_count``, so runs are cut
    at multiples of ``part`` and the pieces of one row meet by their number. No row and no
    group holds more than ``part`` values, whatever the limit.
    """
    end = F.least(F.col("prior_missing_count") + F.col("gap_size"), F.lit(check_limit(limit)).cast("bigint"))
    pieces = gaps.filter(F.col("prior_missing_count") < limit).select(
        key, F.col("gap_start").alias("from"), F.col("prior_missing_count").alias("place"), end.alias("end")
    )
    for length in (*(run for run in RUNS if run > part), part):
        pieces = _cut_places(pieces, length, key)
    run = F.struct("from", (F.col("end") - F.col("place")).alias("take"))
    grouped = pieces.groupBy(key, F.expr(f"place div {part}").alias("part")).agg(F.array_sort(F.collect_list(run)).alias("runs"))
    values = F.flatten(F.transform("runs", lambda run: F.sequence(run["from"], run["from"] + run["take"] - 1)))
    return grouped.select(key, values.alias("missing_offsets"))


def _cut_places(pieces: DataFrame, length: int, key: str) -> DataFrame:
    """Pieces ``from, place, end`` cut where the place is a multiple of ``length``."""
    blocks = F.sequence(F.expr(f"place div {length}"), F.expr(f"(end - 1) div {length}"))
    start = F.greatest("place", F.col("block") * length)
    # the end of the last block may lie past a bigint
    stop = F.coalesce(F.least("end", F.try_add(F.col("block") * length, F.lit(length).cast("bigint"))), F.col("end"))
    return pieces.select("*", F.explode(blocks).alias("block")).select(
        key, (F.col("from") + (start - F.col("place"))).alias("from"), start.alias("place"), stop.alias("end")
    ).coalesce(STREAMS)


def stats_with_report(stats: DataFrame, gaps: DataFrame, limit: int, key: str = "partition", part: int = LIST_PART) -> DataFrame:
    """Statistics with the listed missing values of each key and whether they were cut.

    ``gaps`` are those of ``prior_missing`` or ``packed_gaps``. A list longer than ``part`` goes on
    in further rows of its key, in the order of their first values; so a row is bounded under
    any limit. Without a limit ``gap_report`` is the form to use.
    """
    if check_limit(limit) is None:
        raise InputError("a list per key needs a limit; use gap_report for all missing offsets")
    empty = F.array().cast("array<bigint>")
    return stats.join(listed_parts(gaps, limit, key, part), key, "left").select(
        *stats.columns,
        F.coalesce("missing_offsets", empty).alias("missing_offsets"),
        F.lit(limit).cast("bigint").alias("missing_offsets_limit"),
        (F.col("missing_offset_count") > limit).alias("missing_offsets_truncated"),
    )


def packed_report(packed: DataFrame, limit: int, key: str = "partition") -> DataFrame:
    """``stats_with_report`` of a packed form, which is read by both of its sides; store it first."""
    return stats_with_report(packed_gap_stats(packed, key), packed_gaps(packed, key, check_limit(limit)), limit, key)


def gap_report(packed: DataFrame, key: str = "partition") -> DataFrame:
    """The statistics of each key with one row per run of missing values, or one without any."""
    gaps = packed_gaps(packed, key).drop("prior_missing_count")
    return packed_gap_stats(packed, key).join(gaps, key, "left")


def ordered_report(report: DataFrame, key: str = "partition") -> DataFrame:
    """A statistics report ordered for reading, with its lists as text."""
    ordered = report.orderBy(key, F.asc_nulls_first(F.get("missing_offsets", F.lit(0))))
    return ordered.withColumn("missing_offsets", format_offsets(F.col("missing_offsets")))
