"""Explaining missing values by canary and dead-letter records.

Side-topic records may repeat one key any number of times, so they are counted per key
before they are shuffled for a join; both join sides then hold each key once.

Missing values are far more than explained ones as a rule, and they come in runs. Against a
packed ledger they are therefore not listed first: a record's key is missing if its bit is
not set within the range of its partition, and the unresolved runs are the gaps of the ledger
once the bits of the explained keys are added to it. Only then, if asked for, are runs expanded.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.frames import one_row
from tidemark.operators.sequences import (
    WORD,
    WORD_SHIFT,
    any_truncated,
    expand_runs,
    gap_partition_count,
    offset_bit,
    offset_word,
    packed_gaps,
    range_bits,
)
from tidemark.sources.scratch import materialize
from tidemark.sources.side_topic import CANARY, DEAD_LETTER

RECORD_KEY = ["source_topic", "source_partition", "source_offset"]
DIAGNOSTICS = ["failure_event_id", "reason_msg", "exception"]
#: Keys with the most records that are told apart, and counters kept to find them.
HEAVY = 256
HEAVY_TRACKED = 4096


def missing_keys(missing: DataFrame, source_topic: str) -> DataFrame:
    """Listed missing offsets as keys that side-topic records can match."""
    return missing.select(
        F.lit(source_topic).alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("missing_offset").alias("source_offset"),
    )


def explained_by(keys: DataFrame, records: DataFrame) -> DataFrame:
    """The missing keys that occur among the records; repeated records match once."""
    return keys.join(records.select(*RECORD_KEY).distinct(), RECORD_KEY, "left_semi")


def set_difference(keys: DataFrame, *record_frames: DataFrame) -> DataFrame:
    """The missing keys that occur in none of the record frames."""
    seen = reduce(DataFrame.union, [records.select(*RECORD_KEY) for records in record_frames]).distinct()
    return keys.join(seen, RECORD_KEY, "left_anti")


def unresolved(keys: DataFrame, canary: DataFrame, dead_letter: DataFrame) -> DataFrame:
    """The missing keys that neither side topic explains."""
    return set_difference(keys, canary, dead_letter)


def _per_key(records: DataFrame) -> DataFrame:
    """Each record key once, with its kinds and its counts of dead-letter diagnostics."""
    dead = F.col("kind") == DEAD_LETTER
    return records.groupBy(*RECORD_KEY).agg(
        F.bool_or(F.col("kind") == CANARY).alias("in_canary"),
        F.bool_or(dead).alias("in_dead_letter"),
        *(F.count(F.when(dead, F.col(name))).alias(f"{name}_count") for name in DIAGNOSTICS),
    )


def explain_keys(keys: DataFrame, records: DataFrame) -> DataFrame:
    """Every listed missing key with its match flags and its counts of dead-letter diagnostics.

    ``records`` are the records of both kinds, counted per key before the join.
    """
    canary, dead_letter = (F.coalesce(name, F.lit(False)) for name in ("in_canary", "in_dead_letter"))
    return keys.join(_per_key(records), RECORD_KEY, "left").select(
        *RECORD_KEY,
        canary.alias("in_canary"),
        dead_letter.alias("in_dead_letter"),
        (~(canary | dead_letter)).alias("unresolved"),
        *(F.coalesce(f"{name}_count", F.lit(0)).alias(f"{name}_count") for name in DIAGNOSTICS),
    )


def marked_words(words: DataFrame, stats: DataFrame, records: DataFrame, source_topic: str) -> DataFrame:
    """``(partition, word, seen, canary, dead_letter)``: the packed ledger with the missing offsets that records explain.

    The last two columns hold the bits of missing offsets, those within the range of their
    partition that were not seen. Ledger and records meet in one aggregation, without a join.
    """
    side = side_words(records.filter(F.col("source_topic") == source_topic))
    none = F.lit(None).cast("bigint")
    both = words.select("partition", "word", "bits", none.alias("canary"), none.alias("dead_letter")).unionByName(
        side.select("partition", "word", none.alias("bits"), "canary", "dead_letter")
    )
    met = both.groupBy("partition", "word").agg(
        F.coalesce(F.bit_or("bits"), F.lit(0)).alias("seen"), *(F.coalesce(F.bit_or(name), F.lit(0)).alias(name) for name in ("canary", "dead_letter"))
    )
    ranges = stats.select("partition", "min_offset", "max_offset")
    missing = F.bitwise_not("seen").bitwiseAND(range_bits(F.col("word"), F.col("min_offset"), F.col("max_offset")))
    return met.join(ranges, "partition").select(
        "partition", "word", "seen", *(F.col(name).bitwiseAND(missing).alias(name) for name in ("canary", "dead_letter"))
    )


def explained_keys(marked: DataFrame, source_topic: str) -> DataFrame:
    """The missing keys of ``marked_words`` that have records, once each, with their match flags."""
    either = F.col("canary").bitwiseOR(F.col("dead_letter"))
    at = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.getbit(either, i) == 1)
    each = marked.filter(either != 0).select("*", F.explode(at).alias("at"))
    return each.select(
        F.lit(source_topic).alias("source_topic"),
        F.col("partition").alias("source_partition"),
        (F.shiftleft("word", WORD_SHIFT) + F.col("at")).alias("source_offset"),
        *((F.getbit(name, "at") == 1).alias(f"in_{name}") for name in ("canary", "dead_letter")),
        F.lit(False).alias("unresolved"),
    )


def unresolved_runs(marked: DataFrame) -> DataFrame:
    """The runs of missing offsets that no record explains: ``(partition, gap_start, gap_end, gap_size)``.

    Explained offsets count as seen. They lie within the range of their partition, so the
    range stays the same and the gaps left are what no record explains.
    """
    bits = F.col("seen").bitwiseOR(F.col("canary")).bitwiseOR(F.col("dead_letter"))
    packed = marked.select("partition", F.coalesce("word", F.lit(0)).alias("word"), bits.alias("bits")).filter("bits <> 0")
    return packed_gaps(packed).drop("prior_missing_count")


def run_keys(runs: DataFrame, source_topic: str) -> DataFrame:
    """Every offset of ``unresolved_runs`` as a key; nothing is shuffled but the runs."""
    listed = expand_runs(runs.select("partition", F.col("gap_start").alias("from"), F.col("gap_size").alias("take")))
    return missing_keys(listed, source_topic)


def classify_ledger(words: DataFrame, stats: DataFrame, records: DataFrame, source_topic: str) -> DataFrame:
    """``classify_missing`` of all missing offsets of the packed ``words``."""
    return _classify(materialize(marked_words(words, stats, records, source_topic), "marked-words"), source_topic)


def _classify(marked: DataFrame, source_topic: str) -> DataFrame:
    no = F.lit(False)
    rest = run_keys(unresolved_runs(marked), source_topic)
    rest = rest.select(*RECORD_KEY, no.alias("in_canary"), no.alias("in_dead_letter"), F.lit(True).alias("unresolved"))
    return explained_keys(marked, source_topic).unionByName(rest)


def explain_ledger(words: DataFrame, stats: DataFrame, records: DataFrame, source_topic: str) -> DataFrame:
    """``explain_keys`` of all missing offsets of the packed ``words``; only explained keys are joined with records."""
    marked = materialize(marked_words(words, stats, records, source_topic), "marked-words")
    counts = [f"{name}_count" for name in DIAGNOSTICS]
    explained = explain_keys(explained_keys(marked, source_topic).select(*RECORD_KEY), records)
    rest = _classify(marked, source_topic).filter("unresolved").select("*", *(F.lit(0).cast("bigint").alias(name) for name in counts))
    return explained.unionByName(rest)


def classify_missing(keys: DataFrame, canary: DataFrame, dead_letter: DataFrame) -> DataFrame:
    """One row per missing key with both match flags. A key may be in both side topics."""
    return explain_keys(keys, canary.unionByName(dead_letter)).select(
        *RECORD_KEY, "in_canary", "in_dead_letter", "unresolved"
    )


def heavy_keys(records: DataFrame, share: float, heavy: int = HEAVY, tracked: int = HEAVY_TRACKED) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of all records, ``heavy`` at most.

    They come from a summary of ``tracked`` counters per task, so nothing grows with the keys.
    A key above ``1.4 / tracked`` of the records is always in it.
    """
    top = F.expr(f"approx_top_k(xxhash64({', '.join(RECORD_KEY)}), {heavy}, {tracked})")
    row = records.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] > share * row["n"]]


def matched_records(records: DataFrame, keys: DataFrame, share: float | None = None) -> DataFrame:
    """The records whose key is missing, repeats kept.

    Records of one key would all meet in one task, so the few keys that hold more than
    ``share`` of the records (a quarter of what a task gets, unless given) are matched apart:
    they are at most ``HEAVY``, so they are sent to the records. All other records and keys meet
    in an ordinary join, and no key is copied.
    """
    if share is None:
        share = 0.25 / int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(records, share)
    keys = keys.select(*RECORD_KEY).distinct()
    if not heavy:
        return records.join(keys, RECORD_KEY, "left_semi").select(*records.columns)
    is_heavy = F.xxhash64(*RECORD_KEY).isin(heavy)
    few = records.filter(is_heavy).join(F.broadcast(keys.filter(is_heavy)), RECORD_KEY, "left_semi")
    rest = records.filter(~is_heavy).join(keys.filter(~is_heavy), RECORD_KEY, "left_semi")
    return few.select(*records.columns).unionByName(rest.select(*records.columns))


def dead_letter_fields(matched: DataFrame) -> DataFrame:
    """How many matched dead-letter records carry each diagnostic."""
    return matched.agg(*(F.count(name).alias(f"{name}_count") for name in DIAGNOSTICS))


def bucket_offsets(classified: DataFrame, canary_topic: str | None = None, dead_letter_topic: str | None = None) -> DataFrame:
    """One row per bucket and offset, with the topics: ``bucket, source_topic, side_topic, partition, offset``.

    An offset in both side topics is in both buckets.
    """

    def bucket(name, topic):
        return F.struct(F.lit(name).alias("bucket"), F.lit(topic).cast("string").alias("side_topic"))

    buckets = F.array(
        F.when(F.col("in_canary"), bucket("canary_explained", canary_topic)),
        F.when(F.col("in_dead_letter"), bucket("dead_letter_explained", dead_letter_topic)),
        F.when(F.col("unresolved"), bucket("unresolved", None)),
    )
    return classified.select("*", F.explode(F.array_compact(buckets)).alias("in")).select(
        "in.bucket",
        "source_topic",
        "in.side_topic",
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
    )


def ordered_buckets(buckets: DataFrame) -> DataFrame:
    """Buckets by partition and offset."""
    return buckets.orderBy("partition", "offset", "bucket")


def bucket_counts(buckets: DataFrame) -> DataFrame:
    """Offsets per bucket, topics and partition."""
    return buckets.groupBy("bucket", "source_topic", "side_topic", "partition").agg(
        F.count(F.lit(1)).alias("offset_count")
    )


def side_words(records: DataFrame) -> DataFrame:
    """Record keys of one source topic in packed form: ``partition, word, canary, dead_letter``.

    The two columns hold a bit per offset that occurs, as in the packed ledger.
    """
    bit = offset_bit(F.col("source_offset"))
    kinds = {"canary": CANARY, "dead_letter": DEAD_LETTER}
    return records.groupBy(
        F.col("source_partition").alias("partition"), offset_word(F.col("source_offset")).alias("word")
    ).agg(*(F.coalesce(F.bit_or(F.when(F.col("kind") == kind, bit)), F.lit(0)).alias(name) for name, kind in kinds.items()))


def explained_words(side: DataFrame, words: DataFrame, stats: DataFrame) -> DataFrame:
    """``side_words`` with only the bits of missing offsets: not seen, and within the partition's range."""
    seen = words.groupBy("partition", "word").agg(F.bit_or("bits").alias("seen"))
    ranges = stats.select("partition", "min_offset", "max_offset")
    missing = F.bitwise_not(F.coalesce("seen", F.lit(0))).bitwiseAND(range_bits(F.col("word"), F.col("min_offset"), F.col("max_offset")))
    return (
        side.join(seen, ["partition", "word"], "left")
        .join(ranges, "partition")
        .select("partition", "word", *(F.col(name).bitwiseAND(missing).alias(name) for name in ("canary", "dead_letter")))
    )


def reconciliation_summary(
    words: DataFrame, stats: DataFrame, records: DataFrame, source_topic: str, limit: int | None = None,
    listed: DataFrame | None = None,
) -> DataFrame:
    """One row of counters over all missing offsets of the packed ``words``.

    No missing offset is expanded: the keys of the side topics are packed like the ledger and
    compared bit by bit. A key in both side topics counts in both, so the outcome counts may
    add up to more than ``total_missing_offset_count``. Record counts cover all decoded records of
    any topic. The ``bounded_`` counters are those of the listing under ``limit``; ``listed``
    is that listing after ``explain_keys``, and without a limit they equal the totals.
    """
    of_source = records.filter(F.col("source_topic") == source_topic)
    found = materialize(explained_words(side_words(of_source), words, stats), "explained-words")

    def bits(column):
        return F.coalesce(F.sum(F.bit_count(column)), F.lit(0))

    either = F.col("canary").bitwiseOR(F.col("dead_letter"))
    outcome = found.agg(
        bits(F.col("canary")).alias("canary_explained_count"),
        bits(F.col("dead_letter")).alias("dead_letter_explained_count"),
        bits(either).alias("explained_count"),
    )
    per_key = (
        of_source.filter(F.col("kind") == DEAD_LETTER)
        .groupBy(F.col("source_partition").alias("partition"), "source_offset")
        .agg(*(F.count(name).alias(name) for name in DIAGNOSTICS))
        .withColumn("word", offset_word(F.col("source_offset")))
    )
    matched = per_key.join(found, ["partition", "word"]).filter(
        F.col("dead_letter").bitwiseAND(offset_bit(F.col("source_offset"))) != 0
    )
    fields = matched.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(f"dead_letter_{name}_count") for name in DIAGNOSTICS))
    decoded = records.agg(
        F.count_if(F.col("kind") == CANARY).alias("canary_record_count"),
        F.count_if(F.col("kind") == DEAD_LETTER).alias("dead_letter_record_count"),
    )
    gaps = stats.select("has_gaps", "missing_offset_count")
    total = F.coalesce(F.sum("missing_offset_count"), F.lit(0))
    bounded = total if limit is None else F.coalesce(F.sum(F.least("missing_offset_count", F.lit(limit).cast("bigint"))), F.lit(0))
    totals = gaps.agg(total.alias("total_missing_offset_count"), bounded.alias("bounded_missing_offset_count"))
    frames = [outcome, fields, decoded, totals, gap_partition_count(gaps).withColumnRenamed("gap_partition_count", "raw_gap_partition_count")]
    if listed is not None:
        frames.append(listed.agg(F.count_if("unresolved").alias("bounded_unresolved_count")))
    row = one_row(*frames, any_truncated(gaps, limit)).withColumn(
        "unresolved_count", F.col("total_missing_offset_count") - F.col("explained_count")
    )
    if listed is None:
        row = row.withColumn("bounded_unresolved_count", F.col("unresolved_count"))
    return row.drop("explained_count").withColumn("source_topic", F.lit(source_topic))
