"""The whole check: landed data to verdict, with or without side topics."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ENGINE_ERRORS, InputError
from tidemark.operators import metadata as md
from tidemark.operators import reconcile as rc
from tidemark.operators import sequences as sq
from tidemark.operators import verdict as vd
from tidemark.sources import discovery as ds
from tidemark.sources import landed as ld
from tidemark.sources import side_topic as st
from tidemark.sources.scratch import materialize, release


@dataclass(frozen=True)
class SideTopics:
    """What may explain missing offsets of ``source_topic``.

    ``canary`` and ``dead_letter`` are Kafka-shaped frames (see ``read_side_topic``); at
    least one is needed, each with the name of its topic.
    """

    source_topic: str
    canary_topic: str | None = None
    canary: DataFrame | None = None
    dead_letter_topic: str | None = None
    dead_letter: DataFrame | None = None

    def __post_init__(self):
        if not (self.source_topic or "").strip():
            raise InputError("side topics need a source topic")
        sides = [(self.canary_topic, self.canary), (self.dead_letter_topic, self.dead_letter)]
        if any(bool(topic) != (rows is not None) for topic, rows in sides):
            raise InputError("a side topic needs both its name and its rows")
        if not any(topic for topic, _ in sides):
            raise InputError("a source topic needs a canary topic or a dead-letter topic")


@dataclass(frozen=True)
class Reconciliation:
    """Side-topic records held against the missing offsets.

    ``summary`` counts over all of them. ``explained`` has one row per listed offset; without
    a limit it is computed when it is read.
    """

    records: DataFrame
    explained: DataFrame
    summary: DataFrame
    side_topics: SideTopics

    @property
    def classified(self) -> DataFrame:
        return self.explained.select(*rc.RECORD_KEY, "in_canary", "in_dead_letter", "unresolved")

    @property
    def buckets(self) -> DataFrame:
        return rc.bucket_offsets(self.explained, self.side_topics.canary_topic, self.side_topics.dead_letter_topic)

    @property
    def decoded_record_counts(self) -> DataFrame:
        sides = [(self.side_topics.canary_topic, st.CANARY), (self.side_topics.dead_letter_topic, st.DEAD_LETTER)]
        return st.decoded_record_count(self.records, [side for side in sides if side[0]])


@dataclass(frozen=True)
class Continuity:
    """Everything a run found. ``words`` is the packed form, for further questions."""

    quality: DataFrame
    words: DataFrame
    stats: DataFrame
    missing: DataFrame
    limit: int | None
    reconciliation: Reconciliation | None
    verdict: DataFrame
    partitions: DataFrame | None = None
    roots: tuple = ()

    @property
    def report(self) -> DataFrame:
        """Statistics per partition: with the listed offsets under a limit, else a row per run."""
        if self.limit is None:
            return sq.gap_report(self.words)
        return sq.stats_with_report(self.stats, sq.packed_gaps(self.words, limit=self.limit), self.limit)

    @property
    def scan_summary(self) -> DataFrame:
        """Children per root and status, 0 included; only for a run over roots."""
        return ds.scan_summary(self.partitions, self.roots)

    @property
    def duplicates(self) -> DataFrame:
        """Rows, distinct pairs, and rows that repeat an earlier pair."""
        return sq.packed_duplicate_summary(self.words)

    def release(self) -> None:
        """Delete the intermediate tables of the run; its frames can then no longer be read."""
        side = self.reconciliation
        frames = [self.words, self.stats, self.missing, *((side.records, side.explained, side.summary) if side else ())]
        release(*frames)


def reconcile_side_topics(
    words: DataFrame, stats: DataFrame, side_topics: SideTopics | None, limit: int | None = None
) -> Reconciliation | None:
    """Decode the side topics and hold the missing offsets of the packed ``words`` against them.

    The topics are decoded even if nothing is missing, so a broken payload never goes
    unnoticed. Without side topics there is no result.
    """
    if side_topics is None:
        return None
    sides = [
        (side_topics.canary, st.CANARY, side_topics.canary_topic),
        (side_topics.dead_letter, st.DEAD_LETTER, side_topics.dead_letter_topic),
    ]
    frames = [st.decode_side_topic(rows, kind, topic) for rows, kind, topic in sides if rows is not None]
    try:
        decoded = materialize(ld.cross_root_union(frames), "side-topic-records")
    except ENGINE_ERRORS as error:
        topics = [topic for _, _, topic in sides if topic]
        raise InputError(f"cannot read side topics {topics}: {error}") from error
    st.require_decoded(decoded)
    records = st.side_topic_records(decoded)
    of_source = records.filter(F.col("source_topic") == side_topics.source_topic)
    if limit is None:
        explained = rc.explain_ledger(words, stats, of_source, side_topics.source_topic)
    else:
        keys = rc.missing_keys(sq.packed_missing_offsets(words, limit), side_topics.source_topic)
        explained = materialize(rc.explain_keys(keys, of_source), "explained-offsets")
    listed = None if limit is None else explained
    summary = rc.reconciliation_summary(words, stats, records, side_topics.source_topic, limit, listed)
    return Reconciliation(records, explained, summary, side_topics)


def check_landed(
    landed: DataFrame,
    metadata_column: str = md.DEFAULT_METADATA_COLUMN,
    limit: int | None = sq.DEFAULT_MISSING_LIMIT,
    fail_on_gaps=True,
    fail_on_invalid_rows=True,
    normalized_path: str | None = None,
    normalized_overwrite=True,
    side_topics: SideTopics | None = None,
) -> Continuity:
    """Check one frame of landed rows.

    The landed data is scanned and parsed once, into the packed ledger, from which all else
    follows. When normalized rows are to be stored, the same pass writes them and counts the
    profile, and the analysis reads the stored copy. An input without valid rows is noticed
    before that, so an older copy is left as it is.

    Counts and verdict cover all missing offsets. ``limit`` bounds only how many are listed
    per partition; a listing that it cuts short fails a run with side topics.
    """
    sq.check_limit(limit)
    fail_on_gaps = vd.check_flag(fail_on_gaps, "fail_on_gaps")
    fail_on_invalid_rows = vd.check_flag(fail_on_invalid_rows, "fail_on_invalid_rows")
    normalized_overwrite = vd.check_flag(normalized_overwrite, "normalized_overwrite")

    if normalized_path:
        source = "_source_file"
        parsed = md.parse_metadata(ld.with_source_file(landed, source), metadata_column, keep=[source])
        if not parsed.filter(md.is_valid()).limit(1).count():
            md.require_valid_rows(md.metadata_quality(parsed).first())
        watched, profile = md.observed_quality(parsed)
        ld.persist_normalized(md.normalize_offsets(watched, source), normalized_path, normalized_overwrite)
        quality = md.quality_frame(landed.sparkSession, profile.get)
        stored = ld.reload_normalized(landed.sparkSession, normalized_path)
        words = materialize(sq.pack_sequences(stored), "ledger")
    else:
        ledger = materialize(md.pack_ledger(md.parse_metadata(landed, metadata_column)), "ledger")
        quality = md.ledger_quality(ledger)
        md.require_valid_rows(quality.first())
        words = md.ledger_words(ledger)

    stats = materialize(sq.packed_gap_stats(words), "gap-stats")
    missing = sq.packed_missing_offsets(words, limit)
    if limit is not None:
        missing = materialize(missing, "missing-offsets")
    reconciliation = reconcile_side_topics(words, stats, side_topics, limit)
    counted = (
        reconciliation.summary
        if reconciliation
        else sq.gap_partition_count(stats).withColumnRenamed("gap_partition_count", "raw_gap_partition_count")
    )
    facts = vd.verdict_facts(
        quality.select("invalid_row_count"), counted, side_topic_enabled=reconciliation is not None
    )
    verdict = vd.final_verdict(facts, fail_on_gaps, fail_on_invalid_rows)
    return Continuity(quality, words, stats, missing, limit, reconciliation, verdict)


def check_continuity(
    spark: SparkSession,
    roots,
    run_date=None,
    date_column: str = ds.DEFAULT_DATE_COLUMN,
    **options,
) -> Continuity:
    """Find the date partitions below ``roots``, skip the run date, and check the rest.

    ``options`` are those of ``check_landed``.
    """
    sq.check_limit(options.get("limit", sq.DEFAULT_MISSING_LIMIT))
    roots = ds.check_roots(roots)
    partitions = ds.classify_partitions(ds.scan_roots(spark, roots), ds.check_run_date(run_date), date_column)
    landed = ld.read_eligible(spark, ds.require_eligible(partitions))
    result = check_landed(landed, **options)
    return replace(result, partitions=partitions, roots=tuple(roots))
