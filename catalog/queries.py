"""One registered query per operator. Each reads the given tables as a whole."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import ledger as lg
from tidemark import check_continuity as run_check
from tidemark import reconcile_side_topics as run_reconcile
from tidemark.functions import count_when, format_offsets, numeric_guard, quoted_column
from tidemark.operators import metadata as md
from tidemark.operators import reconcile as rc
from tidemark.operators import sequences as sq
from tidemark.operators import verdict as vd
from tidemark.sources import discovery as ds
from tidemark.sources import landed as ld
from tidemark.sources import side_topic as st
from tidemark.sources import synth
from tidemark.sources.scratch import materialize, scratch_path

#: Limits of the queries whose feature is a limit.
LISTING_LIMIT = 1000
REPORT_LIMIT = 5
ODD_COLUMN = "meta`data"

QUERIES = {}


def query(name: str):
    """Register a query under the name of its operator."""

    def register(function):
        QUERIES[name] = function
        return function

    return register


# -- sequences: lineitem as order keys per line number ------------------------------------------


@query("row_count")
def row_count(spark, sf_dir) -> DataFrame:
    return sq.row_count(lg.lines(spark, sf_dir))


@query("distinct_offsets")
def distinct_offsets(spark, sf_dir) -> DataFrame:
    return sq.distinct_offsets(lg.lines(spark, sf_dir))


@query("duplicate_summary")
def duplicate_summary(spark, sf_dir) -> DataFrame:
    return sq.duplicate_summary(lg.lines(spark, sf_dir))


@query("partition_gap_stats")
def partition_gap_stats(spark, sf_dir) -> DataFrame:
    return sq.partition_gap_stats(lg.lines(spark, sf_dir))


@query("gap_partitions")
def gap_partitions(spark, sf_dir) -> DataFrame:
    stats = sq.partition_gap_stats(lg.lines(spark, sf_dir))
    return sq.gap_partitions(stats).select("partition", "missing_offset_count", "min_offset", "max_offset")


@query("next_offset")
def next_offset(spark, sf_dir) -> DataFrame:
    return sq.next_offset(lg.lines(spark, sf_dir))


@query("gap_intervals")
def gap_intervals(spark, sf_dir) -> DataFrame:
    return sq.gap_intervals(lg.lines(spark, sf_dir))


@query("prior_missing")
def prior_missing(spark, sf_dir) -> DataFrame:
    return sq.prior_missing(lg.lines(spark, sf_dir))


@query("missing_offsets")
def missing_offsets(spark, sf_dir) -> DataFrame:
    return sq.missing_offsets(lg.lines(spark, sf_dir))


@query("missing_offsets_limited")
def missing_offsets_limited(spark, sf_dir) -> DataFrame:
    return sq.missing_offsets(lg.lines(spark, sf_dir), LISTING_LIMIT)


@query("ordered_missing")
def ordered_missing(spark, sf_dir) -> DataFrame:
    return sq.ordered_missing(missing_offsets(spark, sf_dir))


def _line_words(spark, sf_dir) -> DataFrame:
    return materialize(sq.pack_sequences(lg.lines(spark, sf_dir)), "lines")


@query("missing_offsets_zero")
def missing_offsets_zero(spark, sf_dir) -> DataFrame:
    """With limit 0 nothing is listed and every key with gaps is truncated."""
    report = sq.packed_report(_line_words(spark, sf_dir), 0)
    return report.select(
        "partition", F.size("missing_offsets").cast("bigint").alias("listed"), "missing_offsets_truncated"
    )


@query("truncation_flag")
def truncation_flag(spark, sf_dir) -> DataFrame:
    return sq.truncation_flag(sq.partition_gap_stats(lg.lines(spark, sf_dir)), LISTING_LIMIT)


@query("gap_report")
def gap_report(spark, sf_dir) -> DataFrame:
    """All missing offsets, one row per run."""
    return sq.gap_report(_line_words(spark, sf_dir))


def _report(spark, sf_dir) -> DataFrame:
    return sq.packed_report(_line_words(spark, sf_dir), REPORT_LIMIT)


@query("stats_with_report")
def stats_with_report(spark, sf_dir) -> DataFrame:
    return _report(spark, sf_dir).withColumn("missing_offsets", format_offsets(F.col("missing_offsets")))


@query("format_offsets")
def format_offsets_text(spark, sf_dir) -> DataFrame:
    """Every run of missing offsets as text of its two ends."""
    gaps = sq.gap_intervals(lg.lines(spark, sf_dir))
    return gaps.select("partition", format_offsets(F.array("gap_start", "gap_end")).alias("offsets"))


@query("ordered_output")
def ordered_output(spark, sf_dir) -> DataFrame:
    return sq.ordered_report(_report(spark, sf_dir)).select("partition", "missing_offset_count", "missing_offsets")


# -- metadata: the derived ledger -----------------------------------------------------------------


@query("quoted_column")
def quoted_column_read(spark, sf_dir) -> DataFrame:
    return lg.landed(spark, sf_dir, ODD_COLUMN).select("event_id", quoted_column(ODD_COLUMN).alias("metadata"))


@query("parse_metadata")
def parse_metadata(spark, sf_dir) -> DataFrame:
    return lg.parsed(spark, sf_dir).select(
        "event_id",
        F.col(md.P.partition_text).alias("partition_text"),
        F.col(md.P.offset_text).alias("offset_text"),
    )


@query("numeric_guard")
def numeric_guard_values(spark, sf_dir) -> DataFrame:
    """Numbers and near-numbers made from the events' own text."""
    texts = lg.table(spark, sf_dir, "events").select("event_id", F.explode(F.array(
        F.col("event_id").cast("string"),
        F.concat(F.lit("  "), F.col("user_id").cast("string"), F.lit(" ")),
        F.concat(F.lit("-"), F.col("event_id").cast("string")),
        F.concat(F.col("event_id").cast("string"), F.lit("99999999999")),
        F.col("event_type"),
        F.lit(""),
    )).alias("text"))
    return texts.select(
        "event_id",
        "text",
        numeric_guard(F.col("text"), "int").alias("as_int"),
        numeric_guard(F.col("text"), "bigint").alias("as_bigint"),
    )


def _register_predicates():
    def rows_where(condition):
        return lambda spark, sf_dir: lg.parsed(spark, sf_dir).filter(condition()).select("event_id")

    for name in [*(f"is_{defect}" for defect in md.DEFECTS), "is_invalid", "is_valid"]:
        QUERIES[name] = rows_where(getattr(md, name))


_register_predicates()


@query("count_when")
def count_when_by_type(spark, sf_dir) -> DataFrame:
    rows = lg.parsed(spark, sf_dir, keep=["event_id", "event_type"])
    return rows.groupBy("event_type").agg(
        count_when(md.is_invalid()).alias("invalid_rows"), count_when(md.is_valid()).alias("valid_rows")
    )


@query("metadata_quality")
def metadata_quality(spark, sf_dir) -> DataFrame:
    return md.metadata_quality(lg.parsed(spark, sf_dir))


@query("normalize_offsets")
def normalize_offsets(spark, sf_dir) -> DataFrame:
    return lg.normalized(spark, sf_dir).select("partition", "offset", "metadata_json")


@query("input_guards")
def input_guards(spark, sf_dir) -> DataFrame:
    return md.input_guards(md.ledger_quality(md.pack_ledger(lg.parsed(spark, sf_dir))))


# -- reconciliation -----------------------------------------------------------------------------


def _sides(spark, sf_dir) -> tuple:
    return lg.records(spark, sf_dir, st.CANARY), lg.records(spark, sf_dir, st.DEAD_LETTER)


def _marked(spark, sf_dir, *kinds) -> DataFrame:
    """The packed ledger with the missing offsets that records of these kinds explain."""
    words = lg.words(spark, sf_dir)
    records = ld.cross_root_union([lg.records(spark, sf_dir, kind) for kind in kinds])
    return materialize(rc.marked_words(words, sq.packed_gap_stats(words), records, lg.SOURCE_TOPIC), "marked-words")


@query("explained_by")
def explained_by(spark, sf_dir) -> DataFrame:
    return rc.explained_keys(_marked(spark, sf_dir, st.DEAD_LETTER), lg.SOURCE_TOPIC).select(*rc.RECORD_KEY)


@query("unresolved")
def unresolved(spark, sf_dir) -> DataFrame:
    return rc.run_keys(unresolved_runs(spark, sf_dir), lg.SOURCE_TOPIC)


@query("unresolved_runs")
def unresolved_runs(spark, sf_dir) -> DataFrame:
    """What no record explains, one row per run; no offset is expanded."""
    return rc.unresolved_runs(_marked(spark, sf_dir, st.CANARY, st.DEAD_LETTER))


@query("set_difference")
def set_difference(spark, sf_dir) -> DataFrame:
    return rc.run_keys(rc.unresolved_runs(_marked(spark, sf_dir, st.CANARY)), lg.SOURCE_TOPIC)


@query("classify_missing")
def classify_missing(spark, sf_dir) -> DataFrame:
    words = lg.words(spark, sf_dir)
    records = ld.cross_root_union(list(_sides(spark, sf_dir)))
    return rc.classify_ledger(words, sq.packed_gap_stats(words), records, lg.SOURCE_TOPIC)


@query("matched_records")
def matched_records(spark, sf_dir) -> DataFrame:
    keys = rc.explained_keys(_marked(spark, sf_dir, st.DEAD_LETTER), lg.SOURCE_TOPIC)
    return rc.matched_records(lg.records(spark, sf_dir, st.DEAD_LETTER), keys)


@query("dead_letter_fields")
def dead_letter_fields(spark, sf_dir) -> DataFrame:
    return rc.dead_letter_fields(matched_records(spark, sf_dir))


@query("bucket_offsets")
def bucket_offsets(spark, sf_dir) -> DataFrame:
    return rc.bucket_offsets(classify_missing(spark, sf_dir), lg.CANARY_TOPIC, lg.DEAD_LETTER_TOPIC)


@query("bucket_counts")
def bucket_counts(spark, sf_dir) -> DataFrame:
    return rc.bucket_counts(bucket_offsets(spark, sf_dir))


@query("ordered_buckets")
def ordered_buckets(spark, sf_dir) -> DataFrame:
    return rc.ordered_buckets(bucket_offsets(spark, sf_dir))


def _summary_of(words, records, limit=None) -> DataFrame:
    stats = materialize(sq.packed_gap_stats(words), "gap-stats")
    listed = None
    if limit is not None:
        keys = rc.missing_keys(sq.packed_missing_offsets(words, limit), lg.SOURCE_TOPIC)
        listed = rc.explain_keys(keys, records)
    return rc.reconciliation_summary(words, stats, records, lg.SOURCE_TOPIC, limit, listed)


def _both(spark, sf_dir) -> DataFrame:
    """The records of both side topics as a stored table, since a summary reads them more than once."""
    canary, dead_letter = _sides(spark, sf_dir)
    return materialize(canary.unionByName(dead_letter), "records")


def _summary(spark, sf_dir) -> DataFrame:
    return _summary_of(lg.words(spark, sf_dir), _both(spark, sf_dir))


@query("reconciliation_summary")
def reconciliation_summary(spark, sf_dir) -> DataFrame:
    return _summary(spark, sf_dir)


@query("reconcile_side_topics")
def reconcile_side_topics(spark, sf_dir) -> DataFrame:
    """Published, stored, read back, decoded and classified."""
    words = lg.words(spark, sf_dir)
    return run_reconcile(words, sq.packed_gap_stats(words), lg.side_topics(spark, sf_dir)).summary


# -- verdicts -----------------------------------------------------------------------------------


def _facts(spark, sf_dir, limit=None) -> DataFrame:
    """Profile and summary from one scan and one parse."""
    ledger = materialize(md.pack_ledger(lg.parsed(spark, sf_dir)), "ledger")
    quality = md.ledger_quality(ledger).select("invalid_row_count")
    summary = _summary_of(md.ledger_words(ledger), _both(spark, sf_dir), limit)
    return vd.verdict_facts(quality, summary, side_topic_enabled=True)


#: Offsets that are there although their events went to a side topic or were lost.
BRANCHES = {
    "resolved": (f"NOT ({lg.IS_CANARY}) AND NOT ({lg.IS_DEAD_LETTER})", True),
    "gaps_only": (f"NOT ({lg.IS_LOST})", False),
    "clean": ("true", True),
}


def _register_branches():
    """The other outcomes of a verdict, on sequences of the same events without defects."""

    def facts(spark, sf_dir, name):
        landed, side = BRANCHES[name]
        words = materialize(sq.pack_sequences(lg.events(spark, sf_dir).filter(landed), "p", "o"), "words")
        words = words.withColumnRenamed("p", "partition")
        quality = spark.range(1).select(F.lit(0).cast("bigint").alias("invalid_row_count"))
        if side:
            return vd.verdict_facts(quality, _summary_of(words, _both(spark, sf_dir)), side_topic_enabled=True)
        gaps = sq.gap_partition_count(sq.packed_gap_stats(words))
        counted = gaps.withColumnRenamed("gap_partition_count", "raw_gap_partition_count")
        return vd.verdict_facts(quality, counted, side_topic_enabled=False)

    for name in BRANCHES:
        QUERIES[f"final_verdict_{name}"] = lambda spark, sf_dir, name=name: vd.final_verdict(facts(spark, sf_dir, name))
    QUERIES["final_verdict_gaps_allowed"] = lambda spark, sf_dir: vd.final_verdict(
        facts(spark, sf_dir, "gaps_only"), fail_on_gaps=False
    )
    QUERIES["final_verdict_truncated"] = lambda spark, sf_dir: vd.final_verdict(_facts(spark, sf_dir, 0), True, False)


_register_branches()


@query("gap_verdict")
def gap_verdict(spark, sf_dir) -> DataFrame:
    return vd.gap_verdict(_facts(spark, sf_dir))


@query("invalid_rows_verdict")
def invalid_rows_verdict(spark, sf_dir) -> DataFrame:
    return vd.invalid_rows_verdict(md.metadata_quality(lg.parsed(spark, sf_dir)))


@query("final_verdict")
def final_verdict(spark, sf_dir) -> DataFrame:
    return vd.final_verdict(_facts(spark, sf_dir))


@query("pass_message")
def pass_message(spark, sf_dir) -> DataFrame:
    return vd.pass_message(_facts(spark, sf_dir), fail_on_gaps=False)


@query("check_continuity")
def check_continuity(spark, sf_dir) -> DataFrame:
    """Two roots and two side topics to a verdict."""
    return run_check(
        spark,
        lg.roots(spark, sf_dir),
        run_date=lg.RUN_DATE,
        side_topics=lg.side_topics(spark, sf_dir),
    ).verdict


# -- discovery, landed files --------------------------------------------------------------------


def _listing(spark, sf_dir) -> DataFrame:
    """Directory names made from order dates, with stray ones mixed in."""
    name = """
        CASE o_orderkey % 50
             WHEN 0 THEN concat('timestampcolumn=', d, 'x')
             WHEN 1 THEN concat('timestampcolumn_backup=', d)
             WHEN 2 THEN concat('timestampcolumn=', substr(d, 1, 5), '13-99')
             ELSE concat('timestampcolumn=', d) END
    """
    orders = lg.table(spark, sf_dir, "orders").withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = orders.select(
        F.expr("concat('/lake/root_', o_orderkey % 2)").alias("root"),
        F.expr(name).alias("name"),
        F.expr("o_orderkey % 50 <> 3").alias("is_dir"),
    )
    return rows.select("root", F.concat_ws("/", "root", "name").alias("path"), "name", "is_dir").distinct()


def _partitions(spark, sf_dir) -> DataFrame:
    return ds.classify_partitions(_listing(spark, sf_dir), "1998-08-02")


@query("classify_partitions")
def classify_partitions(spark, sf_dir) -> DataFrame:
    return _partitions(spark, sf_dir)


@query("eligible_paths")
def eligible_paths(spark, sf_dir) -> DataFrame:
    return ds.eligible_paths(_partitions(spark, sf_dir))


@query("ordered_eligible")
def ordered_eligible(spark, sf_dir) -> DataFrame:
    return ds.ordered_eligible(_partitions(spark, sf_dir))


@query("scan_summary")
def scan_summary(spark, sf_dir) -> DataFrame:
    """A root without any child counts 0 in every status."""
    return ds.scan_summary(_partitions(spark, sf_dir), ["/lake/root_2"])


@query("scan_roots")
def scan_roots(spark, sf_dir) -> DataFrame:
    listing = ds.scan_roots(spark, lg.roots(spark, sf_dir))
    return listing.select(F.element_at(F.split("root", "/"), -1).alias("root"), "name", "is_dir")


def _eligible(spark, sf_dir) -> DataFrame:
    listing = ds.scan_roots(spark, lg.roots(spark, sf_dir))
    return ld.read_eligible(spark, ds.require_eligible(ds.classify_partitions(listing, lg.RUN_DATE)))


@query("read_eligible")
def read_eligible(spark, sf_dir) -> DataFrame:
    return _eligible(spark, sf_dir)


@query("source_file")
def source_file(spark, sf_dir) -> DataFrame:
    """Rows per directory they came from; the full paths differ from run to run."""
    rows = ld.with_source_file(_eligible(spark, sf_dir))
    directory = F.regexp_extract("source_file", "([^/]+/[^/]+)/[^/]+$", 1)
    # A URI holds the equals sign of a directory name in escaped form on some file systems.
    return rows.groupBy(F.replace(directory, F.lit("%3D"), F.lit("=")).alias("directory")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("cross_root_union")
def cross_root_union(spark, sf_dir) -> DataFrame:
    """Each root read by itself, then both as one: the statistics see one sequence."""
    listing = ds.classify_partitions(ds.scan_roots(spark, lg.roots(spark, sf_dir)), lg.RUN_DATE)
    frames = [
        ld.read_eligible(spark, ds.require_eligible(listing.filter(F.col("root") == root)))
        for root in lg.roots(spark, sf_dir)
    ]
    return sq.partition_gap_stats(md.normalize_offsets(md.parse_metadata(ld.cross_root_union(frames))))


def _stored(spark, sf_dir) -> str:
    path = scratch_path(spark, "normalized")
    rows = ld.with_source_file(_eligible(spark, sf_dir), "_file")
    ld.persist_normalized(md.normalize_offsets(md.parse_metadata(rows, keep=["_file"]), "_file"), path)
    return path


@query("persist_normalized")
def persist_normalized(spark, sf_dir) -> DataFrame:
    """The stored rows, each with the directory of the file it came from."""
    stored = spark.read.parquet(_stored(spark, sf_dir))
    directory = F.regexp_extract("source_file", "([^/]+/[^/]+)/[^/]+$", 1)
    return stored.withColumn("source_file", F.replace(directory, F.lit("%3D"), F.lit("=")))


@query("reload_normalized")
def reload_normalized(spark, sf_dir) -> DataFrame:
    return sq.partition_gap_stats(ld.reload_normalized(spark, _stored(spark, sf_dir)))


# -- side topics --------------------------------------------------------------------------------


@query("publish_side_topic")
def publish_side_topic(spark, sf_dir) -> DataFrame:
    return lg.published(spark, sf_dir, st.DEAD_LETTER).select(
        "topic",
        F.col("key").cast("string").alias("key"),
        "partition",
        "offset",
        F.hex(F.substring("value", 1, 4)).alias("magic"),
    )


@query("publish_canary")
def publish_canary(spark, sf_dir) -> DataFrame:
    return lg.published(spark, sf_dir, st.CANARY).select(
        "topic",
        F.col("key").cast("string").alias("key"),
        "partition",
        "offset",
        F.hex(F.substring("value", 1, 4)).alias("magic"),
    )


@query("read_side_topic")
def read_side_topic(spark, sf_dir) -> DataFrame:
    return st.read_side_topic(lg.topic_table(spark, sf_dir), lg.CANARY_TOPIC).drop("value")


def _decoded(spark, sf_dir) -> DataFrame:
    topics = lg.topic_table(spark, sf_dir)
    sides = [(lg.CANARY_TOPIC, st.CANARY), (lg.DEAD_LETTER_TOPIC, st.DEAD_LETTER)]
    return ld.cross_root_union(
        st.decode_side_topic(st.read_side_topic(topics, topic), kind, topic) for topic, kind in sides
    )


@query("decode_side_topic")
def decode_side_topic(spark, sf_dir) -> DataFrame:
    return _decoded(spark, sf_dir)


@query("decoded_record_count")
def decoded_record_count(spark, sf_dir) -> DataFrame:
    """A topic without records counts 0."""
    empty = ("events-empty", st.CANARY)
    return st.decoded_record_count(st.side_topic_records(_decoded(spark, sf_dir)), [empty])


@query("synth_ledger")
def synth_ledger(spark, sf_dir) -> DataFrame:
    return synth.synth_ledger(
        lg.table(spark, sf_dir, "events"),
        id_column="event_id",
        partitions=3,
        ids_per_date=400,
        lost_every=101,
        duplicate_every=17,
        corrupt_every=53,
        extra={"region": "north"},
    )
