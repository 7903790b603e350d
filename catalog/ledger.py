"""A ledger derived from the ``events`` table, used by the registered queries.

``event_id`` is dense, so ``event_id % 4`` serves as partition and ``event_id div 4`` as
offset. Some events count as lost, some went to a canary or dead-letter side topic, and the
rest landed, a few of them with defective metadata.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import metadata as md
from tidemark.operators import sequences as sq
from tidemark.plans.continuity import SideTopics
from tidemark.sources import side_topic as st
from tidemark.sources.scratch import materialize, scratch_path

SOURCE_TOPIC = "events"
CANARY_TOPIC = "events-canary"
DEAD_LETTER_TOPIC = "events-dlq"
METADATA = md.DEFAULT_METADATA_COLUMN
RUN_DATE = "2024-01-30"

IS_CANARY = "event_type = 'signup' AND user_id % 10 = 0"
IS_DEAD_LETTER = "event_type = 'error' AND user_id % 10 = 1"
IS_LOST = "event_id % 1000 BETWEEN 400 AND 439"

METADATA_TEXT = """
    CASE WHEN event_id % 211 = 0 THEN NULL
         WHEN event_id % 223 = 0 THEN '{bad-json'
         WHEN event_id % 227 = 0 THEN concat('{"offset":', o, '}')
         WHEN event_id % 229 = 0 THEN concat('{"partition":', p, '}')
         WHEN event_id % 233 = 0 THEN concat('{"partition":"abc","offset":', o, '}')
         WHEN event_id % 239 = 0 THEN concat('{"partition":', p, ',"offset":"xyz"}')
         ELSE concat('{"partition":', p, ',"offset":', o, '}') END
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a sequence of order keys per line number, with repeats and gaps."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("partition"), F.col("l_orderkey").alias("offset")
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "event_type", "cast(event_id % 4 as int) AS p", "event_id div 4 AS o"
    )


def landed(spark: SparkSession, sf_dir: str, metadata_column: str = METADATA) -> DataFrame:
    kept = events(spark, sf_dir).filter(f"NOT ({IS_CANARY}) AND NOT ({IS_DEAD_LETTER}) AND NOT ({IS_LOST})")
    return kept.select(
        "event_id", "ts", "event_type", F.expr(METADATA_TEXT).alias(metadata_column)
    )


def parsed(spark: SparkSession, sf_dir: str, keep=("event_id",)) -> DataFrame:
    return md.parse_metadata(landed(spark, sf_dir), METADATA, keep=list(keep))


def source_records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Rows to publish to a side topic; every seventh dead letter is there twice."""
    condition = IS_CANARY if kind == st.CANARY else IS_DEAD_LETTER
    copies = "CASE WHEN event_id % 7 = 0 THEN array(0, 1) ELSE array(0) END" if kind == st.DEAD_LETTER else "array(0)"
    rows = events(spark, sf_dir).filter(condition)
    return rows.select("*", F.expr(f"explode({copies})").alias("copy")).selectExpr(
        "event_id",
        "cast(event_id AS string) AS source_key",
        "CASE WHEN event_id % 2 = 0 THEN concat('value-', event_id) END AS source_value",
        "map('origin', event_type) AS source_headers",
        f"'{SOURCE_TOPIC}' AS source_topic",
        "p AS source_partition",
        "o AS source_offset",
        "1710000000000 + o AS source_timestamp",
        "concat('evt-', event_id) AS failure_event_id",
        "CASE WHEN event_id % 3 = 0 THEN '  ' ELSE concat('reason ', event_id % 5) END AS reason_msg",
        "CASE WHEN event_id % 5 <> 0 THEN 'IllegalStateException' END AS exception",
        "event_id % 3 AS partition",
        "event_id * 2 + copy AS offset",
    )


def records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The same records as they read after decoding."""
    rows = source_records(spark, sf_dir, kind)
    topic = CANARY_TOPIC if kind == st.CANARY else DEAD_LETTER_TOPIC
    absent = "cast(NULL AS string)"

    def text(name):
        return f"nullif(trim({name}), '')" if kind == st.DEAD_LETTER else absent

    return rows.selectExpr(
        f"'{kind}' AS kind",
        f"'{topic}' AS side_topic",
        "source_topic",
        "source_partition",
        "source_offset",
        f"{text('failure_event_id')} AS failure_event_id",
        f"{text('reason_msg')} AS reason_msg",
        f"{text('exception')} AS exception",
    )


def published(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    topic = CANARY_TOPIC if kind == st.CANARY else DEAD_LETTER_TOPIC
    keep = ["partition", "offset"]
    return st.publish_side_topic(source_records(spark, sf_dir, kind), kind, topic, keep=keep)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return md.normalize_offsets(parsed(spark, sf_dir))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed ledger as a stored table, for queries that read it more than once."""
    return materialize(sq.pack_sequences(normalized(spark, sf_dir)), "ledger")


def missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.missing_offsets(normalized(spark, sf_dir))


_written: dict = {}


def _once(spark: SparkSession, key: tuple, make):
    """One scratch table per session for the queries that read the same one."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _written:
        _written[key] = make()
    return _written[key]


def roots(spark: SparkSession, sf_dir: str) -> list:
    """The landed rows as two date-partitioned roots, so that each sequence is split."""

    def make():
        base = scratch_path(spark, "roots")
        rows = landed(spark, sf_dir).select("event_id", METADATA, F.to_date("ts").alias("timestampcolumn"))
        paths = [f"{base}/root_a", f"{base}/root_b"]
        for half, path in enumerate(paths):
            rows.filter(F.col("event_id") % 2 == half).write.partitionBy("timestampcolumn").parquet(path)
        return paths

    return _once(spark, ("roots", sf_dir), make)


def topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both side topics as one stored table of Kafka-shaped rows."""

    def make():
        both = published(spark, sf_dir, st.CANARY).unionByName(published(spark, sf_dir, st.DEAD_LETTER))
        return materialize(both, "side-topics")

    return _once(spark, ("topics", sf_dir), make)


def side_topics(spark: SparkSession, sf_dir: str) -> SideTopics:
    topics = topic_table(spark, sf_dir)
    return SideTopics(
        SOURCE_TOPIC,
        CANARY_TOPIC,
        st.read_side_topic(topics, CANARY_TOPIC),
        DEAD_LETTER_TOPIC,
        st.read_side_topic(topics, DEAD_LETTER_TOPIC),
    )
