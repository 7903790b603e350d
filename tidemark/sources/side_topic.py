"""Canary and dead-letter side topics: reading, decoding and publishing."""

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import ENGINE_ERRORS, InputError
from tidemark.sources.container import (
    Symbol,
    read_container,
    write_container,
    write_long,
    write_optional_text,
    write_text,
    write_text_map,
)

CANARY = "canary"
DEAD_LETTER = "dead_letter"

# Field names and record names of the side-topic payloads.
KEY_FIELDS = ["sourceKey", "sourceValue", "sourceHeaders", "sourceTopic", "sourcePartition", "sourceOffset"]
COMMON_FIELDS = [*KEY_FIELDS, "sourceKafkaTimestamp"]
DIAGNOSTIC_FIELDS = ["failureEventId", "reasonMsg", "exception"]
NEEDED_FIELDS = frozenset(["sourceTopic", "sourcePartition", "sourceOffset", *DIAGNOSTIC_FIELDS])
RECORD_NAMES = {CANARY: "CanaryRecord", DEAD_LETTER: "DeadLetterRecord"}

REQUIRED_FIELDS = {CANARY: COMMON_FIELDS, DEAD_LETTER: COMMON_FIELDS + DIAGNOSTIC_FIELDS}

RECORD_COLUMNS = [
    "kind",
    "side_topic",
    "source_topic",
    "source_partition",
    "source_offset",
    "failure_event_id",
    "reason_msg",
    "exception",
]
DECODED_SCHEMA = (
    "kind string, side_topic string, source_topic string, source_partition int, source_offset bigint, "
    "failure_event_id string, reason_msg string, exception string, "
    "kafka_topic string, kafka_offset bigint, decode_error string"
)

# Everything up to the space character is trimmed, control characters included.
TRIMMED = "".join(map(chr, range(33)))

#: Decoded rows are handed on in parts of about this many.
DECODED_ROWS = 4096

# Defaults of the bounded Kafka read, which broker settings may override.
KAFKA_TIMEOUTS = {"kafka.request.timeout.ms": "10000", "kafka.default.api.timeout.ms": "10000"}


# -- reading -----------------------------------------------------------------------------------


def check_starting_offsets(start: str | None) -> str:
    """``earliest``; ``beginning`` means the same, and nothing else is accepted."""
    text = (start or "earliest").strip().lower()
    if text not in ("earliest", "beginning"):
        raise InputError(f"side-topic start must be earliest: {start!r}")
    return "earliest"


def kafka_reader_options(
    topic: str, broker: dict, starting_offsets: str | None = None, min_partitions: int | None = None
) -> dict:
    """Options of a bounded batch read of one topic.

    ``broker`` holds client settings without the ``kafka.`` prefix. ``min_partitions`` lets
    Spark cut a topic partition that holds most of the records into several tasks.
    """
    options = dict(KAFKA_TIMEOUTS)
    options.update({f"kafka.{name}": value for name, value in broker.items()})
    options["subscribe"] = topic
    options["startingOffsets"] = check_starting_offsets(starting_offsets)
    options["endingOffsets"] = "latest"
    options["failOnDataLoss"] = "true"
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_side_topic(source, topic: str, options: dict | None = None) -> DataFrame:
    """Rows ``topic, partition, offset, value`` of one side topic.

    ``source`` is a session, to read from Kafka with ``options``, or a frame that holds
    Kafka-shaped rows already, for example a Parquet copy of a topic.
    """
    if isinstance(source, DataFrame):
        rows = source.filter(F.col("topic") == topic)
    else:
        try:
            rows = source.read.format("kafka").options(**(options or {})).load()
        except ENGINE_ERRORS as error:
            raise InputError(f"cannot read side topic {topic}: {error}") from error
    return rows.select("topic", "partition", "offset", "value")


# -- decoding ----------------------------------------------------------------------------------


def _as_text(value):
    """Trimmed text of a field, None if absent or blank."""
    if value is None:
        return None
    if isinstance(value, bytes):
        value = value.decode("utf-8", "replace")
    elif isinstance(value, bool):
        value = "true" if value else "false"
    return str(value).strip(TRIMMED) or None


def _as_long(record, name):
    value = record[name]
    if value is None:
        raise ValueError(f"no value for {name}")
    if isinstance(value, float):
        value = 0 if math.isnan(value) else int(max(-(2.0**63), min(value, 2.0**63)))
        return max(-(2**63), min(value, 2**63 - 1))
    if isinstance(value, int) and not isinstance(value, bool):
        if not -(2**63) <= value < 2**63:
            raise ValueError(f"{name} does not fit a long: {value}")
        return value
    if isinstance(value, str) and not isinstance(value, Symbol):
        if re.fullmatch(r"[+-]?\d+", value) and -(2**63) <= int(value) < 2**63:
            return int(value)
        raise ValueError(f"{name} is not a number: {value}")
    raise ValueError(f"{name} has no numeric type: {type(value).__name__}")


def _decode_record(record, kind):
    if not isinstance(record, dict):
        raise ValueError("payload does not hold records")
    for name in REQUIRED_FIELDS[kind]:
        if name not in record:
            raise ValueError(f"schema lacks field {name}")
    topic = _as_text(record["sourceTopic"])
    if topic is None:
        raise ValueError("no value for sourceTopic")
    partition = _as_long(record, "sourcePartition")
    if not -(2**31) <= partition < 2**31:
        raise ValueError(f"sourcePartition does not fit an int: {partition}")
    diagnostics = [_as_text(record.get(name)) for name in DIAGNOSTIC_FIELDS]
    return [topic, partition, _as_long(record, "sourceOffset"), *diagnostics]


def decode_side_topic(rows: DataFrame, kind: str, side_topic: str) -> DataFrame:
    """Side-topic records of Kafka-shaped rows, and a row for each payload that is broken.

    One broken record makes its whole payload an error row: ``decode_error`` says what is
    wrong and ``kafka_topic``/``kafka_offset`` say where. Use ``side_topic_records`` and
    ``decode_errors`` to tell the two apart.
    """

    def decode(batches):
        schema = pa.schema(
            [(name, pa.string()) for name in ("kind", "side_topic", "source_topic")]
            + [("source_partition", pa.int32()), ("source_offset", pa.int64())]
            + [(name, pa.string()) for name in ("failure_event_id", "reason_msg", "exception", "kafka_topic")]
            + [("kafka_offset", pa.int64()), ("decode_error", pa.string())]
        )
        def rows_of(out):
            columns = zip(*out) if out else [[] for _ in schema]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
            )

        for batch in batches:
            out = []
            for topic, offset, value in zip(*(batch.column(c).to_pylist() for c in ("topic", "offset", "value"))):
                try:
                    records = [_decode_record(record, kind) for record in read_container(value, NEEDED_FIELDS)]
                    out += [[kind, side_topic, *record, topic, offset, None] for record in records]
                except ValueError as error:
                    out.append([kind, side_topic, *[None] * 6, topic, offset, str(error)])
                if len(out) >= DECODED_ROWS:
                    yield rows_of(out)
                    out = []
            yield rows_of(out)

    return rows.select("topic", "offset", "value").mapInArrow(decode, DECODED_SCHEMA)


def side_topic_records(decoded: DataFrame) -> DataFrame:
    return decoded.filter("decode_error IS NULL").select(*RECORD_COLUMNS)


def decode_errors(decoded: DataFrame) -> DataFrame:
    return decoded.filter("decode_error IS NOT NULL").select("kafka_topic", "kafka_offset", "decode_error")


def require_decoded(decoded: DataFrame, shown: int = 20) -> None:
    """Raise if any payload is broken; the message counts all and names the first few.

    The error carries the frame of all of them as ``details``.
    """
    errors = decode_errors(decoded)
    first = errors.orderBy("kafka_topic", "kafka_offset").limit(shown).collect()
    if first:
        lines = "; ".join(f"topic={e.kafka_topic} offset={e.kafka_offset}: {e.decode_error}" for e in first)
        raise InputError(f"{errors.count()} side-topic payloads cannot be decoded: {lines}", details=errors)


def decoded_record_count(records: DataFrame, topics=()) -> DataFrame:
    """Records per side topic and kind; ``topics`` are such pairs that count 0 when absent."""
    counts = records.groupBy("side_topic", "kind").agg(F.count(F.lit(1)).alias("decoded_record_count"))
    if not topics:
        return counts
    pairs = F.array(*(F.struct(F.lit(topic).alias("side_topic"), F.lit(kind).alias("kind")) for topic, kind in topics))
    absent = records.sparkSession.range(1).select(F.inline(pairs), F.lit(0).cast("bigint").alias("decoded_record_count"))
    return counts.unionByName(absent).groupBy("side_topic", "kind").agg(
        F.sum("decoded_record_count").alias("decoded_record_count")
    )


# -- publishing --------------------------------------------------------------------------------


def payload_schema(kind: str) -> str:
    """The Avro schema of a side-topic payload."""

    def optional(name):
        return {"name": name, "type": ["null", "string"], "default": None}

    fields = [
        optional("sourceKey"),
        optional("sourceValue"),
        {"name": "sourceHeaders", "type": {"type": "map", "values": "string"}},
        {"name": "sourceTopic", "type": "string"},
        {"name": "sourcePartition", "type": "int"},
        {"name": "sourceOffset", "type": "long"},
        {"name": "sourceKafkaTimestamp", "type": "long"},
    ]
    if kind == DEAD_LETTER:
        fields += [optional(name) for name in DIAGNOSTIC_FIELDS]
    return json.dumps({"type": "record", "name": RECORD_NAMES[kind], "fields": fields})


def publish_side_topic(records: DataFrame, kind: str, side_topic: str, keep=()) -> DataFrame:
    """Encode records as Kafka rows ``topic, key, value``; the key is the source key's bytes.

    Input columns: ``source_key, source_value, source_headers, source_topic,
    source_partition, source_offset, source_timestamp`` and, for dead letters,
    ``failure_event_id, reason_msg, exception``. ``keep`` names integer columns to carry
    along, such as the ``partition`` and ``offset`` of a table that stands for a topic.
    Write the result with ``.write.format('kafka')`` or to a Parquet table.
    """
    schema_text = payload_schema(kind)
    names = ["source_key", "source_value", "source_headers", "source_topic"]
    names += ["source_partition", "source_offset", "source_timestamp"]
    if kind == DEAD_LETTER:
        names += ["failure_event_id", "reason_msg", "exception"]
    keep = list(keep)

    def encode(batches):
        for batch in batches:
            values = []
            for key, value, headers, topic, partition, offset, stamp, *diagnostics in zip(
                *(batch.column(name).to_pylist() for name in names)
            ):
                datum = [write_optional_text(key), write_optional_text(value), write_text_map(headers or [])]
                datum += [write_text(topic), write_long(partition), write_long(offset), write_long(stamp)]
                datum += [write_optional_text(text) for text in diagnostics]
                values.append(write_container(schema_text, b"".join(datum)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([side_topic] * len(values), pa.string()),
                    batch.column("source_key").cast(pa.binary()),
                    pa.array(values, pa.binary()),
                    *(batch.column(name).cast(pa.int64()) for name in keep),
                ],
                names=["topic", "key", "value", *keep],
            )

    carried = "".join(f", {name} bigint" for name in keep)
    return records.select(*names, *keep).mapInArrow(encode, "topic string, key binary, value binary" + carried)
