"""Decoding, publishing and reconciling side topics."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import InputError
from tidemark.operators import reconcile as rc
from tidemark.operators import sequences as sq
from tidemark.operators import verdict as vd
from tidemark.sources import side_topic as st
from tidemark.sources.container import read_container, write_container

FIELDS = [
    {"name": "sourceKey", "type": ["null", "string"]},
    {"name": "sourceValue", "type": ["null", "bytes"]},
    {"name": "sourceHeaders", "type": {"type": "map", "values": "string"}},
    {"name": "sourceTopic", "type": "string"},
    {"name": "sourcePartition", "type": "int"},
    {"name": "sourceOffset", "type": "long"},
    {"name": "sourceKafkaTimestamp", "type": "long"},
]
DEAD = FIELDS + [{"name": n, "type": ["null", "string"]} for n in st.DIAGNOSTIC_FIELDS]
VALUES = {
    "sourceKey": None, "sourceValue": None, "sourceHeaders": {}, "sourceTopic": " orders ", "sourcePartition": 3,
    "sourceOffset": 41, "sourceKafkaTimestamp": 0, "failureEventId": " e ", "reasonMsg": "  ", "exception": None,
}


@pytest.fixture(scope="module")
def encode(spark):
    """Containers written by the JVM's own Avro library, which the operators do not use."""
    import json

    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    avro = jvm.org.apache.avro

    def to_java(value):
        if isinstance(value, bytes):
            return jvm.java.nio.ByteBuffer.wrap(value)
        if isinstance(value, dict):
            result = jvm.java.util.HashMap()
            for name, item in value.items():
                result.put(name, to_java(item))
            return result
        if isinstance(value, list):
            result = jvm.java.util.ArrayList()
            for item in value:
                result.add(to_java(item))
            return result
        return value

    def write(fields, rows, codec=None):
        text = json.dumps({"type": "record", "name": "Some", "namespace": "a.b", "fields": fields})
        schema = avro.Schema.Parser().parse(text)
        out = jvm.java.io.ByteArrayOutputStream()
        writer = avro.file.DataFileWriter(avro.generic.GenericDatumWriter(schema))
        if codec:
            writer.setCodec(avro.file.CodecFactory.fromString(codec))
        writer.create(schema, out)
        for row in rows:
            record = avro.generic.GenericData.Record(schema)
            for field in fields:
                value = row[field["name"]]
                record.put(field["name"], to_java(value))
            writer.append(record)
        writer.close()
        return bytes(out.toByteArray())

    return write


def decode(spark, payloads, kind=st.DEAD_LETTER):
    rows = [("t", 0, i, payload) for i, payload in enumerate(payloads)]
    frame = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary")
    return st.decode_side_topic(frame, kind, "side")


def retyped(fields, **types):
    return [{**f, "type": types.get(f["name"], f["type"])} for f in fields]


def test_decode_containers_of_another_writer(spark, encode):
    payloads = [encode(DEAD, [VALUES, {**VALUES, "sourceOffset": -5, "sourceValue": b"\x00\xff"}]),
                encode(DEAD, [{**VALUES, "sourceHeaders": {"a": "1", "b": "2"}}] * 300, "deflate")]
    decoded = decode(spark, payloads)
    st.require_decoded(decoded)
    records = st.side_topic_records(decoded)
    counts = {tuple(r)[:-1]: r.n for r in records.groupBy(*records.columns).agg(F.count(F.lit(1)).alias("n")).collect()}
    row = (st.DEAD_LETTER, "side", "orders", 3)
    assert counts == {(*row, 41, "e", None, None): 301, (*row, -5, "e", None, None): 1}
    assert [tuple(r) for r in st.decoded_record_count(records).collect()] == [("side", st.DEAD_LETTER, 302)]


def test_numbers_in_other_types(spark, encode):
    wide = retyped(FIELDS, sourceTopic="bytes", sourcePartition="string", sourceOffset="double")
    values = {**VALUES, "sourceTopic": b" o\t", "sourcePartition": "+12", "sourceOffset": 7.9}
    nested = retyped(FIELDS, sourceValue={"type": "array", "items": {"type": "record", "name": "In", "fields": [
        {"name": "x", "type": ["null", "a.b.In", "long"]}]}})
    payloads = [encode(wide, [values]), encode(nested, [{**VALUES, "sourceValue": []}])]
    got = st.side_topic_records(decode(spark, payloads, st.CANARY)).collect()
    assert {(r.source_topic, r.source_partition, r.source_offset) for r in got} == {("o", 12, 7), ("orders", 3, 41)}


def test_broken_payloads_are_all_reported(spark, encode):
    good = encode(DEAD, [VALUES])
    text = retyped(DEAD, sourcePartition="string")
    nullable = retyped(DEAD, sourceOffset=["null", "long"])
    cases = [
        (None, "empty"), (b"", "empty"), (b"not-an-avro-object-container", "not an Avro"),
        (encode(DEAD, []), "zero records"), (good[:-3], "truncated"), (good[:-16] + bytes(16), "sync"),
        (good[:40], "undecodable|truncated"), (encode(FIELDS, [VALUES]), "schema lacks field failureEventId"),
        (encode(DEAD[:3] + DEAD[4:], [VALUES]), "schema lacks field sourceTopic"),
        (encode(DEAD, [{**VALUES, "sourceTopic": "  "}]), "no value for sourceTopic"),
        (encode(text, [{**VALUES, "sourcePartition": " 1"}]), "not a number"),
        (encode(text, [{**VALUES, "sourcePartition": "2147483648"}]), "does not fit an int"),
        (encode(text, [{**VALUES, "sourcePartition": "9" * 30}]), "not a number"),
        (encode(nullable, [{**VALUES, "sourceOffset": 2**40}, {**VALUES, "sourceOffset": None}]), "no value for sourceOffset"),
        (encode(retyped(DEAD, sourcePartition="boolean"), [{**VALUES, "sourcePartition": True}]), "no numeric type"),
        (encode(DEAD, [VALUES], "bzip2"), "codec"),
    ]
    import re

    decoded = decode(spark, [payload for payload, _ in cases] + [good])
    errors = {r.kafka_offset: r.decode_error for r in st.decode_errors(decoded).collect()}
    assert sorted(errors) == list(range(len(cases)))
    for offset, (_, pattern) in enumerate(cases):
        assert re.search(pattern, errors[offset]), (offset, errors[offset])
    assert st.side_topic_records(decoded).count() == 1
    with pytest.raises(InputError, match=f"{len(cases)} side-topic payloads .*topic=t offset=0: payload is empty"):
        st.require_decoded(decoded)


def test_published_payloads_are_read_by_another_reader(spark):
    rows = [("k", None, {"h": "ü"}, "orders", 2, 2**40, 5, "evt", None, "E")]
    schema = ("source_key string, source_value string, source_headers map<string,string>, source_topic string, "
              "source_partition int, source_offset bigint, source_timestamp bigint, failure_event_id string, "
              "reason_msg string, exception string")
    frame = spark.createDataFrame(rows, schema)
    row = st.publish_side_topic(frame, st.DEAD_LETTER, "dlq").first()
    assert (row.topic, bytes(row.key)) == ("dlq", b"k")
    assert read_container(bytes(row.value))[0]["sourceHeaders"] == [("h", "ü")]
    jvm = spark._jvm
    avro = jvm.org.apache.avro
    reader = avro.file.DataFileReader(
        avro.file.SeekableByteArrayInput(bytes(row.value)), avro.generic.GenericDatumReader()
    )
    record = reader.next()
    assert record.getSchema().getName() == "DeadLetterRecord"
    assert record.get("sourceOffset") == 2**40 and str(record.get("exception")) == "E"
    assert record.get("reasonMsg") is None and not reader.hasNext()


def test_reader_options():
    options = st.kafka_reader_options("t", {"bootstrap.servers": "b:9092", "request.timeout.ms": "5"}, "Beginning")
    assert options == {
        "kafka.request.timeout.ms": "5", "kafka.default.api.timeout.ms": "10000",
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest",
        "endingOffsets": "latest", "failOnDataLoss": "true",
    }
    with pytest.raises(InputError):
        st.check_starting_offsets("latest")


# -- reconciliation ------------------------------------------------------------------------------

RECORD_SCHEMA = ("kind string, side_topic string, source_topic string, source_partition int, source_offset bigint, "
                 "failure_event_id string, reason_msg string, exception string")


def records(spark, kind, keys, diagnostics=(None, None, None)):
    return spark.createDataFrame([(kind, "side", *key, *diagnostics) for key in keys], RECORD_SCHEMA)


@pytest.mark.parametrize("seed", range(3))
def test_classification_against_sets(spark, seed):
    """Generated sequences and records; every expected count comes from Python sets."""
    draw = random.Random(seed)
    landed = {p: sorted(draw.sample(range(p * 1000, p * 1000 + 300), 120)) for p in range(4)}
    gaps = {(p, o) for p, seen in landed.items() for o in range(seen[0], seen[-1]) if o not in set(seen)}

    def keys_of(count):
        return [(draw.choice(["orders", "orders", "others"]), p, p * 1000 + draw.randrange(-20, 330))
                for p in (draw.randrange(6) for _ in range(count))]

    canary_keys, dead_keys = keys_of(400), keys_of(300)
    canary = records(spark, st.CANARY, canary_keys)
    dead = records(spark, st.DEAD_LETTER, dead_keys, ("e", None, "x"))
    in_canary = {k[1:] for k in canary_keys if k[0] == "orders"} & gaps
    in_dead = {k[1:] for k in dead_keys if k[0] == "orders"} & gaps
    unresolved = gaps - in_canary - in_dead
    wanted = {("canary_explained", *k) for k in in_canary} | {("dead_letter_explained", *k) for k in in_dead}
    wanted |= {("unresolved", *k) for k in unresolved}

    df = spark.createDataFrame([(p, o) for p, seen in landed.items() for o in seen], "partition int, offset bigint")
    keys = rc.missing_keys(sq.missing_offsets(df), "orders")
    buckets = rc.bucket_offsets(rc.classify_missing(keys, canary, dead), "c", "d")
    assert {(r.bucket, r.partition, r.offset) for r in buckets.collect()} == wanted
    assert sum(r.offset_count for r in rc.bucket_counts(buckets).collect()) == len(wanted)
    order = [(r.partition, r.offset) for r in rc.ordered_buckets(buckets).collect()]
    assert order == sorted(order)
    assert {(r.source_partition, r.source_offset) for r in rc.explained_by(keys, canary).collect()} == in_canary
    assert {(r.source_partition, r.source_offset) for r in rc.unresolved(keys, canary, dead).collect()} == unresolved

    words, both = sq.pack_sequences(df), canary.unionByName(dead)
    stats = sq.packed_gap_stats(words)
    whole = rc.explain_ledger(words, stats, both, "orders")
    listed = rc.explain_keys(keys, both.filter("source_topic = 'orders'"))
    assert sorted(map(tuple, whole.select(*listed.columns).collect())) == sorted(map(tuple, listed.collect()))
    marked = rc.marked_words(words, stats, canary, "orders")
    assert {(r.source_partition, r.source_offset) for r in rc.explained_keys(marked, "orders").collect()} == in_canary
    runs = rc.unresolved_runs(marked).collect()
    assert {(r.partition, o) for r in runs for o in range(r.gap_start, r.gap_end + 1)} == gaps - in_canary
    assert sum(r.gap_size for r in runs) == len(gaps - in_canary)
    repeats = sum(k[0] == "orders" and k[1:] in in_dead for k in dead_keys)
    for limit in (None, 5):
        listed = None if limit is None else rc.explain_keys(rc.missing_keys(sq.missing_offsets(df, limit), "orders"), both)
        s = rc.reconciliation_summary(words, stats, both, "orders", limit, listed).first()
        assert (s.canary_explained_count, s.dead_letter_explained_count) == (len(in_canary), len(in_dead))
        assert (s.unresolved_count, s.total_missing_offset_count) == (len(unresolved), len(gaps))
        assert (s.canary_record_count, s.dead_letter_record_count) == (400, 300)
        assert (s.dead_letter_failure_event_id_count, s.dead_letter_reason_msg_count) == (repeats, 0)
        first = {k for p in range(4) for k in sorted(g for g in gaps if g[0] == p)[:limit]}
        assert s.bounded_missing_offset_count == len(first)
        assert s.bounded_unresolved_count == len(first & unresolved)
        assert s.missing_offsets_truncated is (limit is not None)


@pytest.mark.parametrize("number", [b"\xff" * 9 + b"\x7f", b"\xff" * 9 + b"\x02"])
def test_numbers_beyond_64_bits_are_error_rows(spark, number):
    for name in ("sourcePartition", "sourceOffset"):
        schema = st.payload_schema(st.CANARY).replace('"int"', '"long"')
        parts = {"sourcePartition": b"\x02", "sourceOffset": b"\x02", name: number}
        datum = b"\x00\x00\x00" + b"\x02t" + parts["sourcePartition"] + parts["sourceOffset"] + b"\x02"
        value = write_container(schema, datum)
        rows = spark.createDataFrame([("t", 0, 17, value)], "topic string, partition int, offset bigint, value binary")
        got = st.decode_side_topic(rows, st.CANARY, "t").collect()
        assert len(got) == 1 and "64 bits" in got[0].decode_error and got[0].kafka_offset == 17


def test_overlap_counts_in_both(spark):
    keys = rc.missing_keys(spark.createDataFrame([(0, 1)], "partition int, missing_offset bigint"), "o")
    row = rc.classify_missing(
        keys, records(spark, st.CANARY, [("o", 0, 1)]), records(spark, st.DEAD_LETTER, [("o", 0, 1)])
    ).first()
    assert (row.in_canary, row.in_dead_letter, row.unresolved) == (True, True, False)


def test_unresolved_runs_expand_no_offset(spark):
    """A run of 2 ** 61 missing offsets around one explained key stays two rows."""
    df = spark.createDataFrame([(0, 0), (0, 2**61), (1, 5), (None, 3)], "partition int, offset bigint")
    words = sq.pack_sequences(df.dropna())
    side = records(spark, st.CANARY, [("o", 0, 1000), ("o", 0, 0), ("o", 0, -4), ("o", 0, 2**61 + 9), ("x", 0, 7), ("o", 9, 1), ("o", 1, 5)])
    marked = rc.marked_words(words, sq.packed_gap_stats(words), side, "o")
    runs = rc.unresolved_runs(marked)
    assert sorted(map(tuple, runs.collect())) == [(0, 1, 999, 999), (0, 1001, 2**61 - 1, 2**61 - 1001)]
    assert [tuple(row) for row in rc.explained_keys(marked, "o").collect()] == [("o", 0, 1000, True, False, False)]
    assert rc.unresolved_runs(marked.limit(0)).collect() == []


def test_only_heavy_keys_are_matched_apart(spark):
    """A key outside the summary is neither copied nor sent to all tasks, and every repeat stays."""
    rows = spark.range(20_000).selectExpr(
        "'dead_letter' AS kind", "'side' AS side_topic", "'o' AS source_topic", "0 AS source_partition",
        "CASE WHEN id % 3 = 0 THEN 1L WHEN id % 5 = 0 THEN 2L ELSE id END AS source_offset", "concat('e', id) AS failure_event_id",
        "cast(NULL AS string) AS reason_msg", "cast(NULL AS string) AS exception")
    keys = rows.filter("source_offset <> 2").select(*rc.RECORD_KEY).distinct()
    heavy = rc.heavy_keys(rows, 0.05)
    hashes = {r[0]: r[1] for r in rows.selectExpr("xxhash64(source_topic, source_partition, source_offset)", "source_offset").distinct().collect()}
    assert sorted(hashes[h] for h in heavy) == [1, 2]
    matched = rc.matched_records(rows, keys, share=0.05)
    expected = rows.filter("source_offset <> 2")
    assert matched.exceptAll(expected).isEmpty() and expected.exceptAll(matched).isEmpty()
    plan = matched._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("strategy=broadcast") == 1
    assert rc.heavy_keys(rows.limit(0), 0.05) == [] and rc.matched_records(rows.limit(0), keys).collect() == []
    none = rc.matched_records(rows, keys, share=0.9)
    assert none.exceptAll(expected).isEmpty() and none.count() == expected.count()


def test_matched_records_keep_every_repeat_of_a_hot_key(spark):
    keys = rc.missing_keys(spark.createDataFrame([(0, 1), (0, 2)], "partition int, missing_offset bigint"), "o")
    hot = spark.range(0, 5000, 1, 8).selectExpr(
        "'dead_letter' AS kind", "'side' AS side_topic", "'o' AS source_topic", "0 AS source_partition",
        "CASE WHEN id % 3 = 0 THEN 1L ELSE id END AS source_offset", "concat('e', id) AS failure_event_id",
        "cast(NULL AS string) AS reason_msg", "cast(id AS string) AS exception")
    matched = rc.matched_records(hot, keys)
    expected = hot.filter("source_offset IN (1, 2)")
    assert matched.exceptAll(expected).isEmpty() and expected.exceptAll(matched).isEmpty()
    fields = rc.dead_letter_fields(matched).first()
    assert (fields.failure_event_id_count, fields.reason_msg_count) == (expected.count(), 0)


# -- verdicts ------------------------------------------------------------------------------------


@pytest.mark.parametrize("gaps, side, unresolved, truncated, fails, message", [
    (0, False, None, None, False, "no gaps detected"),
    (2, False, None, None, True, "offset gaps detected but fail_on_gaps=false"),
    (0, True, 0, False, False, "no gaps detected"),
    (2, True, 0, False, False, "side-topic reconciliation resolved all bounded missing offsets"),
    (2, True, 0, True, True, "unresolved offsets present but fail_on_gaps=false"),
    (2, True, 5, False, True, "unresolved offsets present but fail_on_gaps=false"),
    (2, True, 5, True, True, "unresolved offsets present but fail_on_gaps=false"),
])
def test_gap_verdict(spark, gaps, side, unresolved, truncated, fails, message):
    base = spark.createDataFrame([(0, gaps)], "invalid_row_count bigint, raw_gap_partition_count bigint")
    frames = [base]
    if side:
        frames.append(spark.createDataFrame(
            [(1, 1, unresolved, unresolved, 9, truncated)],
            "canary_explained_count bigint, dead_letter_explained_count bigint, unresolved_count bigint, "
            "bounded_unresolved_count bigint, "
            "bounded_missing_offset_count bigint, missing_offsets_truncated boolean"))
    facts = vd.verdict_facts(*frames, side_topic_enabled=side)
    assert vd.gap_verdict(facts).first().failed is fails
    assert vd.gap_verdict(facts, fail_on_gaps=False).first().failed is False
    assert vd.pass_message(facts, fail_on_gaps=False).first().pass_message == message
    final = vd.final_verdict(facts, fail_on_gaps=False).first()
    assert (final.code, final.reason) == (0, message)
    strict = vd.final_verdict(facts).first()
    assert strict.code == int(fails) and (strict.unresolved_count == unresolved)
