"""Landed-data and side-topic scenarios, end to end, with exact results."""

import json

import pytest

from tidemark import InputError, SideTopics, check_continuity
from tidemark.sources import side_topic as st

OLD, RUN = "2026-07-01", "2026-07-02"
META = "cactus__metadata"


def meta(partition, offset):
    return json.dumps({"partition": partition, "offset": offset})


def ok(*pairs):
    return [meta(p, o) for p, o in pairs]


def land(spark, root, values, date=OLD):
    rows = [(value, f"payload-{i}") for i, value in enumerate(values)]
    frame = spark.createDataFrame(rows, f"{META} string, payload string")
    frame.write.mode("overwrite").parquet(f"{root}/timestampcolumn={date}")
    return str(root)


PASS_A, PASS_B = ok((0, 0), (0, 1), (1, 10)), ok((0, 2), (1, 11), (1, 12))
GAP = ok((0, 0), (0, 2), (1, 5))
GAP_TWO = ok((0, 0), (0, 3), (1, 5))
GAP_OVER = ok((0, 0), (0, 4), (1, 5))


def check(spark, roots, **options):
    return check_continuity(spark, roots, run_date=RUN, **options)


def code(result):
    return result.verdict.first().code


def report(result):
    """Per partition its counts and listed offsets; without a limit these follow from its runs."""
    if result.limit is None:
        found = {}
        for r in result.report.collect():
            run = list(range(r.gap_start, r.gap_end + 1)) if r.gap_start is not None else []
            before = found.get(r.partition, (0,) * 4 + ([],))[4]
            found[r.partition] = (r.distinct_offset_count, r.min_offset, r.max_offset, r.missing_offset_count,
                                  sorted(before + run), False)
        return found
    return {
        r.partition: (r.distinct_offset_count, r.min_offset, r.max_offset, r.missing_offset_count,
                      list(r.missing_offsets), r.missing_offsets_truncated)
        for r in result.report.collect()
    }


def quality(result):
    return {name: n for name, n in result.quality.first().asDict().items() if n}


# -- offsets -------------------------------------------------------------------------------------


def test_continuous_pass(spark, tmp_path):
    result = check(spark, [land(spark, tmp_path / "a", PASS_A), land(spark, tmp_path / "b", PASS_B)])
    assert code(result) == 0
    assert result.verdict.first().reason == "no gaps detected"
    assert report(result) == {0: (3, 0, 2, 0, [], False), 1: (3, 10, 12, 0, [], False)}


def test_cross_root_split_offsets(spark, tmp_path):
    a = land(spark, tmp_path / "a", ok((0, 0), (0, 2), (1, 10)))
    b = land(spark, tmp_path / "b", ok((0, 1), (1, 11), (1, 12)))
    assert code(check(spark, f"{a}, ,{b}")) == 0
    alone = check(spark, [a])
    assert code(alone) == 1 and report(alone)[0] == (2, 0, 2, 1, [1], False)


@pytest.mark.parametrize("fail_on_gaps, expected", [(True, 1), ("false", 0)])
def test_missing_offsets(spark, tmp_path, fail_on_gaps, expected):
    result = check(spark, [land(spark, tmp_path / "a", GAP)], fail_on_gaps=fail_on_gaps)
    assert code(result) == expected
    assert report(result) == {0: (2, 0, 2, 1, [1], False), 1: (1, 5, 5, 0, [], False)}
    assert result.verdict.first().raw_gap_partition_count == 1
    reason = result.verdict.first().reason
    assert reason == ("offset gaps detected: gap_partition_count=1" if expected else "offset gaps detected but fail_on_gaps=false")


def test_missing_offsets_over_limit(spark, tmp_path):
    result = check(spark, [land(spark, tmp_path / "a", GAP_OVER)], limit=2)
    assert code(result) == 1 and report(result)[0] == (2, 0, 4, 3, [1, 2], True)


def test_missing_offsets_zero_limit(spark, tmp_path):
    result = check(spark, [land(spark, tmp_path / "a", GAP)], limit=0)
    assert code(result) == 1 and report(result)[0] == (2, 0, 2, 1, [], True)


def test_duplicate_offsets(spark, tmp_path):
    result = check(spark, [land(spark, tmp_path / "a", ok((0, 0), (0, 1), (0, 1), (0, 2)))])
    assert code(result) == 0
    assert tuple(result.duplicates.first()) == (4, 3, 1)


def statuses(result):
    return {r.status: r.n for r in result.partitions.groupBy("status").count().withColumnRenamed("count", "n").collect()}


def test_run_date_partition_skipped(spark, tmp_path):
    root = land(spark, tmp_path / "a", ok((0, 0), (0, 1), (0, 2)))
    land(spark, tmp_path / "a", ok((0, 10), (0, 12)), RUN)
    (tmp_path / "a" / "timestampcolumn=not-a-date").mkdir()
    (tmp_path / "a" / "not_a_partition=2026-07-01").mkdir()
    result = check(spark, [root])
    assert code(result) == 0 and report(result)[0][:4] == (3, 0, 2, 0)
    assert statuses(result) == {"eligible": 1, "skipped_run_date": 1, "invalid_date": 1, "non_matching": 1}


def test_scan_ignores_noise(spark, tmp_path):
    root = land(spark, tmp_path / "a", ok((0, 0), (0, 1), (0, 2)))
    for name in ("timestampcolumn=2026-13-99", "timestampcolumn_backup=2026-07-01", "random_child"):
        (tmp_path / "a" / name).mkdir()
    result = check(spark, [root])
    assert code(result) == 0
    assert statuses(result) == {"eligible": 1, "invalid_date": 1, "non_matching": 2}


def test_dates_after_the_run_date_are_read(spark, tmp_path):
    root = land(spark, tmp_path / "a", ok((0, 0)))
    land(spark, tmp_path / "a", ok((0, 2)), "2026-07-03")
    assert report(check(spark, [root]))[0] == (2, 0, 2, 1, [1], False)


def test_persisted_normalized_offsets(spark, tmp_path):
    roots = [land(spark, tmp_path / "a", PASS_A), land(spark, tmp_path / "b", [*PASS_B, "{bad-json"])]
    path = str(tmp_path / "normalized")
    result = check(spark, roots, normalized_path=path, fail_on_invalid_rows=False)
    assert quality(result) == {
        "eligible_row_count": 7, "malformed_json_count": 1, "invalid_row_count": 1, "valid_offset_row_count": 6}
    assert code(result) == 0 and report(result)[1] == (3, 10, 12, 0, [], False)
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes) == {
        "partition": "int", "offset": "bigint", "metadata_json": "string", "source_file": "string"
    }
    assert stored.count() == 6
    assert all(r.source_file.startswith("file:///") and r.source_file.endswith(".parquet") for r in stored.collect())
    held = {r.metadata_json: r.source_file.replace("%3D", "=").split("/")[-3:-1] for r in stored.collect()}
    assert held[PASS_A[0]] == ["a", f"timestampcolumn={OLD}"] and held[PASS_B[0]] == ["b", f"timestampcolumn={OLD}"]
    with pytest.raises(InputError, match="cannot write"):
        check(spark, roots, normalized_path=path, normalized_overwrite=False)
    assert code(check(spark, roots, normalized_path=path, fail_on_invalid_rows=False)) == 0


def test_all_invalid_input_leaves_a_stored_copy_alone(spark, tmp_path):
    path = str(tmp_path / "normalized")
    check(spark, [land(spark, tmp_path / "a", PASS_A)], normalized_path=path)
    with pytest.raises(InputError, match="zero valid"):
        check(spark, [land(spark, tmp_path / "b", [None])], normalized_path=path)
    assert spark.read.parquet(path).count() == 3


INVALID = {
    "malformed_json": "{bad-json",
    "missing_metadata": None,
    "missing_partition": '{"offset":1}',
    "missing_offset": '{"partition":0}',
    "non_numeric_partition": '{"partition":"abc","offset":"1"}',
    "non_numeric_offset": '{"partition":"0","offset":"abc"}',
}


@pytest.mark.parametrize("defect", INVALID)
@pytest.mark.parametrize("fatal", [True, False])
def test_invalid_rows(spark, tmp_path, defect, fatal):
    root = land(spark, tmp_path / "a", [meta(0, 0), INVALID[defect]])
    result = check(spark, [root], fail_on_invalid_rows=fatal)
    assert code(result) == int(fatal)
    assert quality(result) == {
        "eligible_row_count": 2, f"{defect}_count": 1, "invalid_row_count": 1, "valid_offset_row_count": 1
    }
    if fatal:
        assert result.verdict.first().reason == "invalid metadata rows detected: invalid_row_count=1"


def test_invalid_row_and_the_gap_it_leaves(spark, tmp_path):
    root = land(spark, tmp_path / "a", [meta(0, 0), "{bad-json", meta(0, 2)])
    assert check(spark, [root]).verdict.first().reason == (
        "invalid metadata rows detected: invalid_row_count=1; offset gaps detected: gap_partition_count=1"
    )


def test_all_invalid_metadata(spark, tmp_path):
    values = ["{bad-json", '{"partition":"x","offset":"y"}', None]
    with pytest.raises(InputError, match="zero valid") as error:
        check(spark, [land(spark, tmp_path / "a", values)])
    assert error.value.code == 2


def test_input_failures(spark, tmp_path):
    good = land(spark, tmp_path / "good", PASS_A)
    only_run = land(spark, tmp_path / "only_run", PASS_A, RUN)
    empty = land(spark, tmp_path / "empty", [])
    bare = tmp_path / "bare"
    (bare / "timestampcolumn=not-a-date").mkdir(parents=True)
    (bare / "misc=2026-07-01").mkdir()
    (tmp_path / "file").write_text("x")
    cases = [
        ([only_run], {}, "no eligible.*skipped_run_date_partition_count=1"),
        ([str(bare)], {}, "no eligible date partition below the roots$"),
        ([empty], {}, "zero rows"),
        ([str(tmp_path / "nowhere")], {}, "does not exist"),
        ([str(tmp_path / "file")], {}, "not a directory"),
        ([good], {"metadata_column": "not_present"}, "'not_present' not found"),
        ([good], {"metadata_column": META.upper()}, "not found"),
        ([good], {"limit": -1}, "limit"),
        ([], {}, "root is required"),
        (" , ", {}, "root is required"),
        ([good], {"fail_on_gaps": "maybe"}, "true or false"),
    ]
    for roots, options, message in cases:
        with pytest.raises(InputError, match=message):
            check(spark, roots, **options)
    with pytest.raises(InputError, match="run date"):
        check_continuity(spark, [good], run_date="not-a-date")


# -- side topics ---------------------------------------------------------------------------------

# Own values: the keys of records for the acceptance cases below.
DIAGNOSTICS = {
    ("orders", 0, 2): ("failed-2", "late failure", "IllegalStateException"),
}
CANARY_KEYS = [("orders", 0, 1), ("orders", 9, 7), ("payments", 0, 1), ("orders", 9, 3), ("payments", 0, 3)]
DEAD_KEYS = [("orders", 0, 2), ("payments", 0, 2), ("orders", 9, 3), ("payments", 0, 3)]
DEAD_ONLY_KEYS = [("orders", 0, 1)]

SOURCE_SCHEMA = (
    "source_key string, source_value string, source_headers map<string,string>, source_topic string, "
    "source_partition int, source_offset bigint, source_timestamp bigint, failure_event_id string, "
    "reason_msg string, exception string, partition bigint, offset bigint"
)


def topic(spark, name, kind, keys):
    rows = [
        (f"{t}-{p}-{o}", None, {"h": "v"}, t, p, o, 1710000000000 + o,
         *DIAGNOSTICS.get((t, p, o), ("evt", "reason", "Error")), 0, i)
        for i, (t, p, o) in enumerate(keys)
    ]
    frame = spark.createDataFrame(rows, SOURCE_SCHEMA)
    return st.publish_side_topic(frame, kind, name, keep=["partition", "offset"])


def sides(spark, canary, dead, source="orders"):
    return SideTopics(
        source,
        "orders-canary" if canary is not None else None,
        topic(spark, "orders-canary", st.CANARY, canary) if canary is not None else None,
        "orders-dlq" if dead is not None else None,
        topic(spark, "orders-dlq", st.DEAD_LETTER, dead) if dead is not None else None,
    )


def buckets(result):
    found = {}
    for r in result.reconciliation.buckets.collect():
        found.setdefault((r.bucket, r.partition), []).append(r.offset)
        side = {"canary_explained": "orders-canary", "dead_letter_explained": "orders-dlq"}.get(r.bucket)
        assert (r.source_topic, r.side_topic) == (result.reconciliation.side_topics.source_topic, side)
    return {key: "[" + ",".join(map(str, sorted(offsets))) + "]" for key, offsets in found.items()}


# name: (landed, limit, canary, dead letter, source, code, C, D, U, bounded, records)
SIDE_CASES = {
    "canary_empty_dead_letter_resolved": (GAP, 1000, CANARY_KEYS, [], "orders", 0, "[1]", None, None, 1, (5, 0)),
    "canary_empty_dead_letter_unresolved": (GAP_TWO, 1000, CANARY_KEYS, [], "orders", 1, "[1]", None, "[2]", 2, (5, 0)),
    "empty_canary_dead_letter_resolved": (GAP, 1000, [], DEAD_ONLY_KEYS, "orders", 0, None, "[1]", None, 1, (0, 1)),
    "empty_canary_dead_letter_unresolved": (GAP_TWO, 1000, [], DEAD_ONLY_KEYS, "orders", 1, None, "[1]", "[2]", 2, (0, 1)),
    "canary_dead_letter_resolved": (GAP_TWO, 1000, CANARY_KEYS, DEAD_KEYS, "orders", 0, "[1]", "[2]", None, 2, (5, 4)),
    "canary_dead_letter_truncated": (GAP_OVER, 2, CANARY_KEYS, DEAD_KEYS, "orders", 1, "[1]", "[2]", None, 2, (5, 4)),
    "canary_dead_letter_unresolved": (GAP_OVER, 1000, CANARY_KEYS, DEAD_KEYS, "orders", 1, "[1]", "[2]", "[3]", 3, (5, 4)),
    "wrong_topic": (GAP_OVER, 1000, CANARY_KEYS, DEAD_KEYS, "shipments", 1, None, None, "[1,2,3]", 3, (5, 4)),
    "canary_only": (GAP, 1000, CANARY_KEYS, None, "orders", 0, "[1]", None, None, 1, (5, 0)),
    "limit_zero": (GAP, 0, CANARY_KEYS, DEAD_KEYS, "orders", 1, None, None, None, 0, (5, 4)),
    "no_gaps": (PASS_A, 1000, CANARY_KEYS, DEAD_KEYS, "orders", 0, None, None, None, 0, (5, 4)),
}


@pytest.mark.parametrize("name", SIDE_CASES)
def test_side_topics(spark, tmp_path, name):
    values, limit, canary, dead, source, want_code, c, d, u, bounded, records = SIDE_CASES[name]
    result = check(spark, [land(spark, tmp_path / "a", values)], limit=limit, side_topics=sides(spark, canary, dead, source))
    wanted = {("canary_explained", 0): c, ("dead_letter_explained", 0): d, ("unresolved", 0): u}
    assert buckets(result) == {key: text for key, text in wanted.items() if text}
    summary = result.reconciliation.summary.first()
    assert summary.bounded_missing_offset_count == bounded
    every = [p for p in (c, d, u) if p]
    if limit == 1000:
        assert summary.total_missing_offset_count == bounded
        assert summary.unresolved_count == (u.count(",") + 1 if u else 0), every
    assert (summary.canary_record_count, summary.dead_letter_record_count) == records
    assert summary.dead_letter_failure_event_id_count == summary.dead_letter_explained_count
    assert code(result) == want_code
    reason = result.verdict.first().reason
    if name in ("canary_dead_letter_truncated", "limit_zero"):
        assert reason.startswith("missing offsets truncated after side-topic reconciliation")
    elif want_code:
        assert reason.startswith("unresolved offset gaps after side-topic reconciliation: raw_gap_partition_count=1")


def test_counts_cover_all_missing_offsets_whatever_the_limit(spark, tmp_path):
    """Expected counts come from sets over a whole range, the listing is cut."""
    landed = [o for o in range(0, 400) if o % 3 == 0 or o % 7 == 0]
    missing = set(range(min(landed), max(landed))) - set(landed)
    canary = [o for o in range(-5, 500) if o % 4 == 1]
    dead = [o for o in range(-5, 500) if o % 5 == 1]
    root = land(spark, tmp_path / "a", ok(*((2, o) for o in landed)))
    topics = sides(spark, [("orders", 2, o) for o in canary], [("orders", 2, o) for o in dead])
    for limit in (None, 7):
        s = check(spark, [root], limit=limit, side_topics=topics).reconciliation.summary.first()
        assert s.canary_explained_count == len(missing & set(canary))
        assert s.dead_letter_explained_count == s.dead_letter_exception_count == len(missing & set(dead))
        assert s.unresolved_count == len(missing - set(canary) - set(dead))
        assert s.total_missing_offset_count == len(missing)
        assert s.bounded_missing_offset_count == (7 if limit else len(missing))
        listed = sorted(missing)[:limit]
        assert s.bounded_unresolved_count == len(set(listed) - set(canary) - set(dead))


def test_scan_summary_of_a_run_and_release(spark, tmp_path):
    bare = tmp_path / "bare"
    bare.mkdir()
    result = check(spark, [land(spark, tmp_path / "a", PASS_A), str(bare)], side_topics=sides(spark, CANARY_KEYS, []))
    counts = {(r.root, r.status): r.path_count for r in result.scan_summary.collect()}
    assert counts[str(bare), "eligible"] == 0 and counts[str(tmp_path / "a"), "eligible"] == 1
    decoded = {(r.side_topic, r.kind): r.decoded_record_count for r in result.reconciliation.decoded_record_counts.collect()}
    assert decoded == {("orders-canary", "canary"): 5, ("orders-dlq", "dead_letter"): 0}
    result.release()
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        result.words.count()


def test_side_topic_parameters(spark):
    rows = topic(spark, "c", st.CANARY, CANARY_KEYS)
    for wrong in [("", "c", rows), ("orders",), ("orders", "c"), ("orders", None, rows)]:
        with pytest.raises(InputError):
            SideTopics(*wrong)


def test_undecodable_payload_fails_even_without_gaps(spark, tmp_path):
    bad = spark.sql("SELECT 'orders-bad-canary' AS topic, 0 AS partition, 17L AS offset, "
                    "cast('not-an-avro-object-container' AS binary) AS value")
    with pytest.raises(InputError, match="topic=orders-bad-canary offset=17"):
        check(spark, [land(spark, tmp_path / "a", PASS_A)], side_topics=SideTopics("orders", "orders-bad-canary", bad))


def test_unreadable_side_topic_is_an_input_failure(spark, tmp_path):
    broken = spark.sql("SELECT 't' AS topic, 0 AS partition, id AS offset, "
                       "cast(raise_error('no broker') AS binary) AS value FROM range(3)")
    with pytest.raises(InputError, match="cannot read side topics .*no broker"):
        check(spark, [land(spark, tmp_path / "a", PASS_A)], side_topics=SideTopics("orders", "t", broken))


def test_missing_connector_is_an_input_failure(spark):
    with pytest.raises(InputError, match="orders-canary"):
        st.read_side_topic(spark, "orders-canary", st.kafka_reader_options("orders-canary", {"bootstrap.servers": "x:1"}))
