"""Discovery, generated ledgers, and where intermediate tables go."""

import datetime

import pytest

from tidemark import InputError
from tidemark.operators import metadata as md
from tidemark.operators import sequences as sq
from tidemark.sources import discovery as ds
from tidemark.sources import landed as ld
from tidemark.sources import synth
from tidemark.sources.scratch import materialize, release, scratch_path


@pytest.mark.parametrize("name, is_dir, status", [
    ("day=2026-07-01", True, "eligible"),
    ("day=2026-07-02", True, "skipped_run_date"),
    ("day=2026-07-03", True, "eligible"),
    ("day=2024-02-29", True, "eligible"),
    ("day=2023-02-29", True, "invalid_date"),
    ("day=2026-13-99", True, "invalid_date"),
    ("day=2026-7-1", True, "invalid_date"),
    ("day=2026-07-01x", True, "invalid_date"),
    ("day=2026-07-01\n", True, "invalid_date"),
    ("day=٢٠٢٦-07-01", True, "invalid_date"),
    ("day=", True, "invalid_date"),
    ("day=2026-07-01", False, "non_matching"),
    ("Day=2026-07-01", True, "non_matching"),
    ("day_backup=2026-07-01", True, "non_matching"),
    ("_SUCCESS", False, "non_matching"),
])
def test_classify(spark, name, is_dir, status):
    listing = spark.createDataFrame([("r", f"r/{name}", name, is_dir)], ds.LISTING_SCHEMA)
    row = ds.classify_partitions(listing, "2026-07-02", "day").first()
    assert row.status == status
    assert (row.partition_date is not None) == (status in ("eligible", "skipped_run_date"))


def test_paths_and_summary(spark):
    rows = [("r", "r/day=2026-07-03", "day=2026-07-03", True), ("r", "r/day=2026-07-01", "day=2026-07-01", True),
            ("q", "r/day=2026-07-01", "day=2026-07-01", True), ("q", "q/x", "x", False)]
    partitions = ds.classify_partitions(spark.createDataFrame(rows, ds.LISTING_SCHEMA), "2026-07-02", "day")
    assert ds.require_eligible(partitions) == ["r/day=2026-07-01", "r/day=2026-07-03"]
    assert sorted(map(tuple, ds.scan_summary(partitions).collect())) == [
        ("q", "eligible", 1), ("q", "invalid_date", 0), ("q", "non_matching", 1), ("q", "skipped_run_date", 0),
        ("r", "eligible", 2), ("r", "invalid_date", 0), ("r", "non_matching", 0), ("r", "skipped_run_date", 0)]
    empty = ds.scan_summary(partitions, ["bare", "r"]).filter("root = 'bare'").collect()
    assert sorted((r.status, r.path_count) for r in empty) == sorted((name, 0) for name in ds.STATUSES)
    assert [r.path for r in ds.ordered_eligible(partitions).collect()] == ["r/day=2026-07-01", "r/day=2026-07-03"]


def test_parameters():
    assert ds.check_roots(" a, ,b ") == ds.check_roots(["a", " ", "b"]) == ["a", "b"]
    assert ds.check_run_date(None) == datetime.date.today()
    day = datetime.date(2026, 7, 2)
    for given in ("2026-07-02", day, datetime.datetime(2026, 7, 2, 10)):
        assert type(ds.check_run_date(given)) is datetime.date and ds.check_run_date(given) == day
    for wrong in ("2026-7-2", "2026-07-02T00:00", " 2026-07-02", "20260702", "2026-02-30", 20260702):
        with pytest.raises(InputError):
            ds.check_run_date(wrong)


def test_a_run_date_with_a_time_skips_its_day(spark):
    listing = spark.createDataFrame([("r", "r/day=2026-07-02", "day=2026-07-02", True)], ds.LISTING_SCHEMA)
    row = ds.classify_partitions(listing, datetime.datetime(2026, 7, 2, 10), "day").first()
    assert row.status == "skipped_run_date"


def test_unknown_file_systems_are_input_errors(spark):
    with pytest.raises(InputError):
        ld.read_eligible(spark, ["nosuchfs://x/y"])
    with pytest.raises(InputError):
        ld.persist_normalized(spark.range(1), "nosuchfs://x/y")


def test_release_deletes_only_scratch_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    table, own = materialize(spark.range(3), "z"), spark.read.parquet(str(tmp_path / "own"))
    release(table, own)
    assert own.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        table.count()


def test_synth_ledger(spark, tmp_path):
    options = dict(partitions=2, lost_every=10, duplicate_every=7, corrupt_every=9, ids_per_date=50, extra={"zone": "z"})
    synth.write_ledger(synth.synth_ledger(spark.range(100), **options), str(tmp_path / "a"))
    landed = spark.read.parquet(str(tmp_path / "a"))
    assert landed.columns == [md.DEFAULT_METADATA_COLUMN, "topic", "payload", "zone", "timestampcolumn"]
    ids = [i for i in range(100) if i % 10]
    assert landed.count() == len(ids) + sum(i % 7 == 0 for i in ids)
    normalized = md.normalize_offsets(md.parse_metadata(landed))
    kept = [i for i in ids if i % 9]
    assert sorted(map(tuple, sq.distinct_offsets(normalized).collect())) == sorted((i % 2, i // 2) for i in kept)
    assert landed.select("timestampcolumn").distinct().count() == 2


def test_synth_column_names(spark):
    for options in ({"extra": {"topic": "x"}}, {"extra": {"a b": "x"}}, {"metadata_column": "payload"}):
        with pytest.raises(InputError):
            synth.synth_ledger(spark.range(1), **options)
    synth.synth_ledger(spark.range(1), payload=False, extra={"payload": "x"})


def test_intermediate_tables_go_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared + "/x-")
    assert materialize(spark.range(3), "y").inputFiles()[0].startswith("file://" + shared)
