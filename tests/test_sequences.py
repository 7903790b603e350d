"""Sequence operators against brute force, on shapes chosen to cross every range boundary."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark import InputError
from tidemark.operators import sequences as sq

TOP = 2**63 - 1
BUCKET = 1 << (sq.WORD_SHIFT + sq.BUCKET_SHIFT)
ZONE = BUCKET << sq.ZONE_SHIFT


def frame(spark, pairs):
    return spark.createDataFrame(list(pairs), "partition int, offset bigint").repartition(3)


def brute_gaps(pairs):
    gaps = []
    for p in {p for p, _ in pairs}:
        values, prior = sorted({o for q, o in pairs if q == p}), 0
        for a, b in zip(values, values[1:]):
            if b - a > 1:
                gaps.append((p, a + 1, b - 1, b - a - 1, prior))
                prior += b - a - 1
    return sorted(gaps)


def brute_missing(pairs, limit):
    listed = []
    for p, start, end, size, prior in brute_gaps(pairs):
        take = min(size, limit - prior)
        listed += [(p, o) for o in range(start, start + max(take, 0))]
    return sorted(listed)


def shapes():
    rng = random.Random(7)
    yield "dense", [(p, o) for p in range(3) for o in range(2000) if rng.random() > 0.05]
    yield "sparse", [(p, rng.randrange(5000)) for p in range(4) for _ in range(300)]
    yield "runs", [(p, o + 777) for p in range(2) for o in range(6000) if o % 97 > p * 3 and o // 40 % 5]
    yield "buckets", [(0, b * BUCKET + d) for b in (0, 1, 2, 5, 6) for d in (0, 1, 31, 32, 33, BUCKET - 1)]
    yield "zones", [(p, z * ZONE + d) for p in (0, 1) for z in (0, 1, 3) for d in (0, BUCKET, ZONE - 1, 5 + p)]
    yield "wide", [(0, rng.randrange(2**62)) for _ in range(200)] + [(0, 0), (0, TOP)]
    yield "hot", [(0, 5)] * 500 + [(0, 9), (1, 5), (2, 7), (2, 9)]
    yield "negative", [(0, o) for o in range(-100, 100) if o % 7] + [(1, -BUCKET - 3), (1, -BUCKET + 2), (1, -1), (1, 40)]
    yield "single", [(0, 0), (1, TOP), (2, TOP - 1), (2, TOP)]


CASES = dict(shapes())


@pytest.mark.parametrize("name", CASES)
def test_against_brute_force(spark, name):
    pairs = CASES[name]
    df = frame(spark, pairs)
    gaps = brute_gaps(pairs)
    assert sorted(map(tuple, sq.prior_missing(df).collect())) == gaps
    assert sorted(map(tuple, sq.gap_intervals(df).collect())) == [gap[:4] for gap in gaps]
    for limit in (1, 7) if name != "dense" else (0, 1000):
        assert sorted(map(tuple, sq.missing_offsets(df, limit).collect())) == brute_missing(pairs, limit)

    following = {}
    for p, o in sorted(set(pairs), reverse=True):
        following[p, o] = min((q for r, q in following if r == p and q > o), default=None) if len(pairs) < 700 else None
    if len(pairs) < 700:
        got = {(r.partition, r.offset): r.next_offset for r in sq.next_offset(df).collect()}
        assert got == following

    stats = {r.partition: r for r in sq.partition_gap_stats(df).collect()}
    for p in {p for p, _ in pairs}:
        values = {o for q, o in pairs if q == p}
        span = max(values) - min(values) + 1
        row = stats[p]
        assert (row.distinct_offset_count, row.min_offset, row.max_offset) == (len(values), min(values), max(values))
        assert row.span == row.expected_count == (span if span <= TOP else None)
        assert row.missing_offset_count == span - len(values) and row.has_gaps == (span > len(values))
    assert tuple(sq.duplicate_summary(df).first()) == (len(pairs), len(set(pairs)), len(pairs) - len(set(pairs)))


def test_random_sets(spark):
    """Many small random keys at once, each with its own density and start."""
    rng = random.Random(11)
    pairs = []
    for p in range(150):
        start, width = rng.choice([0, 3, BUCKET - 40, ZONE - 25, 2**40 - 9]), rng.choice([3, 40, 90, 400])
        pairs += [(p, start + rng.randrange(width)) for _ in range(rng.randrange(1, 60))]
    df = frame(spark, pairs)
    assert sorted(map(tuple, sq.prior_missing(df).collect())) == brute_gaps(pairs)
    for limit in (1, 13, 250):
        assert sorted(map(tuple, sq.missing_offsets(df, limit).collect())) == brute_missing(pairs, limit)


@pytest.mark.parametrize("fill, words, marks", [(64, 1 << 20, 1 << 12), (2, 40, 3), (1 << 20, 1 << 20, 1), (0, 0, 8)])
def test_sparse_zones_are_one_bucket(spark, monkeypatch, fill, words, marks):
    """However zones are chosen to be cut, and whoever shares a mark, the gaps are the same."""
    monkeypatch.setattr(sq, "SPARSE_FILL", fill)
    monkeypatch.setattr(sq, "SPARSE_WORDS", words)
    monkeypatch.setattr(sq, "ZONE_MARKS", marks)
    rng = random.Random(fill + marks)
    sparse = [(p, rng.randrange(-2 * ZONE, 3 * ZONE)) for p in range(3) for _ in range(40 * p + 5)]
    dense = [(3, 7 * ZONE + o) for o in range(500) if o % 11] + [(3, 7 * ZONE + 9 * BUCKET), (3, 8 * ZONE)]
    pairs = sparse + dense
    df = frame(spark, pairs)
    assert sorted(map(tuple, sq.prior_missing(df).collect())) == brute_gaps(pairs)
    chosen = sq._with_buckets(sq._pack(df, "partition", "offset"), "partition")
    zones = chosen.groupBy("partition", F.shiftright("word", sq.BUCKET_SHIFT + sq.ZONE_SHIFT).alias("zone")).agg(
        F.count_distinct("bucket").alias("n"), F.count_distinct(F.shiftright("word", sq.BUCKET_SHIFT)).alias("cut")
    ).collect()
    if marks == 1 << 12:
        # the few words of this fixture leave every zone sparse
        assert all(z.n == 1 for z in zones) and any(z.cut > 1 for z in zones)
    if fill == 0:
        assert all(z.n == z.cut for z in zones)


def test_a_limit_above_the_chunk_size(spark):
    df = frame(spark, [(0, 0), (0, 200_000), (0, 200_002), (1, 4), (1, 6)])
    limit = 150_000
    listed = sq.missing_offsets(df, limit)
    got = listed.groupBy("partition").agg(
        F.count(F.lit(1)), F.countDistinct("missing_offset"), F.min("missing_offset"), F.max("missing_offset")
    )
    assert sorted(map(tuple, got.collect())) == [(0, limit, limit, 1, limit), (1, 1, 1, 5, 5)]
    for whole in (sq.missing_offsets(df, 10**12), sq.missing_offsets(df)):
        assert whole.count() == 199_999 + 1 + 1


def test_a_very_long_gap_gives_its_first_rows(spark):
    df = frame(spark, [(0, 0), (0, 10**15)])
    first = [r.missing_offset for r in sq.missing_offsets(df).limit(5).collect()]
    assert len(first) == 5 and all(0 < n < 10**15 for n in first)
    assert sorted(r.missing_offset for r in sq.missing_offsets(df, 3).collect()) == [1, 2, 3]
    assert sq.missing_offsets(df, 2**62).limit(1).count() == 1


def test_the_highest_bit_is_exact(spark):
    ends = "explode(array(shiftleft(1L, cast(id as int)), shiftleft(2L, cast(id as int)) - 1)) as bits"
    every = spark.range(32).selectExpr("id", ends)
    assert every.filter(sq._high_bit(F.col("bits")) != F.col("id")).count() == 0


def test_ordered_missing_and_runs(spark):
    df = frame(spark, [(1, 3), (1, 1), (0, 0), (0, 4), (2, 5)])
    assert [tuple(r) for r in sq.ordered_missing(sq.missing_offsets(df)).collect()] == [(0, 1), (0, 2), (0, 3), (1, 2)]
    runs = sq.gap_report(sq.pack_sequences(df)).select("partition", "gap_start", "gap_end").collect()
    assert sorted(map(str, runs)) == sorted(map(str, [
        Row(partition=0, gap_start=1, gap_end=3), Row(partition=1, gap_start=2, gap_end=2),
        Row(partition=2, gap_start=None, gap_end=None)]))
    with pytest.raises(InputError, match="needs a limit"):
        sq.stats_with_report(sq.partition_gap_stats(df), sq.prior_missing(df), None)


def test_truncation_and_report(spark):
    df = frame(spark, [(0, 0), (0, 4), (1, 5)])
    stats = sq.partition_gap_stats(df)
    assert [tuple(r) for r in sq.truncation_flag(stats, 2).collect()] == [(0, 3, True)]
    assert sq.any_truncated(stats, 2).first()[0] is True
    assert sq.any_truncated(stats, 3).first()[0] is False
    assert sq.any_truncated(stats, None).first()[0] is False
    report = sq.ordered_report(sq.stats_with_report(stats, sq.prior_missing(df), 2)).collect()
    assert [(r.partition, r.missing_offsets, r.missing_offsets_truncated) for r in report] == [
        (0, "[1,2]", True), (1, "[]", False)
    ]


@pytest.mark.parametrize("part", [1, 3, 4, 1000])
def test_long_lists_go_on_in_further_rows(spark, part):
    draw = random.Random(part)
    seen = [(p, o) for p in range(3) for o in sorted(draw.sample(range(60), 20))]
    df = frame(spark, [*seen, (7, 5), (7, 6)])
    for limit in (0, 1, 4, 7, 100):
        report = sq.stats_with_report(sq.partition_gap_stats(df), sq.prior_missing(df), limit, part=part).collect()
        for p in (0, 1, 2, 7):
            own = [o for q, o in [*seen, (7, 5), (7, 6)] if q == p]
            want = [o for o in range(min(own), max(own)) if o not in own][:limit]
            lists = sorted(r.missing_offsets for r in report if r.partition == p)
            assert [o for row in lists for o in row] == want and lists
            assert all(len(row) <= part for row in lists) and all(len(row) == part for row in lists[:-1])


def test_a_huge_limit_lists_in_bounded_rows(spark):
    """Three million missing offsets under a limit of 2 ** 62: no row holds more than a part of them."""
    df = frame(spark, [(0, 0), (0, 3_000_001), (1, 0), (1, 2**61)])
    report = sq.stats_with_report(sq.partition_gap_stats(df).filter("partition = 0"), sq.prior_missing(df).filter("partition = 0"), 2**62)
    row = report.agg(F.max(F.size("missing_offsets")), F.sum(F.size("missing_offsets")), F.sum(F.expr("aggregate(missing_offsets, 0L, (a, x) -> a + x)"))).first()
    assert tuple(row) == (sq.LIST_PART, 3_000_000, 3_000_000 * 3_000_001 // 2)
    top = sq.stats_with_report(sq.partition_gap_stats(df).filter("partition = 1"), sq.prior_missing(df).filter("partition = 1"), 20_000).collect()
    assert [o for r in sorted(top, key=lambda r: r.missing_offsets[0]) for o in r.missing_offsets] == list(range(1, 20_001))


def test_other_column_names_and_nulls(spark):
    df = spark.createDataFrame([("x", 1), ("x", 3), ("x", None), (None, 2)], "source string, number int")
    got = sq.gap_intervals(df, "source", "number").collect()
    assert [tuple(r) for r in got] == [("x", 2, 2, 1)]


@pytest.mark.parametrize("limit", [-1, 1.5, "7", 2**62 + 1, 2**63, True])
def test_limits_are_checked(spark, limit):
    with pytest.raises(InputError):
        sq.missing_offsets(frame(spark, [(0, 0)]), limit)


def plan_of(df):
    """The plan that ran, subqueries included; initial plans, also those of subqueries, are left out."""
    df.collect()
    kept, skipped = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth >= skipped:
            continue
        skipped = depth if "== Initial Plan ==" in line else None
        if skipped is None:
            kept.append(line)
    return "\n".join(kept)


def test_one_scan_serves_all_branches(spark, tmp_path):
    path = str(tmp_path / "pairs")
    frame(spark, CASES["dense"]).write.parquet(path)
    for operator in (sq.prior_missing, sq.next_offset, sq.missing_offsets):
        plan = plan_of(operator(spark.read.parquet(path)))
        # The other uses of the packed form reuse the exchange above the one scan.
        assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan, plan
