"""Edge cases of metadata text, row by row."""

import pytest

from tidemark.functions import numeric_guard, quoted_column
from tidemark.operators import metadata as md
from pyspark.sql import functions as F

META = md.DEFAULT_METADATA_COLUMN

# text: (defects, partition, offset)
ROWS = {
    None: ({"missing_metadata"}, None, None),
    "": ({"malformed_json"}, None, None),
    "   ": ({"malformed_json"}, None, None),
    "null": ({"malformed_json"}, None, None),
    "5": ({"malformed_json"}, None, None),
    "[]": ({"malformed_json"}, None, None),
    '[{"partition":1,"offset":2}]': ({"malformed_json"}, None, None),
    '{"partition":1,"offset":2': ({"malformed_json"}, None, None),
    "{}": ({"missing_partition", "missing_offset"}, None, None),
    '{"partition":null,"offset":1}': ({"missing_partition"}, None, 1),
    '{"Partition":1,"offset":2}': ({"missing_partition"}, None, 2),
    '{"partition":"","offset":"007"}': ({"non_numeric_partition"}, None, 7),
    '{"partition":1.5,"offset":-1}': ({"non_numeric_partition", "non_numeric_offset"}, None, None),
    '{"partition":99999999999,"offset":99999999999999999999}': (
        {"non_numeric_partition", "non_numeric_offset"}, None, None
    ),
    '{"partition":1e3,"offset":true}': ({"non_numeric_partition", "non_numeric_offset"}, None, None),
    '{"partition":{"a":1},"offset":[1]}': ({"non_numeric_partition", "non_numeric_offset"}, None, None),
    '{"partition":"x"}': ({"non_numeric_partition", "missing_offset"}, None, None),
    '{"partition":" 3 ","offset":" 4\\t"}': ({"non_numeric_offset"}, 3, None),
    '{"partition":"12\\n","offset":5}': (set(), 12, 5),
    "{'partition':1,'offset':2}": (set(), 1, 2),
    '{"partition":1,"offset":2,"partition":7}': (set(), 7, 2),
    '{"partition":1,"offset":1} trailing': (set(), 1, 1),
    '{"partition":2147483647,"offset":9223372036854775807}': (set(), 2**31 - 1, 2**63 - 1),
    '{"partition":2147483648,"offset":9223372036854775808}': (
        {"non_numeric_partition", "non_numeric_offset"}, None, None
    ),
    '{"topic":"t","partition":"0","offset":"3","extra":{"offset":9}}': (set(), 0, 3),
}


@pytest.fixture(scope="module")
def parsed(spark):
    return md.parse_metadata(spark.createDataFrame([(text,) for text in ROWS], f"{META} string"))


def test_each_row(parsed):
    got = {
        r[md.P.raw]: ({name for name, bit in md.DEFECTS.items() if r.defects & bit}, r[md.P.partition], r[md.P.offset])
        for r in parsed.withColumn("defects", md.defect_mask()).collect()
    }
    assert got == ROWS


def test_predicates_agree_with_the_mask(parsed):
    checks = [(name, getattr(md, f"is_{name}")()) for name in md.DEFECTS]
    flags = parsed.select(
        md.defect_mask().alias("defects"),
        md.is_valid().alias("valid"),
        md.is_invalid().alias("invalid"),
        *(condition.alias(name) for name, condition in checks),
    ).collect()
    for row in flags:
        assert row.valid is (row.defects == 0) and row.invalid is (row.defects != 0)
        for name, bit in md.DEFECTS.items():
            assert row[name] is bool(row.defects & bit)


def test_profile_from_rows_and_from_the_ledger(parsed):
    direct = md.metadata_quality(parsed).first().asDict()
    assert md.ledger_quality(md.pack_ledger(parsed)).first().asDict() == direct
    valid = sum(not defects for defects, _, _ in ROWS.values())
    assert direct["eligible_row_count"] == len(ROWS)
    assert (direct["valid_offset_row_count"], direct["invalid_row_count"]) == (valid, len(ROWS) - valid)
    assert list(direct) == md.PROFILE_COLUMNS
    assert tuple(md.input_guards(md.metadata_quality(parsed)).first()) == (True, True)


def test_profile_of_nothing(spark):
    none = md.parse_metadata(spark.createDataFrame([], f"{META} string"))
    for quality in (md.metadata_quality(none), md.ledger_quality(md.pack_ledger(none))):
        assert set(quality.first()) == {0}
        assert tuple(md.input_guards(quality).first()) == (False, False)


def test_ledger_words_equal_packed_rows(parsed):
    from tidemark.operators.sequences import pack_sequences

    words = md.ledger_words(md.pack_ledger(parsed))
    again = pack_sequences(md.normalize_offsets(parsed))
    assert sorted(map(tuple, words.collect())) == sorted(map(tuple, again.collect()))


def test_metadata_is_parsed_once(parsed):
    plan = md.normalize_offsets(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_plain_form_reads_like_any_other(spark):
    """The shortcut for plain texts against the JSON parser, on texts at its edges."""
    numbers = ["0", "7", "007", "-1", "1.0", "", "2147483648", "99999999999999999999", '"5"', " 3", "  3", "3 ", "٣"]
    texts = [
        template % (p, o)
        for template in (
            '{"partition":%s,"offset":%s}', '{"partition": %s, "offset": %s}', '{"partition":%s,"offset":%s}\n',
            '{"offset":%s,"partition":%s}', ' {"partition":%s,"offset":%s}', '{"partition":%s,"offset":%s}}',
            '{"partition":%s,"offset":%s,"partition":4}', '{"partition":%s,"offset":%s} ',
        )
        for p in numbers
        for o in numbers
    ]
    parsed = md.parse_metadata(spark.createDataFrame([(t,) for t in texts], f"{META} string"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": md.CORRUPT}
    slow = F.from_json(F.col(md.P.raw), md.METADATA_SCHEMA, options)
    rows = parsed.select(
        md.P.raw, md.P.json, md.P.partition_text, md.P.offset_text, slow.alias("slow")
    ).collect()
    assert len(rows) == len(texts)
    for r in rows:
        fast = r[md.P.json]
        assert (fast[md.CORRUPT] is None) == (r.slow[md.CORRUPT] is None), r
        for name, text in (("partition", r[md.P.partition_text]), ("offset", r[md.P.offset_text])):
            assert text == (None if r.slow[name] is None else r.slow[name].strip(" ")), r


def test_only_the_metadata_column_is_read(spark, tmp_path):
    path = str(tmp_path / "landed")
    spark.createDataFrame([("{}", "x")], f"{META} string, payload string").write.parquet(path)
    plan = md.pack_ledger(md.parse_metadata(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<{META}:string>" in plan


def test_any_column_name_and_castable_type(spark):
    odd = spark.createDataFrame([(7,)], "`a``b.c` int")
    assert odd.select(quoted_column("a`b.c").alias("x")).first().x == 7
    number = md.parse_metadata(odd, "a`b.c")
    assert number.select(md.is_malformed_json().alias("bad")).first().bad


def test_small_functions(spark):
    one = spark.sql("SELECT '99999999999' AS big")
    got = one.select(numeric_guard(F.col("big"), "int"), numeric_guard(F.col("big"), "bigint")).first()
    assert tuple(got) == (None, 99999999999)


def test_long_numbers_are_judged_alike_in_any_spacing(spark):
    texts = ['{"partition":1,"offset":%s}', '{ "partition":1,"offset":%s}', '{"partition": 1, "offset": %s}']
    for digits in ("7" * 18, "7" * 19, "7" * 1001):
        parsed = md.parse_metadata(spark.createDataFrame([(t % digits,) for t in texts], f"{md.DEFAULT_METADATA_COLUMN} string"))
        found = [tuple(r) for r in parsed.select(md.is_valid(), md.is_malformed_json(), md.is_non_numeric_offset()).collect()]
        assert len(set(found)) == 1


def test_a_field_of_the_parser_is_an_ordinary_field(spark):
    text = '{"partition":1,"offset":2,"_corrupt_record":"x"}'
    parsed = md.parse_metadata(spark.createDataFrame([(text,)], f"{md.DEFAULT_METADATA_COLUMN} string"))
    assert parsed.filter(md.is_valid()).count() == 1
