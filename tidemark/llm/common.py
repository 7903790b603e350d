"""Helpers that several operators of this subpackage share."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.sources.scratch import materialize, release

ROWS = 512
HOT_KEYS = 1024
#: A bit map of ids: bits per id, bits in a piece (those of Spark's bitmap functions) and the most pieces, 16 MB.
ID_BITS = 16
PIECE_BITS = 32768
PIECES = 4096


def arrow_map(df: DataFrame, schema: str, factory: Callable[[], Callable], rows: int = ROWS) -> DataFrame:
    """Run Python over ``df`` in slices of ``rows`` rows.

    ``factory()`` is called once per task and returns a function from the columns of a slice,
    as lists, to the columns of ``schema``, as lists of any common length.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = work(*(column.to_pylist() for column in batch.slice(at, rows).columns))
                arrays = [pa.array(values, field.type) for values, field in zip(out, fields, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.mapInArrow(run, schema)


def join_counted(rows: DataFrame, counted: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``counted``, which has one row per ``key`` and its number ``n`` of rows.

    The ``HOT_KEYS`` keys with most rows are matched by broadcast, each other one holds at
    most one row in ``HOT_KEYS`` and is matched by an ordinary join. Rows without a key, kept
    by a left join, take part in no shuffle. The columns of ``counted`` are small.
    """
    hot = counted.orderBy(F.desc("n"), key).limit(HOT_KEYS)
    tagged = rows.join(F.broadcast(hot), key, "left")
    rest = tagged.filter(F.col("n").isNull() & F.col(key).isNotNull()).select(*rows.columns)
    done = tagged.filter(F.col("n").isNotNull() | (F.col(key).isNull() if how == "left" else F.lit(False)))
    return done.unionByName(rest.join(counted, key, how))


def narrowed(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``ids`` (one column of the same type).

    A row whose key is among them always stays. One in 16 of the others does, more beyond eight
    million ids, where the bit map of their hashes, which every task gets, has its full size of
    16 MB. It is for wide rows before a join that would send all of them.
    """
    pieces = min(PIECES, max(1, -(-ids.count() * ID_BITS // PIECE_BITS)))
    place = lambda column: F.pmod(F.xxhash64(column), F.lit(pieces * PIECE_BITS)) + 1
    marks = ids.select(place(ids.columns[0]).alias("__place")).withColumn("__piece", F.bitmap_bucket_number("__place"))
    # dealt by piece first: else each task would send a whole piece for its few bits
    marks = marks.repartition("__piece").groupBy("__piece").agg(F.bitmap_construct_agg(F.bitmap_bit_position("__place")).alias("__marks"))
    placed = rows.withColumn("__place", place(key)).withColumn("__piece", F.bitmap_bucket_number("__place"))
    placed = placed.withColumn("__bit", F.bitmap_bit_position("__place"))
    byte = "cast(conv(hex(substring(__marks, cast(__bit div 8 + 1 as int), 1)), 16, 10) as int)"
    held = F.expr(f"shiftright({byte}, cast(__bit % 8 as int)) & 1 = 1")
    return placed.join(F.broadcast(marks), "__piece").filter(held).select(*rows.columns)


def connected(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``edges(a, b)``, where component is its smallest member.

    Each round hooks every root onto the smallest root next to it and then follows the
    pointers up, so chains shrink by a constant factor a round. Rounds are written to the
    shared folder, and all but the last are deleted again. A node with very many neighbours
    only meets partial aggregates and joins in which its own side has one row.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b")
    links = materialize(both.distinct(), "edges")
    labels = materialize(
        links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("component")), "labels",
    )
    while True:
        labels = _jump(labels)
        near = links.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        # the smallest component next to any member is proposed to the component's root
        hooks = (
            labels.join(near, labels["node"] == near["a"])
            .groupBy("component").agg(F.min("near").alias("near"))
            .filter("near < component")
        )
        hooks = materialize(hooks, "hooks")
        if not hooks.limit(1).count():
            release(links, hooks)
            return labels
        moved = labels.join(hooks.withColumnRenamed("component", "root"), F.col("component") == F.col("root"), "left")
        before, labels = labels, materialize(moved.select("node", F.coalesce("near", "component").alias("component")), "labels")
        release(before, hooks)


def _jump(labels: DataFrame) -> DataFrame:
    """Follow pointers until each leads to a node that points to itself."""
    while True:
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        moved = labels.join(up, "component", "left").select(
            "node", F.coalesce("up", "component").alias("component"), (F.col("up") < F.col("component")).alias("moved")
        )
        before, moved = labels, materialize(moved, "labels")
        release(before)
        labels = moved.select("node", "component")
        if not moved.filter("moved").limit(1).count():
            return labels
