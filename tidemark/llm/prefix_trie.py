"""Prefix trie of conversations by truncation peeling.

A node of depth d is a distinct sequence of first d turns. The trie is found from its deepest
level up: the conversations that end at a depth meet the nodes that survived from the depth
below, equal sequences merge, each merged row is a node with its sums, and its last turn is
stripped for the next round. Copies merge at the first step, so the rows carried shrink from
level to level, and a level is one partial aggregation and one shuffle.

A sequence is known by 128 bits: two xors over its turns of hashes of place, role and text
digest. They are kept as a path, one entry per turn, cut into segments of ``SEGMENT`` turns,
so no row grows with the length of a conversation. A path's first entry is that of the empty
rest before the segment. Depths at which nothing ends and no two nodes meet are passed in one step.

Null ids name no conversation; null roles and texts are empty. Turns with equal numbers
follow each other by role, then by the MD5 of their texts; repeated rows are turns of their
own. An empty table has no node, not even a root. Other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialize, release, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SEGMENT = 4096
#: Turn numbers and conversation ids that share these high bits are counted and listed together.
BLOCK_BITS = 12
NO_TURN = -(1 << 62)
#: Depths without an end that are passed one by one before a longer way is looked for.
STEPS = 4
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def number_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv_id, place, role, digest, words)``: the turns of each conversation from 1, texts as digests.

    Places are counted in blocks of turn numbers, so a conversation of any length is sorted in parts.
    """
    turns = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.shiftright(F.col(turn).cast("long"), BLOCK_BITS), F.lit(NO_TURN)).alias("block"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.md5(F.coalesce(text, F.lit(""))).alias("digest"),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long").alias("words"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    before = blocks.select("conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    return turns.join(before, ["conv_id", "block"]).select(
        "conv_id", (F.col("before") + F.row_number().over(within)).alias("place"), "role", "digest", "words"
    )


def share_openings(turns: DataFrame, every: int = 20, shares: int = 4) -> tuple[DataFrame, DataFrame]:
    """Numbered turns rebuilt with shared openings, and the ids of all conversations.

    The first h turns of a conversation come from the one whose id is the next lower multiple
    of ``every``, the rest are its own after its first h; h is the CRC-32 of the id modulo ``shares``.
    A conversation lends its turns to fewer than ``every`` others.
    """
    shared = F.crc32(F.col("conv_id").cast("string")) % shares
    leader = F.col("conv_id") - F.col("conv_id") % every
    sizes = materialize(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "conversations")
    lent = sizes.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("leader"), F.col("n").alias("lent"))
    convs = sizes.select("conv_id", leader.alias("leader"), shared.alias("shared")).join(lent, "leader", "left")
    moved = F.least("shared", F.coalesce("lent", F.lit(0))) - F.col("shared")
    own = turns.filter(F.col("place") > shared).join(convs.select("conv_id", moved.alias("moved")), "conv_id")
    opening = turns.filter((F.col("conv_id") % every == 0) & (F.col("place") < shares)).withColumnRenamed("conv_id", "leader")
    given = convs.select("conv_id", "leader", "shared").join(opening, "leader").filter("place <= shared")
    rest = ["role", "digest", "words"]
    rebuilt = own.select("conv_id", (F.col("place") + F.col("moved")).alias("place"), *rest).union(
        given.select("conv_id", "place", *rest)
    )
    return rebuilt, sizes.select("conv_id")


def _paths(turns: DataFrame, ids: DataFrame, segment: int) -> DataFrame:
    """``(conv_id, segment, path, n_turns)``; ``n_turns`` is set in the last segment of a conversation only."""
    steps = turns.select(
        "conv_id",
        F.expr(f"(place - 1) div {segment}").alias("segment"),
        "place",
        *(F.xxhash64(F.lit(seed), "place", "role", "digest").alias(f"k{seed}") for seed in (1, 2)),
        "words",
    )
    upto = Window.partitionBy("conv_id", "segment").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = F.struct(
        "place", F.bit_xor("k1").over(upto).alias("k1"), F.bit_xor("k2").over(upto).alias("k2"), F.sum("words").over(upto).alias("total")
    )
    parts = (
        steps.select("conv_id", "segment", running.alias("step"))
        .groupBy("conv_id", "segment")
        .agg(F.array_sort(F.collect_list("step")).alias("steps"))
        .withColumn("end", F.element_at("steps", -1))
    )
    ordered = Window.partitionBy("conv_id").orderBy("segment")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "conv_id", "segment", "steps",
        *(F.coalesce(F.bit_xor(f"end.{k}").over(earlier), F.lit(0).cast("long")).alias(f"before_{k}") for k in ("k1", "k2")),
        F.when(F.lead("segment").over(ordered).isNull(), F.col("end.place")).alias("n_turns"),
    )
    no_words = F.lit(0).cast("long").alias("total")
    start = F.struct(F.col("before_k1").alias("k1"), F.col("before_k2").alias("k2"), no_words)

    def whole(step):
        return F.struct(
            step["k1"].bitwiseXOR(F.col("before_k1")).alias("k1"), step["k2"].bitwiseXOR(F.col("before_k2")).alias("k2"), step["total"].alias("total")
        )

    paths = parts.select("conv_id", "segment", F.concat(F.array(start), F.transform("steps", whole)).alias("path"), "n_turns")
    zero = F.lit(0).cast("long")
    turnless = ids.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", zero.alias("segment"), F.array(F.struct(zero.alias("k1"), zero.alias("k2"), no_words)).alias("path"), zero.alias("n_turns")
    )
    return paths.union(turnless)


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest the id lists of each sequence, which come one after the other in order, as one list."""
    key, state, least, number = None, None, None, 0

    def row():
        columns = [[key[0]], [key[1]], [key[2]], [least], [number], [state.hexdigest()]]
        kinds = [pa.int64()] * 5 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
            names=["depth", "k1", "k2", "conv_id", "n_convs", "ends"],
        )

    for batch in batches:
        for depth, k1, k2, _, ids, first, n in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if key != (depth, k1, k2):
                if key is not None:
                    yield row()
                key, state, least, number = (depth, k1, k2), hashlib.sha256(), first, 0
            else:
                state.update(b",")
            state.update(ids.encode())
            number += n
    if key is not None:
        yield row()


def _endings(paths: DataFrame) -> DataFrame:
    """``(depth, conv_id, n_convs, ends, path)``: one row per distinct whole conversation.

    ``ends`` digests the ids of all copies in ascending order. Lists hold at most
    ``2 ** BLOCK_BITS`` ids each; the lists of one sequence pass through one digest one by one.
    """
    last = paths.filter("n_turns IS NOT NULL")
    key = F.element_at("path", -1)
    lists = (
        last.groupBy(F.col("n_turns").alias("depth"), key["k1"].alias("k1"), key["k2"].alias("k2"), F.shiftright("conv_id", BLOCK_BITS).alias("block"))
        .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
        .select("depth", "k1", "k2", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"), F.col("ids")[0].alias("first"), F.size("ids").cast("long").alias("n"))
    )
    ordered = lists.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "block")
    merged = ordered.mapInArrow(_join_ids, "depth long, k1 long, k2 long, conv_id long, n_convs long, ends string")
    return merged.drop("k1", "k2").join(last.select("conv_id", "path"), "conv_id")


def _node(key: Column, parent: Column) -> list[Column]:
    return [key["k1"].alias("k1"), key["k2"].alias("k2"), parent["k1"].alias("p1"), parent["k2"].alias("p2")]


def _level(parts: list[DataFrame], depth: int, at: int) -> DataFrame:
    """The nodes of one depth from the rows that meet there."""
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    key = F.col("path")[at]
    merged = both.groupBy(key["k1"].alias("k1"), key["k2"].alias("k2")).agg(
        F.min("conv_id").alias("conv_id"), F.first("path").alias("path"), F.max("ends").alias("ends"),
        *(F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved")),
    )
    path = F.col("path")
    words = path[at]["total"] - path[at - 1]["total"] if at else F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    parent = path[at - 1] if at else {"k1": none, "k2": none}
    return merged.select(
        F.lit(depth).cast("long").alias("depth"), *_node(key, parent), "conv_id", "n_convs", "n_children",
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), (F.col("saved") + (F.col("n_convs") - 1) * words).alias("saved"), "ends", "path",
    )


def _chain(level: DataFrame, base: int, depth: int, low: int) -> DataFrame:
    """The only children's line above each node of ``depth``, for the depths from ``low`` up to it."""
    at, path = F.col("at"), F.col("path")
    each = level.drop("depth", "k1", "k2", "p1", "p2").select("*", F.explode(F.sequence(F.lit(low - base), F.lit(depth - 1 - base))).alias("at"))
    words = path[depth - 1 - base]["total"] - path[at - 1]["total"]
    return each.select(
        (at + base).cast("long").alias("depth"), *_node(path[at], path[at - 1]), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"),
        "n_leaves", (F.col("saved") + (F.col("n_convs") - 1) * words).alias("saved"), F.lit(None).cast("string").alias("ends"),
    )


def _unmerged(level: DataFrame, base: int, low: int, depth: int) -> int:
    """The smallest depth from ``low`` at which the nodes of ``depth`` are all still apart."""

    def apart(x: int) -> bool:
        key = F.col("path")[x - base]
        groups = level.groupBy(key["k1"], key["k2"]).count()
        return not groups.filter("count > 1").limit(1).count()

    high = depth
    while low < high:
        if apart(low):
            return low
        low, middle = low + 1, (low + high) // 2
        if apart(middle):
            high = middle
        else:
            low = middle + 1
    return high


def peel(turns: DataFrame, ids: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per node of the trie of ``turns(conv_id, place, role, digest, words)``.

    ``ids`` names all conversations, those without turns too. The result reads tables below
    ``spark.checkpoint.dir``, one per step; ``release`` deletes them.
    """
    spark = turns.sparkSession
    paths = materialize(_paths(turns, ids, segment), "trie-paths")
    ended = materialize(_endings(paths), "trie-endings")
    # conversations of k different lengths hold at least k * k / 2 turns, so this list is short
    ends = sorted((row["depth"] for row in ended.select("depth").distinct().collect()), reverse=True)
    if not ends:
        release(paths, ended)
        return spark.createDataFrame([], NODE)
    stored, schema, level, base = [], None, None, None
    zero = F.lit(0).cast("long")
    depth = ends[0]

    def keep(frame: DataFrame) -> DataFrame:
        path = scratch_path(spark, "trie-level")
        frame.write.parquet(path)
        stored.append(path)
        return spark.read.schema(frame.schema).parquet(path)

    while True:
        last_base, base = base, max(0, (depth - 1) // segment) * segment
        at = depth - base
        parts = []
        if level is not None:
            carried = ["conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", F.lit(None).cast("string").alias("ends")]
            if base != last_base:  # the path goes on in the segment before, which all members share
                before = paths.filter(F.col("segment") == base // segment).select("conv_id", "path")
                level = level.drop("path").join(before, "conv_id")
            parts.append(level.select(*carried, F.slice("path", 1, at + 1).alias("path")))
        if ends and depth == ends[0]:
            ends.pop(0)
            parts.append(
                ended.filter(F.col("depth") == depth).select("conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"), "ends", "path")
            )
        level = keep(_level(parts, depth, at))
        schema = schema or level.drop("path").schema
        if depth == 0:
            break
        low = max((ends[0] if ends else 0) + 1, base + 1)
        if depth - low > STEPS and (low := _unmerged(level, base, low, depth)) < depth:
            keep(_chain(level, base, depth, low))
            words = F.col("path")[depth - 1 - base]["total"] - F.col("path")[low - 1 - base]["total"]
            level = level.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * words)
            depth = low
        depth -= 1
    release(paths, ended)
    nodes = spark.read.schema(schema).parquet(*stored)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256().hexdigest()
    return nodes.join(parents, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(empty)).alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT
) -> DataFrame:
    """The trie of the conversations as they stand: a row per node, see ``NODE`` for its columns."""
    turns = materialize(number_turns(conversations, conv_id, turn, role, text), "trie-turns")
    trie = peel(turns, turns.select("conv_id").distinct(), segment)
    release(turns)
    return trie


def shared_opening_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT
) -> DataFrame:
    """The trie of the conversations rebuilt by ``share_openings``."""
    turns = materialize(number_turns(conversations, conv_id, turn, role, text), "trie-turns")
    rebuilt, ids = share_openings(turns)
    trie = peel(rebuilt, ids, segment)
    release(turns, ids)
    return trie
