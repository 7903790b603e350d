"""MinHash near-duplicates with tensored banding.

A table key of ``2 * WIDTH`` minhashes is a pair: one of ``SKETCHES`` left sketches and one
of as many right sketches, each of ``WIDTH`` minhashes. All pairs together are
``SKETCHES ** 2`` tables for the price of ``2 * SKETCHES * WIDTH`` minhashes. Two documents
at similarity s share no table with a chance below ``2 * (1 - s ** WIDTH) ** SKETCHES``: one in
ten thousand at 0.75, one in 300,000 at 0.8.

Before pairs are formed, sketches that no second document shares are dropped; they cannot
lead to a shared table, and in most corpora few documents are left after that. Only the texts
of those that share a table are sent on, found by a bit map of their ids.

Documents that meet in a table form groups. A group is compared exactly on the full shingle
sets, block against block, and each block pair returns only a spanning forest of its links,
never all of them. In a large group blocks are cut along the distance to one member of it:
by the triangle inequality blocks further apart than the limit hold no link, and blocks
that are wholly linked to that member need no comparison among themselves.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, connected, join_counted, narrowed
from tidemark.sources.scratch import materialize, release

SHINGLE = 5
PERCENT = 75
WIDTH = 3
SKETCHES = 18
SEED = 20240901
BLOCK = 256
BANDS = 40

ODD = np.uint64(0x9E3779B97F4A7C15)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    codes, names = pd.factorize(np.array(words, dtype=object))
    return pd.util.hash_array(np.array([name.decode("latin-1") for name in names], dtype=object), categorize=False)[codes]


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``size`` words; shorter texts are one window."""
    width = min(size, len(hashes))
    count = len(hashes) - width + 1
    mixed = np.full(count, np.uint64(width), np.uint64)
    for i in range(width):
        mixed = _mix(mixed * ODD + hashes[i : i + count])
    return np.unique(mixed)


def sketches(shingles: np.ndarray, width: int, number: int) -> np.ndarray:
    """``2 * number`` sketches of ``width`` minhashes each, mixed into one value.

    The lowest bit is 0 in left sketches and 1 in right ones; so a sketch needs no number beside it.
    """
    draw = np.random.Generator(np.random.PCG64(SEED))
    factors = draw.integers(0, 2**63, 2 * number * width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(2 * number * width, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        part = shingles[at : at + 1024, None] * factors[None, :]
        part ^= part >> np.uint64(32)
        part *= ODD
        np.minimum(least, part.min(axis=0), out=least)
    out = np.zeros(2 * number, np.uint64)
    for column in least.reshape(2 * number, width).T:
        out = _mix(out * ODD + column)
    return out >> np.uint64(1) << np.uint64(1) | (np.arange(2 * number) >= number).astype(np.uint64)


def _sets_of(texts: list[str | None], shingle: int) -> list[np.ndarray]:
    split = [(value or "").encode().translate(LOWER).split() for value in texts]
    hashes = word_hashes([word for words in split for word in words]) if any(split) else np.zeros(0, np.uint64)
    ends = np.cumsum([len(words) for words in split])
    return [shingle_hashes(hashes[e - len(w) : e], shingle) if w else hashes[:0] for w, e in zip(split, ends, strict=True)]


def document_sketches(docs: DataFrame, doc_id: str, text: str, shingle: int, width: int, number: int) -> DataFrame:
    """``(doc_id, n_shingles, digest, sketches)`` of every row; no digest without words."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def factory():
        def work(ids, texts):
            sets = _sets_of(texts, shingle)
            marks = [_digest(s) if len(s) else None for s in sets]
            signs = [sketches(s, width, number).view(np.int64).tolist() if len(s) else [] for s in sets]
            return ids, [len(s) for s in sets], marks, signs

        return work

    schema = f"doc_id {id_type}, n_shingles long, digest binary, sketches array<long>"
    return arrow_map(docs.select(doc_id, text), schema, factory, rows=256)


def member_sets(members: DataFrame, shingle: int) -> DataFrame:
    """``(component, n, node, shingles)`` from ``(component, n, node, text)``."""
    node_type = members.schema["node"].dataType.simpleString()

    def factory():
        return lambda components, counts, nodes, texts: (components, counts, nodes, [s.tobytes() for s in _sets_of(texts, shingle)])

    return arrow_map(members, f"component {node_type}, n long, node {node_type}, shingles binary", factory, rows=256)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def candidate_groups(sets: DataFrame) -> DataFrame:
    """``(node, component)``: documents connected by shared tables, compared or not.

    ``sets`` has one row per different set: ``node``, ``sketches``.
    """
    single = sets.select("node", F.explode("sketches").alias("sketch"))
    shared = single.groupBy("sketch").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    held = single.join(shared, "sketch").groupBy("node").agg(F.collect_list("sketch").alias("held"))
    side = lambda bit: F.filter("held", lambda x: x.bitwiseAND(1) == bit)
    keys = held.select("node", F.explode(side(0)).alias("u"), side(1).alias("vs")).select("node", "u", F.explode("vs").alias("v"))
    keys = materialize(keys.select("node", F.xxhash64("u", "v").alias("key")), "table-keys")
    heads = keys.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # a large group's many tables have few heads, so few different pairs
    pairs = materialize(keys.join(heads, "key").select("low", "node").distinct(), "table-heads")
    release(keys)
    # two rounds of smallest labels first: members of a large group then share few labels.
    # Each table's members are linked through the label of its head, which is one of them
    label = materialize(pairs.groupBy("node").agg(F.min("low").alias("label")), "first-labels")
    labelled = pairs.join(label, "node").select("low", F.col("label").alias("b")).distinct()
    edges = labelled.join(label.select(F.col("node").alias("low"), F.col("label").alias("a")), "low").select("a", "b")
    own = label.select(F.col("label").alias("a"), F.col("node").alias("b"))
    found = connected(edges.union(own).filter("a <> b").distinct())
    release(pairs, label)
    return found


def block_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``left``, or between ``left`` and ``right``.

    Members are numbered through, right ones after left ones. Intersections of all members are
    counted at once, by products of their membership in slices of the shared shingles.
    """
    sets = [*left, *(right or [])]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[codes] > 1
    owner, codes = owner[shared], codes[shared]
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    _, codes = np.unique(codes, return_inverse=True)
    common = np.zeros((len(sets), len(sets)), np.float64)
    width = 2048
    for at in range(0, int(codes.max(initial=-1)) + 1, width):
        lo, hi = np.searchsorted(codes, [at, at + width])
        member = np.zeros((len(sets), width), np.float32)
        member[owner[lo:hi], codes[lo:hi] - at] = 1
        common += member @ member.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = 100 * common >= percent * union
    if right is None:
        a, b = np.nonzero(np.triu(linked, 1))
    else:
        a, b = np.nonzero(linked[: len(left), len(left) :])
        b = b + len(left)
    return forest(len(sets), a, b)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Those of the edges ``a-b`` that connect what the earlier ones did not."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
            if len(kept) == n - 1:
                break
    return kept


def sized(groups: DataFrame) -> DataFrame:
    """``groups`` with the number ``n`` of rows of each ``component``."""
    return join_counted(groups, groups.groupBy("component").agg(F.count("*").alias("n")), "component")


def _placed(members: DataFrame, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """``members`` with the pairs of blocks in which each is compared (``a``, ``b`` and ``mine``), and links to pivots.

    What a large group needs to know, its pivot and its layout, is copied once per ``block``
    members, and they are dealt among the copies: no task joins a whole group.
    """
    small = members.filter(F.col("n") <= block).select("component", "node", "shingles", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("mine"))

    large = members.filter(F.col("n") > block)
    shares = F.ceil(F.col("n") / block)
    share = F.pmod(F.xxhash64("node"), shares).alias("share")
    every = F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("share")
    least = large.groupBy("component").agg(F.min("node").alias("node"))
    pivots = large.join(least, ["component", "node"]).dropDuplicates(["component", "node"])
    pivots = pivots.select("component", F.col("node").alias("pivot"), F.col("shingles").alias("others"), every)

    def factory():
        def work(components, counts, nodes, sets, pivots, others):
            bands = []
            for mine, other in zip(sets, others, strict=True):
                x, y = np.frombuffer(mine, np.uint64), np.frombuffer(other, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - common
                bands.append(min(BANDS - 1, (union - common) * BANDS // union))
            return components, counts, nodes, sets, pivots, bands

        return work

    node_type = members.schema["node"].dataType.simpleString()
    shared = large.select("component", "n", "node", "shingles", share).join(pivots, ["component", "share"])
    measured = shared.select("component", "n", "node", "shingles", "pivot", "others")
    schema = f"component {node_type}, n long, node {node_type}, shingles binary, pivot {node_type}, band int"
    measured = materialize(arrow_map(measured, schema, factory, rows=128), "group-distances")
    counts = measured.groupBy("component", "n", "band").agg(F.ceil(F.count("*") / block).cast("int").alias("pieces"))
    layout = counts.groupBy("component", "n").agg(F.sort_array(F.collect_list(F.struct("band", "pieces"))).alias("layout"))
    layout = layout.select("component", "layout", every)
    near = BANDS * (100 - percent) // 100  # bands whose members are all linked to the pivot
    cut = measured.select("component", "node", "shingles", "band", share).join(layout, ["component", "share"]).withColumn(
        "pieces", F.expr("filter(layout, x -> x.band = band)[0].pieces")
    ).withColumn("piece", F.pmod(F.xxhash64("node", F.lit("piece")), F.col("pieces")).cast("int"))
    partners = F.expr(
        f"flatten(transform(filter(layout, x -> abs(x.band - band) <= {near + 1} and (x.band >= {near} or band >= {near})),"
        " x -> transform(sequence(0, x.pieces - 1), p -> x.band * 1048576 + p)))"
    )
    cut = cut.withColumn("mine", F.expr("band * 1048576 + piece")).withColumn("other", F.explode(partners))
    spread = cut.select(
        "component", "node", "shingles", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine"
    )
    to_pivot = measured.filter((F.col("band") < near) & (F.col("node") != F.col("pivot")))
    return small.unionByName(spread), to_pivot.select(F.col("pivot").alias("a"), F.col("node").alias("b"))


def confirmed_links(members: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links confirmed on full sets that connect all linked ``members``.

    ``members`` has ``component``, its number ``n`` of rows, ``node`` and ``shingles``.
    """
    placed, to_pivot = _placed(members, percent, block)
    node_type = members.schema["node"].dataType.simpleString()

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        first, second = part["a"].iloc[0], part["b"].iloc[0]
        mine = part["mine"].to_numpy()
        order = np.argsort(mine != first, kind="stable")
        sets = [np.frombuffer(value, np.uint64) for value in part["shingles"].to_numpy()[order]]
        nodes = part["node"].to_numpy()[order]
        cut = int((mine == first).sum())
        links = block_links(sets, None, percent) if first == second else block_links(sets[:cut], sets[cut:], percent)
        return pd.DataFrame({"a": nodes[[x for x, _ in links]], "b": nodes[[y for _, y in links]]})

    # dealt by block pair: the joins before have dealt by component, which one task would keep
    placed = placed.repartition("component", "a", "b")
    found = placed.groupBy("component", "a", "b").applyInPandas(compare, f"a {node_type}, b {node_type}")
    return found.unionByName(to_pivot)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
    width: int = WIDTH,
    number: int = SKETCHES,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row.

    Texts without words, or null, are linked with nothing. A row without an id is returned as
    its own component, with a null id, and kept. Repeated rows with one id are one document.
    An empty table gives no rows. Other columns of ``docs`` are not read, whatever their names.
    The result reads tables below ``spark.checkpoint.dir``; ``release`` deletes them.
    """
    rows = materialize(document_sketches(docs, doc_id, text, shingle, width, number), "sketches")
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    # rows of one digest hold one set, so any of them has its sketches
    same = known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("n"), F.first("sketches").alias("sketches"))
    same = materialize(same, "different-sets")
    groups = candidate_groups(same.select("node", "sketches"))
    texts = narrowed(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")), "__id", groups.select("node"))
    members = sized(groups).join(texts, F.col("node") == F.col("__id")).select("component", "n", "node", "__text")
    members = materialize(member_sets(members, shingle), "candidate-sets")
    links = confirmed_links(members, percent)
    components = connected(links)
    release(links, groups)
    # only sets whose documents do not all keep their own id have to reach the rows again
    label = same.join(components, "node", "left").select("digest", "node", "n", F.coalesce("component", "node").alias("component"))
    label = materialize(label.filter("n > 1 OR component <> node").drop("node"), "labels-of-sets")
    release(same, components)
    out = join_counted(rows.select("doc_id", "n_shingles", "digest"), label, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
    )
