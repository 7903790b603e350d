"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

Vectors on the unit sphere with a cosine of at least c are at a distance of at most
``sqrt(2 - 2c)``. Rows are dealt into blocks: by nearest pivot, where the pivots are the top
level of a tree over a bounded sample, and large cells are cut further. Each block builds a
cover tree over all its rows: nested levels with halving radii, in which every node is a row
and covers its descendants. Two trees are then traversed together from the top. A pair of
nodes whose distance exceeds the threshold by more than both covering radii is pruned, a
pair that lies within it by as much is linked as a whole, and any other is opened.

A pair of blocks returns counts and one edge per linked row, never its pairs. The sample
only decides how well blocks can be pruned; every row is compared, and links are confirmed in
double precision.
"""

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import ROWS, arrow_map, connected, narrowed
from tidemark.sources.scratch import materialize, release

COSINE = 0.9
LEVELS = (1.0, 0.5, 0.25, 0.125, 0.0625)
SAMPLE_ROWS = 4096
MAX_PIVOTS = 64
MIN_BLOCKS = 16
BLOCK_ROWS = 4096
SLACK = 1e-5
TILE = 1024
#: Balls are compared in groups of as many blocks, with fewer groups than that of fewer blocks.
GROUP_BLOCKS = 12
MIN_GROUPS = 8
MAX_TASKS = 10_000
#: Share of unrelated pairs that the leading axes may let through.
LEAD_SHARE = 1e-5


def unit_rows(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``(vec_id, width, unit)`` of the rows that can be compared, as 64-bit unit vectors."""
    id_type = vectors.schema[vec_id].dataType.simpleString()
    fields = to_arrow_schema(StructType.fromDDL(f"vec_id {id_type}, width int, unit binary"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                ids, values = batch.slice(at, ROWS).columns
                lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
                rows = np.nonzero((lengths > 0) & ids.is_valid().to_numpy(zero_copy_only=False))[0]
                lengths = lengths[rows]
                flat = pc.cast(values.take(pa.array(rows)).flatten(), pa.float64(), safe=False).to_numpy(zero_copy_only=False)
                starts = np.cumsum(lengths) - lengths
                for width in np.unique(lengths).tolist():
                    some = lengths == width
                    vector = flat[starts[some][:, None] + np.arange(width)]  # null components are NaN
                    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                        largest = np.abs(vector).max(axis=1, keepdims=True)
                        unit = vector / np.where(largest == 0, 1.0, largest)
                        unit = unit / np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
                    good = np.isfinite(vector).all(axis=1) & np.isfinite(unit).all(axis=1)
                    data = pa.array([row.tobytes() for row in unit[good]], pa.binary())
                    columns = [ids.take(pa.array(rows[some][good])), pa.array(np.full(len(data), width, np.int32)), data]
                    yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return vectors.select(vec_id, embedding).mapInArrow(run, f"vec_id {id_type}, width int, unit binary")


def pick_pivots(sample: np.ndarray, number: int) -> np.ndarray:
    """Rows of ``sample`` chosen one after the other, each furthest from those before."""
    chosen = [0]
    nearest = np.full(len(sample), np.inf)
    while len(chosen) < min(number, len(sample)):
        nearest = np.minimum(nearest, 2 - 2 * sample @ sample[chosen[-1]])
        far = int(nearest.argmax())
        if nearest[far] <= 1e-12:
            break
        chosen.append(far)
    return sample[chosen]


def cover(units: np.ndarray, radius: float) -> np.ndarray:
    """For each row the centre that covers it: the first row within ``radius`` that is a centre.

    Centres are further apart than ``radius``.
    """
    single = units.astype(np.float32)
    near = single @ single.T >= np.float32(1 - radius * radius / 2)
    np.fill_diagonal(near, True)
    centre, free = np.arange(len(units)), np.ones(len(units), bool)
    for row in np.nonzero(near.sum(axis=1) > 1)[0]:
        if free[row]:
            inside = near[row] & free
            centre[inside], free[inside] = row, False
    return centre


def cover_paths(units: np.ndarray, levels=LEVELS) -> np.ndarray:
    """For each row its centre on each level; the rows of a node are covered anew on the next."""
    paths = np.zeros((len(units), len(levels)), np.int32)
    groups = [np.arange(len(units))]
    for level, radius in enumerate(levels):
        below = []
        for rows in groups:
            centre = rows[cover(units[rows], radius)]
            paths[rows, level] = centre
            order = rows[np.argsort(centre, kind="stable")]
            parts = np.split(order, np.nonzero(np.diff(np.sort(centre)))[0] + 1)
            below += [part for part in parts if len(part) > 1]
        alone = np.ones(len(units), bool)
        for rows in below:
            alone[rows] = False
        paths[alone, level + 1 :] = np.nonzero(alone)[0][:, None]
        groups = below
    return paths


def topped(units: np.ndarray, paths: np.ndarray, radius: float) -> np.ndarray:
    """``paths`` without the levels above the first nodes that a ball of ``radius`` around their mean holds."""
    top = np.full(len(units), -1, np.int32)
    for level in range(paths.shape[1]):
        rows = np.nonzero(top < 0)[0]
        means, reach = _balls(units[rows], paths[rows, level])
        held = rows[reach[paths[rows, level]] <= radius + 1e-9]
        top[held] = paths[held, level]
        paths[held, :level] = top[held, None]
    paths[top < 0] = np.nonzero(top < 0)[0][:, None]
    return paths


def _balls(units: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covering radius of the rows of each ``node``, by number."""
    number = int(node.max(initial=-1)) + 1
    means = np.zeros((number, units.shape[1]))
    np.add.at(means, node, units)
    means /= np.maximum(1, np.bincount(node, minlength=number))[:, None]
    reach = np.zeros(number)
    np.maximum.at(reach, node, np.sqrt(((units - means[node]) ** 2).sum(axis=1)))
    return means, reach


def pack_balls(units: np.ndarray, node: np.ndarray, turn: np.ndarray | None) -> bytes:
    """The ball of each ``node`` on the axes of ``turn``: its centre in bytes and their scale, its radius, number and whether it has several rows."""
    nodes, node, sizes = np.unique(node, return_inverse=True, return_counts=True)
    means, reach = _balls(units, node)
    means = means if turn is None else means @ turn
    scale = (np.maximum(np.abs(means).max(axis=1), 1e-30) / 127).astype(np.float32)
    whole = np.rint(means / scale[:, None].astype(np.float64)).clip(-127, 127).astype(np.int8)
    moved = np.sqrt(((means - whole * scale[:, None].astype(np.float64)) ** 2).sum(axis=1))
    reach = np.nextafter((reach + moved).astype(np.float32), np.float32(np.inf))
    return b"".join(x.tobytes() for x in (scale, reach, nodes.astype(np.int32), (sizes > 1).astype(np.int32), whole))


class Balls:
    """The balls of several blocks, unpacked and in order of radius."""

    def __init__(self, blocks: list[int], packed: list[bytes], width: int, lead: int):
        parts = []
        for block, data in zip(blocks, packed, strict=True):
            n = len(data) // (16 + width)
            scale, reach = np.frombuffer(data, np.float32, 2 * n).reshape(2, n)
            nodes, many = np.frombuffer(data, np.int32, 2 * n, 8 * n).reshape(2, n)
            whole = np.frombuffer(data, np.int8, offset=16 * n).reshape(n, width)
            parts.append((whole * scale[:, None], reach, nodes, many > 0, np.full(n, block, np.int32)))
        centres, self.reach, self.nodes, self.many, self.block = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(self.reach, kind="stable")
        self.centres, self.reach, self.nodes, self.many, self.block = (x[order] for x in (centres, self.reach, self.nodes, self.many, self.block))
        self.square = np.einsum("ij,ij->i", self.centres, self.centres)
        rest = np.sqrt(np.einsum("ij,ij->i", self.centres[:, lead:], self.centres[:, lead:]))
        half, one = -self.square / 2, np.ones(len(rest), np.float32)
        # the product of a left and a right row is at least minus half the square of their distance
        self.left = np.column_stack([self.centres[:, :lead], rest, half, one])
        self.right = np.column_stack([self.centres[:, :lead], rest, one, half])
        self.blocks = np.unique(self.block)
        self.at = np.searchsorted(self.blocks, self.block)


def near_balls(left: Balls, right: Balls, limit: float) -> list[tuple[int, int, np.ndarray]]:
    """``(block, other, nodes)``: the nodes of ``block`` whose balls may hold a row within ``limit`` of one of ``other``."""
    same = left is right
    ahead = np.zeros((len(left.block), len(right.blocks)), bool)
    back = ahead if same else np.zeros((len(right.block), len(left.blocks)), bool)
    if same:
        several = np.nonzero(left.many)[0]
        ahead[several, left.at[several]] = True
    buffer = np.empty((TILE, TILE), np.float32)
    for j in range(0, len(right.block), TILE):
        columns = np.ascontiguousarray(right.right[j : j + TILE].T)
        widest = right.reach[j : j + TILE].max()
        for i in range(0, j + 1 if same else len(left.block), TILE):
            part = left.left[i : i + TILE]
            product = np.matmul(part, columns, out=buffer[: len(part), : columns.shape[1]])
            if same and i == j:
                np.fill_diagonal(product, -np.inf)
            least = -((limit + left.reach[i : i + TILE].max() + widest) ** 2) / 2 - SLACK
            rows = np.nonzero(product.max(axis=1) >= least)[0]
            if not len(rows):
                continue
            p, q = np.nonzero(product[rows] >= least)
            p, q = rows[p] + i, q + j
            fresh = ~(ahead[p, right.at[q]] & back[q, left.at[p]])
            p, q = p[fresh], q[fresh]
            for k in range(0, len(p), 65536):
                a, b = p[k : k + 65536], q[k : k + 65536]
                square = left.square[a] + right.square[b] - 2 * np.einsum("ij,ij->i", left.centres[a], right.centres[b])
                near = square <= (limit + left.reach[a] + right.reach[b]) ** 2 + 2 * SLACK
                ahead[a[near], right.at[b[near]]] = True
                back[b[near], left.at[a[near]]] = True
    found = []
    for balls, others, mark in ((left, right, ahead), (right, left, back))[: 1 if same else 2]:
        for x, block in enumerate(balls.blocks.tolist()):
            mine = np.nonzero(balls.at == x)[0]
            for y, other in enumerate(others.blocks.tolist()):
                nodes = balls.nodes[mine[mark[mine, y]]]
                if len(nodes):
                    found.append((block, other, np.sort(nodes)))
    return found


def leading_axes(sample: np.ndarray, cosine: float) -> tuple[np.ndarray, int]:
    """The principal axes of ``sample`` and how many of the first ones tell unrelated rows apart."""
    width = sample.shape[1]
    turn = np.ascontiguousarray(np.linalg.eigh(sample.T @ sample)[1][:, ::-1])
    rows = sample[:TILE] @ turn
    cosine -= 0.01  # balls that hold one row are as far off by rounding
    linked = (rows @ rows.T >= cosine).mean()
    step = max(4, width // 16)
    for lead in range(step, width, step):
        rest = np.sqrt(np.maximum(0, 1 - (rows[:, :lead] ** 2).sum(axis=1)))
        if (rows[:, :lead] @ rows[:, :lead].T + np.outer(rest, rest) >= cosine).mean() - linked <= LEAD_SHARE:
            return turn, lead
    return turn, width


class CoverTree:
    """Nested levels over unit vectors; a node of a level is the row at its centre.

    ``paths`` are those of ``cover_paths``, with centres as numbers of rows. The last level
    holds the rows themselves.
    """

    def __init__(self, units: np.ndarray, paths: np.ndarray):
        self.units = units
        paths = np.column_stack([paths, np.arange(len(units))])
        order = np.lexsort(paths.T[::-1])
        #: per level: centre row, covering radius, rows below, and the first child on the next level
        self.centres, self.radii, self.members, self.children = [], [], [], []
        starts = []
        for level in range(paths.shape[1]):
            centre = paths[order, level]
            first = np.concatenate([[0], np.nonzero(np.diff(centre))[0] + 1]) if len(order) else np.zeros(0, np.int64)
            starts.append(first)
            rows = np.split(order, first[1:])
            self.centres.append(centre[first].astype(np.int64))
            self.members.append(rows)
            radii = np.zeros(len(first))
            for node in np.nonzero(np.diff(np.append(first, len(order))) > 1)[0]:
                cos = units[rows[node]] @ units[centre[first[node]]]
                radii[node] = np.sqrt(np.maximum(0, 2 - 2 * cos)).max()
            self.radii.append(radii)
        for upper, lower in zip(starts, starts[1:]):  # noqa: B905
            self.children.append(np.searchsorted(lower, np.append(upper, len(order))))


class Links:
    """Link counts and connecting edges among numbered rows."""

    def __init__(self, n: int):
        self.counts = np.zeros(n, np.int64)
        self.a, self.b = [], []

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.counts, a, 1)
        np.add.at(self.counts, b, 1)
        self.a.append(a)
        self.b.append(b)

    def whole(self, left: np.ndarray, right: np.ndarray) -> None:
        """Every row of ``left`` with every row of ``right``."""
        self.counts[left] += len(right)
        self.counts[right] += len(left)
        self.a += [left, right]
        self.b += [np.full(len(left), right[0]), np.full(len(right), left[0])]

    def within(self, rows: np.ndarray) -> None:
        self.counts[rows] += len(rows) - 1
        self.a.append(rows)
        self.b.append(np.full(len(rows), rows[0]))

    def labels(self) -> np.ndarray:
        """The smallest number that each row is connected to."""
        label = np.arange(len(self.counts))
        if self.a:
            a, b = np.concatenate(self.a), np.concatenate(self.b)
            while True:
                low = np.minimum(label[a], label[b])
                new = label.copy()
                np.minimum.at(new, a, low)
                np.minimum.at(new, b, low)
                np.minimum.at(new, label[a], low)
                np.minimum.at(new, label[b], low)
                new = new[new]
                if (new == label).all():
                    break
                label = new
        return label


def dual_traversal(left: CoverTree, right: CoverTree, cosine: float, links: Links, shift: int) -> None:
    """Add the links between two trees, or within one when both are the same object.

    Rows of ``right`` are numbered from ``shift`` on.
    """
    same = left is right
    limit = np.sqrt(max(0.0, 2 - 2 * cosine))
    near, far = [], []
    x = left.units[left.centres[0]].astype(np.float32)
    y = right.units[right.centres[0]].astype(np.float32)
    # nodes of a single row have no radius to allow for, so they are compared apart from the others
    for own in (np.nonzero(left.radii[0] == 0)[0], np.nonzero(left.radii[0])[0]):
        for other in (np.nonzero(right.radii[0] == 0)[0], np.nonzero(right.radii[0])[0]):
            for i in range(0, len(own), TILE):
                for j in range(0, len(other), TILE):
                    rows, columns = own[i : i + TILE], other[j : j + TILE]
                    reach = np.float32(limit)
                    if left.radii[0][rows[0]] or right.radii[0][columns[0]]:
                        reach = reach + np.add.outer(left.radii[0][rows], right.radii[0][columns]).astype(np.float32)
                    p, q = np.nonzero(x[rows] @ y[columns].T >= 1 - reach * reach / 2 - SLACK)
                    near.append(rows[p])
                    far.append(columns[q])
    p, q = np.concatenate(near or [np.zeros(0, int)]), np.concatenate(far or [np.zeros(0, int)])
    if same:
        p, q = p[p <= q], q[p <= q]
    for level in range(len(left.centres)):
        a, b = left.centres[level][p], right.centres[level][q]
        cos = np.concatenate([np.einsum("ij,ij->i", left.units[a[i : i + 65536]], right.units[b[i : i + 65536]]) for i in range(0, len(a), 65536)] or [np.zeros(0)])
        if level == len(left.centres) - 1:
            hit = cos >= cosine
            if same:
                hit &= a != b
            links.pairs(a[hit], b[hit] + shift)
            return
        distance = np.sqrt(np.maximum(0, 2 - 2 * cos))
        radii = left.radii[level][p] + right.radii[level][q]
        whole = distance + radii <= limit - SLACK
        if same:
            whole |= (p == q) & (radii <= limit - SLACK)
        for i, j in zip(p[whole].tolist(), q[whole].tolist(), strict=True):
            if same and i == j:
                links.within(left.members[level][i])
            else:
                links.whole(left.members[level][i], right.members[level][j] + shift)
        keep = ~whole & (distance - radii <= limit + SLACK)
        p, q = _open(left.children[level], right.children[level], p[keep], q[keep], same)


def _open(left: np.ndarray, right: np.ndarray, p: np.ndarray, q: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of each ``p`` with a child of its ``q``."""
    width = right[q + 1] - right[q]
    count = (left[p + 1] - left[p]) * width
    owner = np.repeat(np.arange(len(p)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    a = left[p][owner] + inside // width[owner]
    b = right[q][owner] + inside % width[owner]
    if same:  # children of one node pair up once
        once = (p[owner] != q[owner]) | (a <= b)
        a, b = a[once], b[once]
    return a, b


def _blocks(units: DataFrame, number: int, cosine: float) -> tuple[DataFrame, dict[int, np.ndarray], dict[int, tuple[np.ndarray, int]]]:
    """``units`` with the ``cell`` of the nearest pivot and its ``distance``, and by width the pivots and leading axes."""
    sample = {}
    for row in units.limit(SAMPLE_ROWS).collect():
        sample.setdefault(row["width"], []).append(np.frombuffer(row["unit"]))
    pivots = {width: pick_pivots(np.array(rows), number) for width, rows in sample.items()}
    axes = {width: leading_axes(np.array(rows), cosine) for width, rows in sample.items()}
    id_type = units.schema["vec_id"].dataType.simpleString()

    def factory():
        def work(ids, widths, rows):
            cells, distances = [0] * len(ids), [2.0] * len(ids)
            for width in set(widths) & set(pivots):
                at = [i for i, w in enumerate(widths) if w == width]
                cos = np.array([np.frombuffer(rows[i]) for i in at]) @ pivots[width].T
                best = cos.argmax(axis=1)
                for i, cell, c in zip(at, best.tolist(), cos.max(axis=1).tolist(), strict=True):
                    cells[i], distances[i] = cell, (max(0.0, 2 - 2 * c)) ** 0.5
            return ids, widths, rows, cells, distances

        return work

    return arrow_map(units, f"vec_id {id_type}, width int, unit binary, cell int, distance double", factory), pivots, axes


def near_duplicate_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, block_rows: int = BLOCK_ROWS, min_blocks: int = MIN_BLOCKS
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row.

    Vectors that are null, zero or empty, or hold null or non-finite components, are linked
    with nothing, and so are vectors of different widths. A row without an id has no
    links and no component and is kept. Rows with one id are one vector: equal ones count
    once, and of different ones the links are added up. An empty table gives no rows; other
    columns are not read. The result reads tables below ``spark.checkpoint.dir``; ``release``
    deletes them.
    """
    units = materialize(unit_rows(vectors, vec_id, embedding).dropDuplicates(["vec_id", "unit"]), "unit-vectors")
    total = units.count()
    blocks = max(min_blocks, -(-total // block_rows))
    placed, pivots, axes = _blocks(units, min(MAX_PIVOTS, max(1, blocks // 2)), cosine)
    placed = materialize(placed, "placed-vectors")
    release(units)
    rows = max(1, -(-total // blocks))
    cells = placed.groupBy("width", "cell").agg(
        F.count("*").alias("n"), F.max("distance").alias("radius")
    ).orderBy("width", "cell").collect()
    limit = float(np.sqrt(max(0.0, 2 - 2 * cosine)))

    # blocks by number, in groups of one width each, and with which groups each cell has to meet
    first, parts, n = {}, {}, 0
    for cell in cells:
        first[cell["width"], cell["cell"]], parts[cell["width"], cell["cell"]] = n, -(-cell["n"] // rows)
        n += parts[cell["width"], cell["cell"]]
    together = max(1, min(GROUP_BLOCKS, n // MIN_GROUPS))
    group, widths, starts = [], [], {}
    for width, cell in first:
        start = starts.setdefault(width, (len(group), len(widths)))
        for block in range(len(group), len(group) + parts[width, cell]):
            group.append(start[1] + (block - start[0]) // together)
            if group[-1] == len(widths):
                widths.append(width)
    meets = {}
    for x in cells:
        for y in cells:
            centre = pivots.get(x["width"])
            if x["width"] == y["width"]:
                apart = 0.0 if centre is None else float(np.sqrt(max(0.0, 2 - 2 * centre[x["cell"]] @ centre[y["cell"]])))
                if apart <= limit + x["radius"] + y["radius"] + SLACK:
                    other = first[x["width"], y["cell"]]
                    groups = set(group[other : other + parts[x["width"], y["cell"]]])
                    for block in range(first[x["width"], x["cell"]], first[x["width"], x["cell"]] + parts[x["width"], x["cell"]]):
                        meets.setdefault(block, set()).update(groups)
    return _compared(vectors, vec_id, placed, first, parts, _Layout(group, widths, meets, axes, limit), cosine)


class _Layout(NamedTuple):
    """The group of each block, the width of each group, the groups that a block meets, and by width the leading axes."""

    group: list[int]
    widths: list[int]
    meets: dict[int, set[int]]
    axes: dict[int, tuple[np.ndarray, int]]
    limit: float


def _meeting(trees: DataFrame, layout: _Layout) -> DataFrame:
    """``(a, b, at)``: the pairs of blocks that may hold links, and by ``at`` the nodes of either that do."""
    group, widths, meets, axes, limit = layout

    def deal():
        def work(mine, balls):
            rows = [(min(group[m], g), max(group[m], g), m, data) for m, data in zip(mine, balls, strict=True) for g in sorted(meets[m])]
            return list(zip(*rows, strict=True)) if rows else [[], [], [], []]

        return work

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        a, b = int(part["g"].iloc[0]), int(part["h"].iloc[0])
        width = widths[a]
        lead = axes[width][1] if width in axes else width
        blocks, packed = part["mine"].tolist(), part["balls"].tolist()
        sides = [[i for i, block in enumerate(blocks) if group[block] == g] for g in dict.fromkeys((a, b))]
        sides = [Balls([blocks[i] for i in side], [packed[i] for i in side], width, lead) for side in sides if side]
        # no row may have fallen into the blocks of one group
        found = near_balls(sides[0], sides[-1], limit) if a == b or len(sides) > 1 else []
        return pd.DataFrame({
            "a": [min(x, y) for x, y, _ in found], "b": [max(x, y) for x, y, _ in found],
            "mine": [x for x, _, _ in found], "nodes": pd.Series([nodes.tolist() for _, _, nodes in found], dtype=object),
        })

    dealt = arrow_map(trees.filter("balls IS NOT NULL").select("mine", "balls"), "g int, h int, mine int, balls binary", deal, rows=16)
    groups = max(group, default=0) + 1
    dealt = dealt.repartition(min(MAX_TASKS, groups * (groups + 1)), "g", "h")
    found = dealt.groupBy("g", "h").applyInPandas(compare, "a int, b int, mine int, nodes array<int>")
    return found.select("a", "b", "mine", F.explode("nodes").alias("node")).select("a", "b", _node_key("mine", F.col("node")).alias("at"))


def _node_key(block, node):
    return F.col(block).cast("long") * 4294967296 + node


def _compared(vectors, vec_id, placed, first, parts, layout, cosine):
    id_type = placed.schema["vec_id"].dataType.simpleString()
    axes, limit = layout.axes, layout.limit

    def number():
        def work(ids, rows, widths, cells, places):
            keys = zip(widths, cells, strict=True)
            return ids, rows, [first[key] + place % parts[key] for key, place in zip(keys, places, strict=True)]

        return work

    def plant(part: pd.DataFrame) -> pd.DataFrame:
        units = np.array([np.frombuffer(row) for row in part["unit"]])
        paths = topped(units, cover_paths(units), limit / 2)
        part["place"] = np.arange(len(part), dtype=np.int32)
        part["path"] = list(paths)
        part["balls"] = [pack_balls(units, paths[:, 0], axes.get(units.shape[1], (None,))[0]), *[None] * (len(part) - 1)]
        return part

    columns = placed.select("vec_id", "unit", "width", "cell", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)))
    block = f"vec_id {id_type}, unit binary, mine int"
    trees = arrow_map(columns, block, number, rows=256).groupBy("mine").applyInPandas(plant, f"{block}, place int, path array<int>, balls binary")
    trees = materialize(trees, "cover-trees")
    release(placed)
    meeting = materialize(_meeting(trees, layout), "meeting-nodes")
    # one row per node, so a node's rows are not copied before they are joined
    wanted = meeting.groupBy("at").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    keyed = trees.select("mine", "place", "vec_id", "unit", "path", _node_key("mine", F.col("path")[0]).alias("at"))
    spread = narrowed(keyed, "at", wanted.select("at")).join(wanted, "at").select("mine", "place", "vec_id", "unit", "path", F.explode("pairs").alias("pair"))
    spread = spread.select("pair.a", "pair.b", "mine", "place", "vec_id", "unit", "path")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        a, b = int(part["a"].iloc[0]), int(part["b"].iloc[0])
        part = part.sort_values(["mine", "place"], kind="stable")
        units = np.array([np.frombuffer(row) for row in part["unit"]])
        paths = np.array(part["path"].tolist()).reshape(len(part), -1)
        ids, places = part["vec_id"].to_numpy(), part["place"].to_numpy()
        cut = int((part["mine"] == a).sum())
        paths[:cut] = np.searchsorted(places[:cut], paths[:cut])
        paths[cut:] = np.searchsorted(places[cut:], paths[cut:])
        links = Links(len(ids))
        if a == b:
            tree = CoverTree(units, paths)
            dual_traversal(tree, tree, cosine, links, 0)
        elif 0 < cut < len(ids):
            dual_traversal(CoverTree(units[:cut], paths[:cut]), CoverTree(units[cut:], paths[cut:]), cosine, links, cut)
        linked = np.nonzero(links.counts)[0]
        return pd.DataFrame({"vec_id": ids[linked], "links": links.counts[linked], "other": ids[links.labels()[linked]]})

    found = spread.groupBy("a", "b").applyInPandas(compare, f"vec_id {id_type}, links long, other {id_type}")
    found = materialize(found, "vector-links")
    release(trees, meeting)
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    components = connected(found.select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    label = counts.join(components, counts["vec_id"] == components["node"], "left").select("vec_id", "n_links", "component")
    out = vectors.select(F.col(vec_id).alias("vec_id")).join(label, "vec_id", "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))
