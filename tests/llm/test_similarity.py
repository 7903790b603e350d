"""Near-duplicates, embeddings and toxicity against brute force, and on odd rows."""

import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, embedding_dup, near_dup, toxicity
from tidemark.llm.common import connected, join_counted
from tidemark.llm.queries import op6_minhash_near_dedup, op8_embedding_near_dedup, op9_toxicity
from tidemark.sources.scratch import release

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, node string, component string"


def components(nodes, links):
    parent = {node: node for node in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    return {node: root(node) for node in nodes}


def word_set(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(texts):
    sets = {i: word_set(text) for i, text in texts.items()}
    ids = sorted(i for i in sets if sets[i])
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return sets, components(sets, links)


def edited(draw, words, share):
    return [draw.choice("lorem ipsum dolor sit amet".split()) + str(draw.random()) if draw.random() < share else w for w in words]


def near_copies(seed, n=300):
    """Families of a text with few or many edits, and one passage that many texts share."""
    draw = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = {}
    for i in range(n):
        family = random.Random(i % 7)
        base = [f"w{family.randrange(400)}" for _ in range(120)]
        kind = draw.random()
        if kind < 0.6:
            words = edited(draw, base, draw.choice([0, 0.005, 0.02, 0.04, 0.08]))
        elif kind < 0.8:
            words = passage + [f"u{draw.random()}" for _ in range(draw.randrange(5, 60))]
        else:
            words = [f"u{draw.random()}" for _ in range(draw.randrange(0, 8))]
        texts[i * 3] = " ".join(words)
    return texts


@pytest.mark.parametrize("block", [256, 16])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    texts = near_copies(block)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup.confirmed_links, "__defaults__", (75, block))
    rows = near_dup.near_duplicates(spark.createDataFrame([(i, t, "n", "c") for i, t in texts.items()], DOCS)).collect()
    sets, wanted = brute_components(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {
        i: (len(sets[i]), wanted[i], wanted[i] == i) for i in texts
    }


def test_near_duplicate_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sets, wanted = brute_components(texts)
    for row in op6_minhash_near_dedup(spark, SF).collect():
        assert (row["n_shingles"], row["component_id"]) == (len(sets[row["doc_id"]]), wanted[row["doc_id"]])


def test_near_duplicate_odd_rows(spark):
    rows = [(9, None), (8, ""), (7, " \n"), (6, "A b"), (5, "a B"), (4, "a b c"), (4, "a b c"), (None, "a b c"), (3, "a b c")]
    frame = spark.createDataFrame([(i, t, "n", "c") for i, t in rows], DOCS)
    got = sorted(tuple(r) for r in near_dup.near_duplicates(frame).collect() if r["doc_id"] is not None)
    assert got == [(3, 1, 3, True), (4, 1, 3, False), (4, 1, 3, False), (5, 1, 5, True), (6, 1, 5, False), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True)]
    assert near_dup.near_duplicates(frame.limit(0)).collect() == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_counted(spark, monkeypatch, how):
    """More keys than are matched by broadcast, keys on one side only, and rows without a key."""
    monkeypatch.setattr(common, "HOT_KEYS", 3)
    rows = [(i, k) for i, k in enumerate([1] * 90 + [2] * 50 + [3] * 20 + [4, 4, 5, 6, 7, None, None])]
    counted = [(k, sum(1 for _, x in rows if x == k), f"name {k}") for k in (1, 2, 3, 4, 5, 9)]
    frame = spark.createDataFrame(rows, "i long, k long")
    got = join_counted(frame, spark.createDataFrame(counted, "k long, n long, name string"), "k", how).select("i", "k", "n", "name")
    known = {k: (n, name) for k, n, name in counted}
    want = [(i, k, *known.get(k, (None, None))) for i, k in rows if how == "left" or k in known]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_no_task_joins_a_whole_group(spark):
    """Two thirds of the rows are near copies, exact or not, of one text; joins deal them all the same."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words if i % 3 else [*words[: i % 60], f"x{i}", *words[i % 60 :]])) for i in range(2000)]
    rows += [(i, " ".join(f"u{i}x{j}" for j in range(20))) for i in range(2000, 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    members = frame.select(F.lit(0).cast("long").alias("component"), F.lit(2000).cast("long").alias("n"), F.col("doc_id").alias("node"), "text")
    members = near_dup.member_sets(members.filter("node < 2000"), 5)
    placed, _ = near_dup._placed(members, 75, 64)
    assert "hashpartitioning(component#" not in re.sub(r"hashpartitioning\(component#\d+L, ", "", placed._jdf.queryExecution().toString())
    got = near_dup.near_duplicates(frame)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: 0 if i < 2000 else i for i, _ in rows}


@pytest.mark.parametrize("pieces", [4096, 1])
def test_narrowed(spark, monkeypatch, pieces):
    """No row of the ids is lost, also when the bit map is full; most others go when it is not."""
    monkeypatch.setattr(common, "PIECES", pieces)
    for make in (F.col("id"), F.concat(F.lit("d"), "id")):
        rows = spark.range(60_000).select(make.alias("key"), "id")
        ids = spark.range(0, 60_000, 12).select(make.alias("node"))
        got = [r["id"] for r in common.narrowed(rows, "key", ids).collect()]
        assert len(got) == len(set(got)) and set(got) >= set(range(0, 60_000, 12))
        assert len(got) < 60_000 * (0.2 if pieces > 1 else 0.3)
    odd = spark.createDataFrame([(None, 1), (5, 2), (5, 3), (6, 4)], "key long, id long")
    kept = common.narrowed(odd, "key", spark.createDataFrame([(5,), (5,)], "node long"))
    assert kept.columns == ["key", "id"] and {2, 3} <= {r["id"] for r in kept.collect()}
    assert common.narrowed(odd, "key", ids.limit(0)).collect() == []


def texts_shuffled(node):
    """Rows with a text that the shuffles of an executed plan wrote."""
    own = 0
    if node.nodeName() == "Exchange" and "__text" in node.output().toString():
        own = node.metrics().apply("shuffleRecordsWritten").value()
    return own + sum(texts_shuffled(node.children().apply(i)) for i in range(node.children().size()))


def test_only_texts_of_candidates_are_sent(spark, monkeypatch):
    """Few texts have a near copy: hardly any others are shuffled, with no table small enough to be broadcast by size."""
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(40))) for i in range(3000)]
    rows += [(3000 + i, rows[i][1] + " more") for i in range(0, 3000, 60)]
    sent, member_sets = [], near_dup.member_sets

    def watched(members, shingle):
        assert len(members.collect()) == 100
        sent.append(texts_shuffled(members._jdf.queryExecution().executedPlan()))
        return member_sets(members, shingle)

    monkeypatch.setattr(near_dup, "member_sets", watched)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i - 3000 if i >= 3000 else i for i, _ in rows}
    assert 100 <= sent[0] < 600


def test_scratch_tables_are_released(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    for query in (op6_minhash_near_dedup, op8_embedding_near_dedup):
        result = query(spark, SF)
        assert result.count() and set(shared.iterdir()) > before
        release(result)
        assert set(shared.iterdir()) == before


@pytest.mark.parametrize("seed", range(2))
def test_connected(spark, seed):
    """Chains, a star with many leaves, loops and repeated edges."""
    draw = random.Random(seed)
    chain = [(i, i + 1) for i in range(100, 160)]
    draw.shuffle(chain)
    edges = chain + [(7, n) for n in range(1000, 1600)] + [(5, 5), (3, 4), (4, 3), (3, 4)]
    edges += [(draw.randrange(2000, 2300), draw.randrange(2000, 2300)) for _ in range(200)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    joined = [e for e in edges if e[0] != e[1]]
    assert got == components({n for e in joined for n in e}, joined)


def clustered(seed, width=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    parts = [centres[i] + draw.normal(size=(n, width)) * s for i, (n, s) in enumerate(zip([200, 1, 30, 5, 80, 2, 2, 40, 9, 60, 3, 7], [0.02, 1, 0.1, 0.3, 0.2, 0.01, 0.2, 0.25, 0.15, 0.22, 0.1, 0.3], strict=True))]
    return np.concatenate([*parts, parts[0][:5], draw.normal(size=(60, width)) * 3])


def brute_links(vectors):
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    linked = units @ units.T >= 0.9
    np.fill_diagonal(linked, False)
    pairs = list(zip(*np.nonzero(np.triu(linked)), strict=True))
    return linked.sum(axis=1), components(range(len(vectors)), pairs)


def planted(units):
    return embedding_dup.CoverTree(units, embedding_dup.cover_paths(units))


@pytest.mark.parametrize("seed", range(4))
def test_dual_traversal(seed):
    vectors = clustered(seed)
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    counts, labels = brute_links(vectors)
    links = embedding_dup.Links(len(units))
    tree = planted(units)
    for level, radius in enumerate(embedding_dup.LEVELS):
        centres = units[tree.centres[level]]
        assert (tree.radii[level] <= radius + 1e-6).all()
        assert sorted(np.concatenate(tree.members[level])) == list(range(len(units)))
        if level == 0:
            gaps = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T)) + 9 * np.eye(len(centres))
            assert gaps.min() > radius - 1e-6
    embedding_dup.dual_traversal(tree, tree, 0.9, links, 0)
    assert (links.counts == counts).all()
    assert links.labels().tolist() == [labels[i] for i in range(len(units))]
    cut = 170
    links = embedding_dup.Links(len(units))
    left, right = planted(units[:cut]), planted(units[cut:])
    for a, b, shift in ((left, left, 0), (left, right, cut)):
        embedding_dup.dual_traversal(a, b, 0.9, links, shift)
    rest = embedding_dup.Links(len(units) - cut)
    embedding_dup.dual_traversal(right, right, 0.9, rest, 0)
    links.counts[cut:] += rest.counts
    assert (links.counts == counts).all()


VECTORS = "vec_id long, embedding array<float>, label int, component string"


@pytest.mark.parametrize("block_rows", [4096, 20])
def test_embedding_components(spark, block_rows):
    vectors = clustered(9).astype(np.float32).astype(float)
    frame = spark.createDataFrame([(i, v.tolist(), 0, "c") for i, v in enumerate(vectors)], VECTORS)
    counts, labels = brute_links(vectors)
    rows = embedding_dup.near_duplicate_vectors(frame, block_rows=block_rows).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows} == {i: (counts[i], labels[i]) for i in range(len(vectors))}


def test_embedding_query_and_odd_rows(spark):
    assert op8_embedding_near_dedup(spark, SF).count() == 500
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (None, [1.0, 0.0]), (9, [1.0]), (10, [5.0, 0.0]), (10, [5.0, 0.0]), (11, [1e-30, 0.0]), (12, [-1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 0, "c") for i, v in rows], VECTORS)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dup.near_duplicate_vectors(frame).collect()}
    linked = {1: (3, 1, True), 2: (3, 1, False), 10: (3, 1, False), 11: (3, 1, False)}
    assert got == {i: linked.get(i, (0, i, True)) for i, _ in rows}
    assert embedding_dup.near_duplicate_vectors(frame.limit(0)).collect() == []


def rows_shuffled(node):
    """Rows that the shuffles of an executed plan wrote."""
    own = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" else 0
    return own + sum(rows_shuffled(node.children().apply(i)) for i in range(node.children().size()))


def test_only_rows_near_another_block_are_sent(spark, monkeypatch):
    """Vectors that lie far apart are not sent to the other blocks; before, each went to every one of them."""
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(3000, 64))
    vectors[1500:1530] = vectors[:30] + draw.normal(size=(30, 64)) * 0.1
    sent, materialize = [], embedding_dup.materialize

    def watched(df, label):
        if label == "vector-links":
            df.collect()
            sent.append(rows_shuffled(df._jdf.queryExecution().executedPlan()))
        return materialize(df, label)

    monkeypatch.setattr(embedding_dup, "materialize", watched)
    frame = spark.createDataFrame([(i, v.tolist(), 0, "c") for i, v in enumerate(vectors)], VECTORS)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = embedding_dup.near_duplicate_vectors(frame, block_rows=100).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    counts, labels = brute_links(vectors)
    assert counts.sum() == 60
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows} == {i: (counts[i], labels[i]) for i in range(len(vectors))}
    assert 0 < sent[0] < 3000


@pytest.mark.parametrize(("width", "cosine"), [(16, 0.9), (64, 0.9), (64, 0.999), (3, 0.6)])
def test_near_balls_miss_no_link(width, cosine):
    """The nodes found for each pair of blocks hold every linked row, whatever was rounded; far ones are left out."""
    vectors = np.concatenate([clustered(width, width), np.random.default_rng(1).normal(size=(500, width))])
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    block = np.arange(len(units)) % 5
    limit = math.sqrt(2 - 2 * cosine)
    turn, lead = embedding_dup.leading_axes(units, cosine)
    tops, packed = [], []
    for b in range(5):
        own = units[block == b]
        paths = embedding_dup.topped(own, embedding_dup.cover_paths(own), limit / 2)
        tops.append(paths[:, 0])
        packed.append(embedding_dup.pack_balls(own, paths[:, 0], turn))
    left, right = (embedding_dup.Balls(some, [packed[b] for b in some], width, lead) for some in ([0, 1, 2], [3, 4]))
    found = {}
    for x, y in ((left, left), (left, right), (right, right)):
        for mine, other, nodes in embedding_dup.near_balls(x, y, limit):
            assert (mine, other) not in found
            found[mine, other] = set(nodes.tolist())
    linked = units @ units.T >= cosine
    np.fill_diagonal(linked, False)
    for mine in range(5):
        for other in range(5):
            rows = linked[np.ix_(block == mine, block == other)].any(axis=1)
            assert set(tops[mine][rows].tolist()) <= found.get((mine, other), set())
            alone = (block[-500:] == mine) & ~linked[-500:].any(axis=1)
            if width == 64:
                assert len(found.get((mine, other), set()) & set(tops[mine][-100:][alone[block[-500:] == mine]].tolist())) < 5


def test_toxicity_query_is_right_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in op9_toxicity(spark, sf).collect()}
    assert len(rows) == 10000
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in rows.items())
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]}
    caught = [rows[i]["predicted"] for i, mark in marks.items() if mark]
    wrong = [rows[i]["predicted"] for i, mark in marks.items() if not mark]
    assert sum(caught) > 0.7 * len(caught)
    assert sum(wrong) < 0.01 * len(wrong)


def test_ftrl_against_a_plain_loop():
    draw = random.Random(3)
    rows = [np.array(sorted(draw.sample(range(64), draw.randint(0, 9))), np.int32) for _ in range(200)]
    labels = [int(draw.random() < 0.3 or 5 in row) for row in rows]
    at, values, bias = toxicity.ftrl(rows, labels, bits=6, epochs=3)
    z, n, b, b_n = [0.0] * 64, [0.0] * 64, 0.0, 0.0
    weight = lambda i: 0.0 if abs(z[i]) <= toxicity.L1 else (math.copysign(toxicity.L1, z[i]) - z[i]) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)
    for _ in range(3):
        for row, label in zip(rows, labels, strict=True):
            w = {int(i): weight(i) for i in row}
            g = 1 / (1 + math.exp(-(sum(w.values()) + b))) - label
            for i, own in w.items():
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * own
                n[i] += g * g
            b_n += g * g
            b -= toxicity.ALPHA / (toxicity.BETA + math.sqrt(b_n)) * g
    want = {i: weight(i) for i in range(64) if weight(i)}
    assert dict(zip(at.tolist(), values.tolist(), strict=True)) == pytest.approx(want) and bias == pytest.approx(b)
    assert 0 < len(want) < 64


def test_one_row_is_learnt_per_id(spark):
    """Twenty thousand rows of one id teach no more than one row of it."""
    rows = [(i, "vile thing here" if i % 2 else "sun and sea") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    many = once.union(spark.range(20_000).selectExpr("1L", "concat('vile thing here ', 'z', id)"))
    one, two = toxicity.train(once, labels), toxicity.train(many, labels)
    assert one[0].tolist() == two[0].tolist() and np.allclose(one[1], two[1]) and one[2] == two[2]


def test_ftrl_is_sparse_and_odd_rows(spark):
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["the", "of", "sun", "sea", "hill"]) for _ in range(30)) + (" vile" if i % 3 == 0 else "") for i in range(300)]
    docs = spark.createDataFrame([(i, t, "n", "c") for i, t in enumerate(texts)] + [(900, None, "", ""), (901, "", "", ""), (None, "x", "", "")], DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (1, None), (900, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert 0 < len(model[0]) < 200
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    assert all((scored[i] >= 0.5) == (i % 3 == 0) for i in range(300))
    assert scored[900] == scored[901]
    untaught = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score_documents(docs, untaught).collect()} == {0.5}
    assert toxicity.score_documents(docs.limit(0), model).collect() == []
