"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the ``SIDE`` words on its left and right; the log-probabilities
of all words add up to the score of a document. Words are hashed into ``2 ** BITS`` entries,
so no word is unknown and no table grows with the corpus. An entry is reached in three steps:
the most frequent entries are classes of their own, all others share the remaining classes;
a shared class is divided into groups, half of them for one frequent entry each, the others for
the rest by hash. The network predicts the class and the group from the words around, and an
entry follows in its group by its count in the corpus:
log P(word | sides) = log P(class | sides) + log P(group | class, sides) + log P(word | group).

Counts cover every word of every document. Training is data-parallel: texts are hashed once,
and their entries are dealt into shards by a hash of id and text, one per ``SHARD_WORDS``
words of the corpus, so how the input is cut into files does not matter. In each of
``ROUNDS`` rounds a shard goes on from the shared weights by mini-batches over one masked
position in ``ROUNDS``, others in each round, so that every position is predicted once; the
weights of all shards are then averaged by the positions they predicted. Weights and counts
have fixed sizes, so they may be sent everywhere.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map
from tidemark.sources.scratch import materialize, release

BITS = 18
CLASSES = 64
OWN = 32
GROUPS = 64
SIDE = 2
WIDTH = 16
ROUNDS = 3
BATCH = 8192
RATE = 0.1
SEED = 7
HASH_KEY = "window-model-key"
SHARD_WORDS = 1 << 21
#: Rows whose words are handled together, and parts that weights are first averaged in.
ROWS = 128
PARTS = 32

SHARED = CLASSES - OWN
FREQUENT = SHARED * GROUPS // 2
#: What a word is to its neighbours: a frequent entry, or the class of another; and nothing past the ends of a text.
CODES = OWN + FREQUENT + SHARED
PAD = CODES
GAP = np.full(SIDE, -1, "<i4").tobytes()
SHAPES = {
    "inputs": (2 * SIDE, CODES + 1, WIDTH),
    "hidden": (WIDTH,),
    "outputs": (WIDTH, CLASSES),
    "bias": (CLASSES,),
    "group_outputs": (SHARED, WIDTH, GROUPS),
    "group_bias": (SHARED, GROUPS),
}
#: Hidden units lie within one, so with these bounds no exponential and no sum of them leaves its range.
BOUNDS = {"outputs": (-4, 4), "group_outputs": (-4, 4), "bias": (-30, 15), "group_bias": (-30, 15)}
SIZES = {name: int(np.prod(shape)) for name, shape in SHAPES.items()}


def entries(texts: list[str | None]) -> list[np.ndarray]:
    """The hashed entry of every word (between ASCII white space, lower-cased) of each text."""
    split = [(value or "").lower().encode().split() for value in texts]
    words = np.array([word for part in split for word in part], dtype=object)
    if not len(words):
        return [np.zeros(0, np.int32) for _ in texts]
    codes, names = pd.factorize(words)
    hashes = pd.util.hash_array(np.array([name.decode() for name in names], dtype=object), hash_key=HASH_KEY, categorize=False)
    found = (hashes >> np.uint64(64 - BITS)).astype(np.int32)[codes]
    return np.split(found, np.cumsum([len(part) for part in split])[:-1])


def hashed_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, own)``: the entries of each text, four bytes a word."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def factory():
        return lambda ids, texts: [ids, [found.astype("<i4").tobytes() for found in entries(texts)]]

    return arrow_map(docs.select(doc_id, text), f"doc_id {id_type}, own binary", factory)


def entry_counts(words: DataFrame) -> np.ndarray:
    """How often each entry occurs in the whole table of ``hashed_words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                own = np.frombuffer(b"".join(batch.column(0).slice(at, ROWS).to_pylist()), "<i4")
                counts += np.bincount(own, minlength=1 << BITS)
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["entry", "n"])

    rows = words.select("own").mapInArrow(run, "entry int, n long").groupBy("entry").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << BITS, np.int64)
    counts[rows["entry"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


class Vocabulary:
    """Class, group and neighbour code of every entry, and its share of its group."""

    def __init__(self, counts: np.ndarray):
        number = len(counts)
        entry = np.arange(number)
        ranked = np.lexsort((entry, -counts))
        own, frequent = ranked[:OWN], ranked[OWN : OWN + FREQUENT]
        place = np.arange(len(frequent))
        self.classes = (OWN + entry % SHARED).astype(np.uint8)
        self.groups = (GROUPS // 2 + entry // SHARED % (GROUPS // 2)).astype(np.uint8)
        self.classes[own], self.groups[own] = np.arange(OWN), 0
        self.classes[frequent], self.groups[frequent] = OWN + place % SHARED, place // SHARED
        self.codes = np.append(OWN + FREQUENT + entry % SHARED, PAD).astype(np.int16)  # the last stands for -1
        self.codes[own], self.codes[frequent] = np.arange(OWN), OWN + place
        smooth = counts + 1.0
        cell = self.classes.astype(np.int64) * GROUPS + self.groups
        self.cells = np.bincount(cell, smooth, minlength=CLASSES * GROUPS).reshape(CLASSES, GROUPS)
        self.share = np.log(smooth / self.cells.ravel()[cell])


class Network:
    """Weights of the window network, forward pass and gradient steps in numpy."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = {name: np.array(value, np.float32).reshape(SHAPES[name]) for name, value in weights.items()}

    @classmethod
    def initial(cls, vocabulary: Vocabulary) -> "Network":
        draw = np.random.default_rng(SEED)
        weights = {name: draw.normal(0, 0.1, shape) for name, shape in SHAPES.items()}
        totals = vocabulary.cells.sum(axis=1)
        shared = vocabulary.cells[OWN:]
        known = {"bias": np.log(totals / totals.sum()), "group_bias": np.log(np.maximum(shared, 1e-3) / shared.sum(axis=1, keepdims=True)), "hidden": np.zeros(WIDTH)}
        return cls(weights | known)

    @classmethod
    def of(cls, flat: np.ndarray) -> "Network":
        ends = np.cumsum(list(SIZES.values()))[:-1]
        return cls(dict(zip(SHAPES, np.split(flat, ends), strict=True)))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[name].ravel() for name in SHAPES])

    def hidden(self, sides: np.ndarray) -> np.ndarray:
        """The hidden layer for rows of neighbouring codes."""
        inputs = self.weights["inputs"]
        return np.tanh(self.weights["hidden"] + sum(inputs[slot][sides[slot]] for slot in range(2 * SIDE)))

    def predict(self, sides: np.ndarray, classes: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """The log-probability of each row's class and group."""
        w = self.weights
        order, parts = _by_class(classes)
        classes, groups = classes[order], groups[order]
        hidden = self.hidden(sides[:, order])
        logs = _log_of(hidden @ w["outputs"] + w["bias"], classes)
        for shared, part in parts:
            logs[part] += _log_of(hidden[part] @ w["group_outputs"][shared] + w["group_bias"][shared], groups[part])
        found = np.empty_like(logs)
        found[order] = logs
        return found

    def step(self, sides: np.ndarray, classes: np.ndarray, groups: np.ndarray, squares: "Network") -> None:
        """One step against the mean gradient, with a rate per weight that shrinks with use."""
        w, n = self.weights, len(classes)
        order, parts = _by_class(classes)
        sides, classes, groups = sides[:, order], classes[order], groups[order]
        hidden = self.hidden(sides)
        error = _errors(hidden @ w["outputs"] + w["bias"], classes, n)
        back = error @ w["outputs"].T
        slopes, biases = np.zeros(SHAPES["group_outputs"], np.float32), np.zeros(SHAPES["group_bias"], np.float32)
        for shared, part in parts:
            wrong = _errors(hidden[part] @ w["group_outputs"][shared] + w["group_bias"][shared], groups[part], n)
            back[part] += wrong @ w["group_outputs"][shared].T
            slopes[shared], biases[shared] = hidden[part].T @ wrong, np.ones(len(wrong), np.float32) @ wrong
        back *= 1 - hidden * hidden
        self._move("group_outputs", ..., slopes, squares)
        self._move("group_bias", ..., biases, squares)
        self._move("outputs", ..., hidden.T @ error, squares)
        ones = np.ones(n, np.float32)
        self._move("bias", ..., ones @ error, squares)
        self._move("hidden", ..., ones @ back, squares)
        for slot in range(2 * SIDE):
            order = np.argsort(sides[slot], kind="stable")
            codes = sides[slot][order]
            starts = np.nonzero(np.diff(codes, prepend=-1))[0]
            self._move("inputs", (slot, codes[starts]), np.add.reduceat(back[order], starts), squares)
        for name, (low, high) in BOUNDS.items():
            np.clip(w[name], low, high, out=w[name])

    def _move(self, name: str, at, slope: np.ndarray, squares: "Network") -> None:
        seen = squares.weights[name][at] + slope * slope
        squares.weights[name][at] = seen
        self.weights[name][at] -= RATE * slope / (np.sqrt(seen) + 1e-7)


def _log_of(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-probability of column ``at`` of each row; ``logits`` are lost."""
    picked = logits[np.arange(len(at)), at]
    np.exp(logits, out=logits)
    return picked - np.log(logits @ np.ones(logits.shape[1], np.float32))


def _errors(logits: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The slope of the loss, a mean over ``n`` rows, by ``logits``, which are lost."""
    np.exp(logits, out=logits)
    logits *= (1 / (n * (logits @ np.ones(logits.shape[1], np.float32))))[:, None]
    logits[np.arange(len(at)), at] -= 1 / n
    return logits


def _by_class(classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of the rows by class, and the part of it that each shared class has."""
    order = np.argsort(classes, kind="stable")
    ends = np.searchsorted(classes[order], np.arange(OWN, CLASSES + 1)).tolist()
    return order, [(shared, slice(a, b)) for shared, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of several texts in one array with gaps between; where the words are, and their places in their texts."""
    line = np.frombuffer(GAP + GAP.join(texts) + GAP, "<i4")
    lengths = np.array([len(own) // 4 for own in texts], np.int64)
    starts = SIDE + np.cumsum(np.append(0, lengths[:-1] + SIDE))
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return line, np.repeat(starts, lengths) + place, place


def neighbours(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The codes around the words ``at``, one row per place on the sides."""
    return np.stack([codes[at + offset] for offset in (*range(-SIDE, 0), *range(1, SIDE + 1))])


class _Shard:
    """A shard's own copy of the weights during a round."""

    def __init__(self, weights: np.ndarray, squares: np.ndarray, vocabulary: Vocabulary, round_: int):
        self.network, self.squares, self.vocabulary, self.round = Network.of(weights), Network.of(squares), vocabulary, round_
        self.waiting, self.number, self.seen = [], 0, 0

    def add(self, texts: list[bytes]) -> None:
        line, words, place = _laid_out(texts)
        words = words[(place + self.round) % ROUNDS == 0]
        if len(words):
            own = line[words]
            self.waiting.append((neighbours(self.vocabulary.codes[line], words), self.vocabulary.classes[own], self.vocabulary.groups[own]))
            self.number += len(words)
        if self.number >= BATCH:
            self.flush()

    def flush(self) -> None:
        if not self.number:
            return
        sides = np.concatenate([part[0] for part in self.waiting], axis=1)
        classes, groups = (np.concatenate([part[i] for part in self.waiting]) for i in (1, 2))
        cuts = np.linspace(0, self.number, -(-self.number // BATCH) + 1).astype(int)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            self.network.step(sides[:, a:b], classes[a:b], groups[a:b], self.squares)
        self.seen += self.number
        self.waiting, self.number = [], 0


def _round(words: DataFrame, weights: np.ndarray, squares: np.ndarray, vocabulary: Vocabulary, round_: int) -> DataFrame:
    """``(seen, sums)``: per task the sums of its shards' weights and rates, each times the positions it predicted."""
    shared = words.sparkSession.sparkContext.broadcast((weights, squares, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, squares, vocabulary = shared.value
        total, seen, number, shard = np.zeros(2 * len(weights)), 0, None, None

        def close():
            nonlocal seen
            if shard is not None:
                shard.flush()
                seen += shard.seen
                total[:] += np.concatenate([shard.network.flat(), shard.squares.flat()]) * float(shard.seen)

        for batch in batches:
            numbers = batch.column(0).to_numpy()
            edges = np.append(np.nonzero(np.diff(numbers, prepend=-1))[0], len(numbers))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if numbers[a] != number:
                    close()
                    number, shard = numbers[a], _Shard(weights, squares, vocabulary, round_)
                for at in range(a, b, ROWS):
                    shard.add(batch.column(1).slice(at, min(ROWS, b - at)).to_pylist())
        close()
        yield _sums(seen, total)

    return words.select("shard", "own").mapInArrow(run, "seen long, sums binary")


def _sums(seen: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["seen", "sums"])


def _added(sums: DataFrame, parts: int) -> DataFrame:
    """Rows of sums added up in ``parts`` parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(2 * sum(SIZES.values())), 0
        for batch in batches:
            for i in range(batch.num_rows):
                seen += batch.column(0)[i].as_py()
                total += np.frombuffer(batch.column(1)[i].as_buffer(), np.float64)
        yield _sums(seen, total)

    return sums.repartition(parts).mapInArrow(run, "seen long, sums binary")


def deal(hashed: DataFrame, shards: int) -> DataFrame:
    """``hashed_words`` with their ``shard``, in an order that depends on ids and words alone."""
    dealt = hashed.withColumn("order", F.xxhash64("doc_id", "own")).withColumn("shard", F.pmod("order", F.lit(shards)))
    return dealt.repartition(shards, "shard").sortWithinPartitions("shard", "order").drop("order")


def train(words: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """The weights after ``rounds`` rounds over ``(shard, own)``; ``ROUNDS`` of them predict every position once."""
    weights = Network.initial(vocabulary).flat()
    squares = np.full(len(weights), 1e-8, np.float32)
    for round_ in range(rounds):
        seen, sums = _added(_added(_round(words, weights, squares, vocabulary, round_), PARTS), 1).first()
        if seen:
            weights, squares = np.split((np.frombuffer(sums, np.float64) / seen).astype(np.float32), 2)
    return weights


def pseudo_likelihood(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, n_words, pll, pll_per_word)`` of every row, under a model of the whole table.

    Texts without words, or null, have ``pll`` 0 and no ``pll_per_word``. Repeated rows are
    scored, and counted, once each; an empty table gives no row. Very long texts are handled in
    slices of rows, one text at least. The result reads a table below ``spark.checkpoint.dir``;
    ``release`` deletes it.
    """
    hashed = materialize(hashed_words(docs, doc_id, text), "entries")
    counts = entry_counts(hashed)
    vocabulary = Vocabulary(counts)
    shards = -(-int(counts.sum()) // SHARD_WORDS) or 1
    words = materialize(deal(hashed, shards), "shards")
    release(hashed)
    weights = train(words, vocabulary, rounds)
    shared = docs.sparkSession.sparkContext.broadcast((weights, vocabulary))
    id_type = words.schema["doc_id"].dataType.simpleString()

    def factory():
        weights, vocabulary = shared.value
        network = Network.of(weights)

        def work(ids, texts):
            lengths = [len(own) // 4 for own in texts]
            scored = scores(network, vocabulary, texts)
            return ids, lengths, scored, [s / n if n else None for s, n in zip(scored, lengths, strict=True)]

        return work

    return arrow_map(words.select("doc_id", "own"), f"doc_id {id_type}, n_words long, pll double, pll_per_word double", factory, rows=ROWS)


def scores(network: Network, vocabulary: Vocabulary, texts: list[bytes]) -> list[float]:
    """The sum over each text's words of their log-probabilities given both sides."""
    line, words, _ = _laid_out(texts)
    codes, own = vocabulary.codes[line], line[words]
    each = vocabulary.share[own].astype(np.float64)
    for a in range(0, len(words), BATCH):
        part = slice(a, a + BATCH)
        each[part] += network.predict(neighbours(codes, words[part]), vocabulary.classes[own[part]], vocabulary.groups[own[part]])
    ends = np.cumsum([len(text) // 4 for text in texts])
    sums = np.append(0.0, np.cumsum(each))
    return np.diff(sums[np.append(0, ends)]).tolist()
