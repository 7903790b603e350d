"""Spelling variants of the corpus vocabulary by partition-and-enumerate signatures.

A word is seen as the multiset of its letters, written as a binary vector with one place for
each letter and occurrence number. Two words that are one inserted, deleted or replaced
letter apart differ in at most two places. The places are dealt into ``PARTS`` parts; two
differences leave all but two parts alone, so the two words agree in one of the
``PARTS * (PARTS - 1) / 2`` selections that leave out two parts. Each selection is a
signature, and near words are found by an equality join of signatures.

Multisets alone let anagrams meet. A single edit also leaves the letters before it, or those
after it, in place, so a signature is taken together with the word's first or last half, cut
where a pair's longer word is cut in half. Pairs that agree are verified by edit distance.
Every step is exact: 64-bit hashes only propose pairs.
"""

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map
from tidemark.sources.scratch import materialize, release

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
DROP_EVERY = 31
RATIO = 10
PARTS = 4
#: Distinct words that a task holds before it hands on their counts.
HELD = 200_000


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``(word, n)``: how often each run of letters occurs, where some lose a letter.

    A run loses the letter at h modulo its length if ``DROP_EVERY`` divides h, the CRC-32 of
    ``<doc_id>:<run>``. Runs that stay shorter than ``min_length`` are not counted. Null
    texts have no runs; a null id is written as an empty one.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    find = re.compile(f"[{LETTERS}]{{{min_length},}}").findall

    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def run(batches):
        held: Counter = Counter()
        crc32 = zlib.crc32
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if not value:
                        continue
                    words = find(value.encode().lower().decode())  # bytes lower only A-Z
                    start = crc32(f"{'' if key is None else key}:".encode())
                    held.update([word if (h := crc32(word.encode(), start)) % DROP_EVERY else _without(word, h) for word in words])
                if len(held) > HELD:
                    yield table(held)
                    held.clear()
        yield table(held)

    counted = docs.select(doc_id, text).mapInArrow(run, "word string, n long")
    return counted.filter(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))


def _without(word: str, at: int) -> str:
    at %= len(word)
    return word[:at] + word[at + 1 :]


def _mix(keys: np.ndarray) -> np.ndarray:
    keys = keys ^ (keys >> np.uint64(31))
    keys = keys * np.uint64(0x9E3779B97F4A7C15)
    return keys ^ (keys >> np.uint64(29))


def _halves(word: str) -> list[int]:
    """Hashes of first and last halves, for pairs whose longer word is this one, then for those with one letter more."""
    found = []
    for longer in (len(word), len(word) + 1):
        cut = longer // 2
        for side, half in (("<", word[:cut]), (">", word[len(word) - (longer - cut) :])):
            found.append(xxhash.xxh64_intdigest(f"{longer}{side}{half}"))
    return found


def signatures(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``(word, n, own, longer)``: the keys of each word as the longer one, and as the shorter one, of a pair."""
    chosen = list(combinations(range(parts), parts - 2))

    def factory():
        places: dict[tuple[str, int], int] = {}

        def hashes(word):
            sums, seen = [0] * parts, {}
            for letter in word:
                number = seen[letter] = seen.get(letter, 0) + 1
                place = places.get((letter, number))
                if place is None:
                    if len(places) > HELD:
                        places.clear()
                    place = places[letter, number] = xxhash.xxh64_intdigest(f"{letter}{number}")
                sums[place % parts] ^= place
            return sums

        def work(names, counts):
            if not names:
                return [], [], [], []
            held = np.array([hashes(name) for name in names], np.uint64)
            picked = np.stack([sum((_mix(held[:, p] + np.uint64(17 * p + 1)) for p in choice), np.uint64(97 * i)) for i, choice in enumerate(chosen)], axis=1)
            halves = np.array([_halves(name) for name in names], np.uint64)
            keys = _mix(halves[:, :, None] + _mix(picked)[:, None, :]).view(np.int64).reshape(len(names), 2, -1)
            return names, counts, list(keys[:, 0]), list(keys[:, 1])

        return work

    return arrow_map(words.select("word", "n"), "word string, n long, own array<long>, longer array<long>", factory)


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """Pairs ``(a, a_n, b, b_n)`` of words exactly one edit apart, each pair once."""
    signed = materialize(signatures(words, parts), "signatures")
    own = F.transform("own", lambda key: F.struct(key.alias("key"), F.lit(True).alias("even")))
    longer = F.transform("longer", lambda key: F.struct(key.alias("key"), F.lit(False).alias("even")))
    left = signed.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode("own").alias("key"))
    right = signed.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.explode(F.concat(own, longer)).alias("at"))
    right = right.select("b", "b_n", "at.key", "at.even")
    ordered = F.when(F.col("even"), (F.col("a") < F.col("b")) & (F.length("a") == F.length("b"))).otherwise(F.length("a") == F.length("b") + 1)
    near = F.levenshtein("a", "b", 1) == 1
    met = left.alias("l").join(right.alias("r"), (F.col("l.key") == F.col("r.key")) & ordered & near)
    pairs = materialize(met.select("a", "a_n", "b", "b_n").distinct(), "near-words")
    release(signed)
    return pairs


def spelling_forms(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word with ``min_count`` occurrences.

    ``form`` is the most frequent near word, the first in code-point order among equals, if it
    is ``ratio`` times as frequent as the word; ``root`` follows forms to the last one. Repeated
    rows count once each; an empty table gives no row. The result reads tables below
    ``spark.checkpoint.dir``; ``release`` deletes them.
    """
    words = materialize(word_counts(docs, doc_id, text).filter(F.col("n") >= min_count), "words")
    pairs = near_words(words)
    each = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("a_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near"))).alias("best")
    found = each.groupBy("word").agg(F.count("*").alias("n_near"), best)
    usual = F.when(-F.col("best.order") >= ratio * F.col("n"), F.col("best"))
    forms = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), usual["near"].alias("form"), (-usual["order"]).alias("form_n")
    )
    forms = materialize(forms, "forms")
    release(words, pairs)
    roots = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    held = None
    while True:  # each round doubles the steps; counts grow with every form, so chains are short
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if held is not None:
            release(held)
        held, roots = moved, moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            break
    return forms.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
