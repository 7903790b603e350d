"""Benchmark passages in documents, by a prefix-filtered set join of word shingles.

Windows are ``WINDOW`` consecutive words of an item, or all words of a shorter one. A window
is a set of shingles (``SHINGLE`` consecutive words, fewer where a window is shorter), and
a document holds it only if it holds all of them. With every shingle needed, the prefix of a
window in rarity order is its rarest shingle alone, so only those are joined. The place of the
shingle fixes where the window would begin; it must lie inside the words that the document
has (length and positional bounds), and the words there are then compared one by one.

One pass reads the documents. It keeps only stretches in which every shingle could be one of a
window, tested on a bit map of at most ``2 ** MAP_BITS`` bits, so what is shuffled afterwards
follows the matched text and not the corpus. Hashes and the map only propose; windows are
found by their words. The map is the one thing sent everywhere, and its size does not grow
past its bound: a larger benchmark lets more stretches through, and the result is the same.

Null texts have no words. Repeated document rows are rows of their own; an item id that
occurs in several rows is one item with the windows of all of them, and a null item id is
written as an empty string. An empty benchmark marks nothing, an empty table gives no row.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import arrow_map
from tidemark.sources.scratch import materialize, release

WINDOW = 10
SHINGLE = 5
MAP_BITS = 27
#: Bytes of text that are hashed at once, and bits of the map per shingle of the benchmark.
BLOCK_BYTES = 1 << 20
SPREAD = 64
#: Lower case a-z, digits and every byte of a character past ASCII; capitals count as lower case.
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWERED = np.arange(256, dtype=np.uint64)
LOWERED[0x41:0x5B] += 32
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str | bytes | None) -> list[str]:
    """The words of a text, A-Z lower-cased."""
    raw = (text or "").encode() if not isinstance(text, bytes) else text
    return [word.decode() for word in WORDS(raw.lower())]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base & 0xFFFFFFFFFFFFFFFF
    return np.multiply.accumulate(out)


class _Hasher:
    """64-bit hashes of words in UTF-8 bytes, whole arrays at a time."""

    def __init__(self):
        self.up, self.down = _powers(BASE, 0), _powers(BASE_INVERSE, 0)

    def words(self, raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and hash of the words in ``raw``; no word runs over a place in ``cuts``."""
        n = len(raw)
        if n > len(self.up):
            self.up, self.down = _powers(BASE, n + n // 4), _powers(BASE_INVERSE, n + n // 4)
        inside = IS_WORD[raw]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        begins[cuts] |= inside[cuts]
        ends[cuts - 1] |= inside[cuts - 1]
        start, end = np.nonzero(begins)[0], np.nonzero(ends)[0] + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(np.where(inside, LOWERED[raw] + np.uint64(1), np.uint64(0)) * self.up[:n], out=sums[1:])
        return start, end, mixed((sums[end] - sums[start]) * self.down[start])


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return keys ^ (keys >> np.uint64(29))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of ``size`` words from each word on; shorter by ``size - 1`` than ``words``."""
    if len(words) < size:
        return words[:0]
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = total * STEP + words[k : len(words) - size + 1 + k]
    return mixed(total + np.uint64(size))


def _blocks(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have at most ``BLOCK_BYTES``, one row at least."""
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1)
        yield at, to
        at = to


def _word_arrays(hasher: _Hasher, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_Hasher.words`` in blocks that end between words, so a long text needs little room."""
    found, at, n = [], 0, len(raw)
    while at < n:
        to = min(n, at + BLOCK_BYTES)
        while to < n and IS_WORD[raw[to - 1]] and IS_WORD[raw[to]]:
            rest = np.nonzero(~IS_WORD[raw[to : to + 4096]])[0]
            to = min(n, to + (int(rest[0]) if len(rest) else 4096))
        cuts = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, to)] - at
        start, end, keys = hasher.words(raw[at:to], cuts)
        found.append((start + at, end + at, keys))
        at = to
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


class _Stretches:
    """Finds the stretches of each text in which windows could lie."""

    def __init__(self, bitmap: np.ndarray, bits: int, lengths: dict[int, int]):
        """``lengths``: the size of the shingles of windows, by the number of their words."""
        self.hasher, self.bitmap, self.shift, self.lengths = _Hasher(), bitmap, np.uint64(64 - bits), lengths

    def _known(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def find(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, list[str]]]]]:
        """The number of words of each text, and its stretches as first word and words."""
        start, end, keys = _word_arrays(self.hasher, raw, offsets)
        row = np.searchsorted(offsets, start, side="right") - 1
        n = np.bincount(row, minlength=len(offsets) - 1)
        first = np.concatenate([[0], np.cumsum(n)])
        held = np.zeros(len(keys) + 1, np.int64)  # +1 where a window could begin, -1 after its end
        by_size = {size: self._known(shingle_hashes(keys, size)) for size in set(self.lengths.values())}
        for length, size in self.lengths.items():
            if len(keys) < length:
                continue
            places = len(keys) - length + 1
            begins = row[:places] == row[length - 1 :]
            for k in range(length - size + 1):
                begins &= by_size[size][k : k + places]
            at = np.nonzero(begins)[0]
            np.add.at(held, at, 1)
            np.add.at(held, at + length, -1)
        out: list[list[tuple[int, list[str]]]] = [[] for _ in range(len(n))]
        inside = np.cumsum(held[:-1]) > 0
        if inside.any():
            edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
            for a, b in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist(), strict=True):
                while a < b:  # neighbouring texts may both be inside
                    to = min(b, int(first[row[a] + 1]))
                    words = words_of(raw[start[a] : end[to - 1]].tobytes())
                    out[row[a]].append((a - int(first[row[a]]), words))
                    a = to
        return n, out


def _windows(items: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """``(item, words, keys)``: the windows of every item and the hashes of their shingles."""

    def factory():
        hasher = _Hasher()

        def work(ids, texts):
            rows = []
            for key, value in zip(ids, texts, strict=True):
                words = words_of(value)
                raw = np.frombuffer(" ".join(words).encode(), np.uint8)
                hashes = hasher.words(raw, np.zeros(0, np.int64))[2] if words else np.zeros(0, np.uint64)
                length = min(window, len(words))
                size = min(shingle, length)
                for at in range(len(words) - length + 1 if length else 0):
                    keys = shingle_hashes(hashes[at : at + length], size).view(np.int64)
                    rows.append((key or "", words[at : at + length], keys))
            return list(zip(*rows, strict=True)) if rows else [[], [], []]

        return work

    ids = items.select(F.col(item_id).cast("string"), text)
    return arrow_map(ids, "item string, words array<string>, keys array<long>", factory, rows=16)


def _bitmap(spark: SparkSession, windows: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of all shingles of windows, one per hash by its leading digits, as 64-bit words."""
    keys = windows.select(F.explode("keys").alias("key")).distinct()
    number = keys.count()
    bits = min(MAP_BITS, max(12, (SPREAD * number).bit_length()))
    at = F.call_function("shiftrightunsigned", "key", F.lit(64 - bits))
    words = keys.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))).alias("held")
    )
    rows = words.toPandas()  # at most 2 ** (MAP_BITS - 6) rows
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[rows["word"].to_numpy(np.int64)] = rows["held"].to_numpy(np.int64)
    return bitmap.view(np.uint64), bits


def _stretches(docs: DataFrame, doc_id: str, text: str, bitmap: np.ndarray, bits: int, lengths: dict[int, int]) -> DataFrame:
    """``(doc_id, n_words, stretches)`` of every row."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, stretches array<struct<start: long, words: array<string>>>"
    fields = to_arrow_schema(StructType.fromDDL(schema))
    shared = docs.sparkSession.sparkContext.broadcast((bitmap, bits, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Stretches(*shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for at, to in _blocks(raw, offsets):
                part = offsets[at : to + 1] - offsets[at]
                n, found = finder.find(raw[offsets[at] : offsets[to]], part)
                rows = [[{"start": start, "words": words} for start, words in each] for each in found]
                columns = [batch.column(0).slice(at, to - at), pa.array(n, pa.int64()), pa.array(rows, fields.field(2).type)]
                yield pa.RecordBatch.from_arrays([column.cast(field.type) for column, field in zip(columns, fields, strict=True)], schema=fields)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def _merged_spans(hits: DataFrame) -> DataFrame:
    """``(row, spans)``: overlapping and touching hits of a row as one span each, in order."""
    order = Window.partitionBy("row").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.select("row", "start", "end", F.when(reached >= F.col("start"), 0).otherwise(1).alias("opens"))
    numbered = opened.withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("row", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``(doc_id, n_words, spans, items)`` of every row: hit words as ``(start, end)``, ids of the items found.

    ``items`` holds ids as strings, sorted and each once; it is as long as the benchmark at most.
    The result reads tables below ``spark.checkpoint.dir``; ``release`` deletes them.
    """
    spark = docs.sparkSession
    windows = materialize(_windows(items, item_id, item_text, window, shingle), "benchmark-windows")
    lengths = {row["n"]: min(shingle, row["n"]) for row in windows.select(F.size("words").alias("n")).distinct().collect()}
    bitmap, bits = _bitmap(spark, windows)
    read = materialize(
        _stretches(docs, doc_id, text, bitmap, bits, lengths).withColumn("row", F.monotonically_increasing_id()), "stretches"
    )

    # one row per place in a stretch and shingle size, with the words that a window around it could have
    sizes = F.array(*(F.lit(size) for size in sorted(set(lengths.values())))) if lengths else F.array().cast("array<int>")
    pieces = read.select("row", F.explode("stretches").alias("piece")).select("row", "piece.start", "piece.words")
    placed = pieces.select("*", F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias("at"))
    placed = placed.select("*", F.explode(sizes).alias("size")).filter(F.col("at") + F.col("size") <= F.size("words"))
    low = F.greatest(F.col("at") - (window - shingle), F.lit(0))
    tokens = placed.select(
        "row",
        (F.col("start") + F.col("at")).alias("place"),
        F.array_join(F.slice("words", F.col("at") + 1, F.col("size")), " ").alias("token"),
        (F.col("at") - low).alias("behind"),
        F.slice("words", low + 1, window + window - shingle).alias("near"),
    )
    tokens = materialize(tokens, "tokens")
    rarity = tokens.groupBy("token").agg(F.count("*").alias("n"))

    size = F.least(F.lit(shingle), F.size("words"))
    places = F.sequence(F.lit(0), F.size("words") - size)
    at = F.transform(places, lambda i: F.struct(F.array_join(F.slice("words", i + 1, size), " ").alias("token"), i.alias("offset")))
    shingled = windows.select("words").distinct().select("words", F.explode(at).alias("at")).select("words", "at.token", "at.offset")
    # a window with a shingle that no stretch holds occurs nowhere
    ranked = shingled.join(rarity, "token", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("rarest")
    )
    prefixes = ranked.filter("rarest.n > 0").select("words", "rarest.token", "rarest.offset", F.size("words").alias("length"))

    begin = F.col("behind") - F.col("offset")
    met = tokens.join(prefixes, "token").filter((begin >= 0) & (begin + F.col("length") <= F.size("near")))
    found = met.filter(F.slice("near", begin + 1, F.col("length")) == F.col("words"))
    start = F.col("place") - F.col("offset")
    hits = materialize(found.select("row", start.alias("start"), (start + F.col("length")).alias("end"), "words"), "hits")

    spans = _merged_spans(hits.select("row", "start", "end"))
    named = hits.select("row", "words").distinct().join(windows.select("words", "item").distinct(), "words")
    listed = named.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    marked = spans.join(listed, "row")
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")
    result = read.drop("stretches").join(marked, "row", "left").select(
        "doc_id", "n_words", F.coalesce("spans", empty).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
    release(tokens)
    return result

