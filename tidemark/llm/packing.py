"""Packing of tokenised documents into sequences of fixed capacity by bin completion.

Only the number of pieces of each length decides how well they pack, and there are at most
``capacity`` lengths however many documents there are. The search therefore runs on that
histogram: around the largest length left it enumerates undominated fillings, keeps the
best-fit filling as incumbent, prunes by the waste that is still possible, and applies the
filling to as many sequences as the counts allow. Spark then deals the pieces out to the
places of the plan by their rank within their length.
"""

import re
import zlib
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import arrow_map
from tidemark.sources.scratch import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 2048
END_ID = 0
CACHE = 300_000
#: Steps of the search for one filling.
SEARCH_NODES = 4000
#: Work of one branch-and-bound over sequences: lengths left at all its nodes and steps of listing their fillings.
PLAN_WORK = 300_000
WORD_END = b"\x00"
#: Characters whose normal forms and classes are plain: ASCII, Latin-1 and common punctuation.
PLAIN = r"\x21-\x7e\u00a1-\u00ff\u2010-\u2015\u2018-\u201f\u2026"
LETTERS = "a-zªµºß-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
#: Byte-level vocabularies write a printable byte as itself and number the others from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
OTHERS = [byte for byte in range(256) if byte not in PRINTABLE]
BYTE_OF = {chr(byte): byte for byte in PRINTABLE} | {chr(0x100 + place): byte for place, byte in enumerate(OTHERS)}


class WordCoder:
    """Token ids of a text, as little-endian bytes, with a bounded memory of chunks.

    The vocabulary drops white space and never joins tokens across it, so a text's ids are
    those of its chunks between ASCII white space, one after the other. Chunks met for the
    first time are encoded together. Those of ``PLAIN`` characters go through tiktoken: the
    same merges as ranks of byte strings, where the end of a word is a byte of its own, zero,
    that joins the letter before it ahead of all other merges. The rest, and chunks that name
    a special token, go through the tokenizers library.
    """

    def __init__(self, path: str, cache: int = CACHE):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = {_as_bytes(token): number for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.ranked = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.cut = ranks[b"\n" + WORD_END]
        self.plain = re.compile(f"[{PLAIN}]+").fullmatch
        self.split = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+").findall
        self.cache = cache
        self.young: dict = {}
        self.old: dict = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [text.encode().split() for text in texts]
        self._learn(set().union(*split))
        ids = self.young
        return [b"".join([ids[chunk] for chunk in chunks]) for chunks in split]

    def _learn(self, chunks: set[bytes]) -> None:
        """Put ``chunks`` into the young memory; when that is full it becomes the old one."""
        if len(self.young) + len(missing := chunks.difference(self.young)) > self.cache:
            self.old, self.young, missing = self.young, {}, chunks
        old, young, new = self.old, self.young, []
        for chunk in missing:
            ids = old.get(chunk)
            if ids is None:
                new.append(chunk.decode())
            else:
                young[chunk] = ids
        plain = [chunk for chunk in new if self.plain(chunk) and not ("<|" in chunk and any(name in chunk for name in self.special))]
        if plain:
            text = "\x00".join(self.split("\n".join(plain).lower() + "\n")) + "\x00"
            ids = np.array(self.ranked.encode_ordinary(text), "<u4")
            ends = np.nonzero(ids == self.cut)[0].tolist()
            data, start = ids.tobytes(), 0
            for chunk, end in zip(plain, ends, strict=True):
                young[chunk.encode()] = data[4 * start : 4 * end]
                start = end + 1
        odd = list(set(new).difference(plain))
        for chunk, coded in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            young[chunk.encode()] = np.array(coded.ids, "<u4").tobytes()


def _as_bytes(token: str) -> bytes:
    """The bytes that a vocabulary entry stands for, with ``WORD_END`` where a word ends."""
    end = token.endswith("</w>") and len(token) > 4
    return bytes(BYTE_OF[letter] for letter in (token[:-4] if end else token)) + (WORD_END if end else b"")


@lru_cache(maxsize=2)
def word_coder(path: str) -> WordCoder:
    return WordCoder(path)


def token_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """The token pieces of every document; only documents longer than ``capacity`` are cut.

    Null text counts as empty: such a document is its end token alone. Pieces of equal length
    are placed in the order of their table's parts, then of ids and pieces.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, ids binary"
    end = np.array([end_id], "<u4").tobytes()

    def factory():
        coder = word_coder(path)
        width = 4 * capacity

        def work(doc_ids, texts):
            rows = []
            for key, coded in zip(doc_ids, coder.encode([value or "" for value in texts]), strict=True):
                ids = coded + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            return list(zip(*rows, strict=True)) if rows else [[]] * 6

        return work

    out = arrow_map(docs.select(doc_id, text), schema, factory)
    return out if with_ids else out.drop("ids")


def best_fit(counts: list[int], room: int) -> list[int]:
    """Lengths chosen greedily, largest first, that fit into ``room``."""
    taken: list[int] = []
    length = room
    while room > 0 and length > 0:
        length = min(length, room)
        if counts[length] > taken.count(length):
            taken.append(length)
            room -= length
        else:
            length -= 1
    return taken


def complete(counts: list[int], lengths: list[int], room: int, nodes: int = SEARCH_NODES) -> list[int]:
    """The filling of ``room`` with the least waste, larger lengths first among equals.

    ``lengths`` are those with pieces left, ascending. A filling is dominated when a longer
    piece would fit in the place of a shorter one that follows the same choices; descending
    order meets the longer first. The search ends at no waste, or after ``nodes`` steps with
    the best filling so far, which is never worse than best fit.
    """
    best = best_fit(counts, room)
    least = room - sum(best)
    budget = nodes
    volume = np.cumsum([length * counts[length] for length in lengths]).tolist()

    def visit(space: int, upto: int, taken: list[tuple[int, int]]) -> bool:
        """Go on from ``taken``, (length, number) pairs, with lengths below ``upto``; one level per distinct length."""
        nonlocal best, least, budget
        at = bisect_left(lengths, min(space + 1, upto)) - 1
        while at >= 0 and space - volume[at] < least:  # all shorter pieces together must beat the best waste
            length = lengths[at]
            for number in range(min(counts[length], space // length), 0, -1):
                budget -= 1
                rest = space - number * length
                if rest < least:
                    best, least = [x for x, n in (*taken, (length, number)) for _ in range(n)], rest
                if least == 0 or budget <= 0 or visit(rest, length, [*taken, (length, number)]):
                    return True
            at -= 1
        return False

    if least and room:
        visit(room, room + 1, [])
    return best


def _fill(histogram: dict[int, int], capacity: int, choose) -> list[tuple[list[int], int]]:
    counts = [0] * (capacity + 1)
    for length, count in histogram.items():
        counts[length] = count
    lengths = sorted(length for length, count in histogram.items() if count)
    plan = []
    while lengths:
        largest = lengths[-1]
        counts[largest] -= 1
        pattern = [largest, *choose(counts, lengths, capacity - largest)]
        counts[largest] += 1
        need = {length: pattern.count(length) for length in set(pattern)}
        times = min(counts[length] // number for length, number in need.items())
        for length, number in need.items():
            counts[length] -= times * number
        plan.append((pattern, times))
        lengths = [length for length in lengths if counts[length]]
    return plan


def fillings(counts: list[int], lengths: list[int], room: int, steps: int) -> tuple[list[list[int]], int]:
    """All undominated fillings of ``room``, least waste first, and the steps left; none left if they ran out.

    A filling is dominated when another piece still fits, or fits in the place of a shorter
    one; and all others are when one piece fills the room.
    """
    if counts[room]:
        return [[room]], steps
    found: list[tuple[int, list[int]]] = []
    left = steps

    def dominated(space: int, taken: dict[int, int]) -> bool:
        free = [x for x in lengths if counts[x] > taken.get(x, 0)]
        return bool(free and free[0] <= space or any(0 < x - y <= space for y in taken for x in free[bisect_right(free, y) : bisect_right(free, y + space)]))

    def visit(space: int, upto: int, taken: dict[int, int]) -> None:
        """Add fillings from ``taken`` on with lengths below ``upto``; one level per distinct length."""
        nonlocal left
        left -= 1
        for at in range(bisect_left(lengths, min(space + 1, upto)) - 1, -1, -1):
            length = lengths[at]
            for number in range(min(counts[length], space // length), 0, -1):
                if left <= 0:
                    return
                visit(space - number * length, length, taken | {length: number})
        if not dominated(space, taken):
            found.append((space, [x for x, n in taken.items() for _ in range(n)]))

    visit(room, room + 1, {})
    return [taken for _, taken in sorted(found, key=lambda pair: (pair[0], [-x for x in pair[1]]))], left


def branch(histogram: dict[int, int], capacity: int, fewest: int, work: int = PLAN_WORK, single: bool = True) -> list[tuple[list[int], int]] | None:
    """A plan of less than ``fewest`` sequences, the best found within ``work``, or None.

    Depth-first over the fillings of the largest length, each for as many copies as there are
    and, if ``single``, for one, which the next node may repeat: with ``single`` the search is
    exhaustive if it ends within ``work``. A node is cut when the total and the waste so far need ``fewest`` sequences.
    """
    counts = [0] * (capacity + 1)
    for length, count in histogram.items():
        counts[length] = count
    total = sum(length * count for length, count in histogram.items())
    least = -(-total // capacity)
    best = None
    stack: list[tuple[list[int], int, int, tuple | None]] = [(counts, 0, 0, None)]
    seen = set()
    while stack and work > 0 and fewest > least:
        counts, used, waste, path = stack.pop()
        if max(used, -(-(total + waste) // capacity)) >= fewest:
            continue
        lengths = [length for length, count in enumerate(counts) if count]
        work -= 1 + len(lengths)
        if not lengths:
            best, fewest = path, used
            continue
        state = (used, *((length, counts[length]) for length in lengths))
        if state in seen:
            continue
        seen.add(state)
        largest = lengths[-1]
        counts[largest] -= 1
        children = []
        listed, work = fillings(counts, [x for x in lengths if counts[x]], capacity - largest, work)
        for filling in listed:
            pattern = [largest, *filling]
            most = min((counts[x] + (x == largest)) // pattern.count(x) for x in set(pattern))
            for times in {most, 1} if single else {most}:
                after = counts.copy()
                after[largest] += 1
                for length in pattern:
                    after[length] -= times
                children.append((-times, (capacity - sum(pattern)), after, (path, pattern, times)))
        children.sort(key=lambda child: (child[1], child[0]))
        stack += [(after, used - times, waste - times * spare, way) for times, spare, after, way in reversed(children)]
    if best is None:
        return None
    plan = []
    while best:
        best, pattern, times = best
        plan.append((pattern, times))
    return plan[::-1]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns of lengths and how many sequences follow each, as few sequences as found.

    The plan by best fit is the incumbent; bin completion replaces it when it is better, and
    is not tried when the incumbent already meets the bound by total length. Branch-and-bound
    over sequences then looks for fewer, within ``PLAN_WORK``; with that used up the plan
    need not be the optimum.
    """
    total = sum(length * count for length, count in histogram.items())
    incumbent = _fill(histogram, capacity, lambda counts, lengths, room: best_fit(counts, room))
    if sum(times for _, times in incumbent) * capacity < total + capacity:
        return incumbent
    better = _fill(histogram, capacity, complete)
    number = lambda plan: sum(times for _, times in plan)
    incumbent = min(better, incumbent, key=number)
    for single in (False, True):  # the small tree first, as its plans cut the large one
        incumbent = branch(histogram, capacity, number(incumbent), single=single) or incumbent
    return incumbent


def _places(plan: list[tuple[list[int], int]]) -> dict[int, tuple]:
    """Per length: first rank of each pattern that holds it, with what places a rank there."""
    found: dict[int, list] = {}
    next_rank: dict[int, int] = {}
    base = 0
    for pattern, times in plan:
        ordered = sorted(pattern, reverse=True)
        for length in dict.fromkeys(ordered):
            number = ordered.count(length)
            rank = next_rank.get(length, 0)
            offset = sum(x for x in ordered if x > length)
            found.setdefault(length, []).append((rank, number, base, offset))
            next_rank[length] = rank + times * number
        base += times
    return {length: tuple(np.array(column) for column in zip(*rows, strict=True)) for length, rows in found.items()}


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``token_pieces`` with the ``sequence_id`` and ``offset`` at which each is packed.

    Repeated rows are packed once each; an empty table gives no row. Columns other than the
    two named are not read.
    """
    pieces = token_pieces(docs, doc_id, text, path, capacity, end_id, with_ids)
    pieces = materialize(pieces.withColumn("block", F.spark_partition_id()), "token-pieces")
    sizes = materialize(pieces.groupBy("block", "length").agg(F.count("*").alias("n")), "piece-sizes")
    histogram = {row["length"]: row["n"] for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan_sequences(histogram, capacity))

    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("prior"))
    within = Window.partitionBy("block", "length").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("local", F.row_number().over(within) - 1).join(starts.hint("merge"), ["block", "length"])
    columns = [name for name in pieces.columns if name != "block"]
    ranked = ranked.select(*columns, (F.col("prior") + F.col("local")).alias("rank"))
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in pieces.select(*columns).schema)
    at = columns.index("length")

    def factory():
        def work(*values):
            sequence, offset = [], []
            for length, rank in zip(values[at], values[-1], strict=True):
                ranks, numbers, bases, offsets = places[length]
                i = int(np.searchsorted(ranks, rank, side="right")) - 1
                instance, slot = divmod(rank - int(ranks[i]), int(numbers[i]))
                sequence.append(int(bases[i]) + instance)
                offset.append(int(offsets[i]) + slot * length)
            return [*values[:-1], sequence, offset]

        return work

    return arrow_map(ranked, f"{schema}, sequence_id long, offset long", factory)
