"""Byte-level BPE encoding and decoding, with tree concatenation for long texts.

A long text is cut into leaves at fixed numbers of characters, wherever that falls, and the
leaves are encoded in parallel, each as if it were the whole text. Neighbours are then joined
pairwise, level by level. At each join a window around the border is encoded anew and grown
until its outer tokens on both sides are those of the halves, over a stretch that shows the
rest to be right as well. Such a stretch holds a letter before white space or punctuation,
where every encoding has a border and neither side sees the other; or it is several tokens
within one run of letters, digits, white space or symbols: then each adjacent pair of tokens
of that run has come out of an encoding of the text around it, which makes the whole its encoding.
"""

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import arrow_map

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG_TEXT = 16384
LEAF = 4096
WINDOW = 32
MARGIN = 4

# letters of blocks that have long been complete; no special token holds such a place
BORDER = regex.compile(r"(?V1)[\p{L}&&[A-\uD7A3]](?=[ \n\t.,;:!?()\u3001\u3002\uFF0C])")
ONE_RUN = regex.compile(r"\p{L}+|\p{N}+|\p{White_Space}+|[^\s\p{L}\p{N}]+")


class Codec:
    """The vocabulary: encoding of text and of single pieces, and decoding."""

    def __init__(self, tokenizer_path: str, ranks_path: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        added = Tokenizer.from_file(tokenizer_path).get_added_tokens_decoder()
        self.special = {token.content: number for number, token in added.items()}
        self.bpe = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )
        self.names = set(self.special)
        self.width = "<u2" if self.bpe.max_token_value < 2**16 else "<u4"

    def encode(self, text: str) -> list[int]:
        return self.bpe.encode(text, allowed_special=self.names)

    def decode(self, ids: list[int]) -> str:
        return self.bpe.decode_bytes(ids).decode("utf-8", "replace")

    def inside(self, token: int) -> bool:
        """Whether the token begins within a character."""
        return self.bpe.decode_single_token_bytes(token)[0] & 0xC0 == 0x80


@lru_cache(maxsize=4)
def codec(tokenizer_path: str, ranks_path: str) -> Codec:
    return Codec(tokenizer_path, ranks_path)


def settled(coder: Codec, agreed: list[int], outer: list[int]) -> bool:
    """Whether the tokens on which a window and a half agree, ``outer`` the outermost, show all beyond to be right."""
    if len(agreed) < MARGIN:
        return False
    return bool(BORDER.search(coder.decode(agreed)) or ONE_RUN.fullmatch(coder.decode(outer).strip("\ufffd")))


def join(coder: Codec, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
    """The encoding of a text from those of its two parts."""
    if not left or not right:
        return left + right
    while True:
        start, stop = max(0, len(left) - window), min(window, len(right))
        while start and coder.inside(left[start]):
            start -= 1
        while stop < len(right) and coder.inside(right[stop]):
            stop += 1
        head, tail = left[start:], right[:stop]
        new = coder.encode(coder.decode(head + tail))
        before = next((i for i, (x, y) in enumerate(zip(new, head)) if x != y), min(len(new), len(head)))  # noqa: B905
        after = next((i for i, (x, y) in enumerate(zip(new[::-1], tail[::-1])) if x != y), min(len(new), len(tail)))  # noqa: B905
        if (not start or settled(coder, new[:before], new[:MARGIN])) and (
            stop == len(right) or settled(coder, new[len(new) - after :], new[-MARGIN:])
        ):
            return left[:start] + new + right[stop:]
        window *= 2


def concatenate(coder: Codec, leaves: list[list[int]]) -> list[int]:
    """Join encoded neighbours pairwise, level by level."""
    while len(leaves) > 1:
        pairs = [join(coder, a, b) for a, b in zip(leaves[::2], leaves[1::2])]  # noqa: B905
        leaves = pairs + leaves[len(pairs) * 2 :]
    return leaves[0] if leaves else []


def bpe_encode(
    docs: DataFrame,
    text: str = "text",
    tokenizer_path: str = TOKENIZER,
    ranks_path: str = RANKS,
    long_text: int = LONG_TEXT,
    leaf: int = LEAF,
    columns: list[str] | None = None,
) -> DataFrame:
    """``docs``, or only its ``columns`` named, with ``ids`` and the text ``decoded`` from them.

    Null text counts as empty and gives no ids. Equal to the tokenizers library without
    added special tokens; the name of a special token inside a text is that token. Other
    columns pass through, but a column that is itself called ids or decoded is replaced.
    Texts of ``long_text`` characters and more are joined from leaves of ``leaf``. Repeated
    rows are returned as often as they occur; an empty table gives no rows.
    """
    kept = [name for name in (docs.columns if columns is None else columns) if name not in ("ids", "decoded")]
    names = [f"__c{i}" for i in range(len(kept))]  # whatever they are called, they clash with nothing
    own = [F.col(name).alias(inner) for name, inner in zip(kept, names, strict=True)]
    rows = docs.select(*own, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    is_long = F.length("__text") >= long_text
    plain = _encode_plain(rows.filter(~is_long), names, tokenizer_path, ranks_path)
    same = names[kept.index(text)] if text in kept else None
    tall = _encode_long(rows.filter(is_long), names, same, tokenizer_path, ranks_path, leaf)
    return plain.unionByName(tall).toDF(*kept, "ids", "decoded")


def _encode_plain(rows: DataFrame, kept: list[str], tokenizer_path: str, ranks_path: str) -> DataFrame:
    fields = rows.select(*kept).schema
    schema = ", ".join([f"`{field.name}` {field.dataType.simpleString()}" for field in fields] + ["ids array<int>", "decoded string"])

    def factory():
        coder = codec(tokenizer_path, ranks_path)

        def work(*columns):
            ids = [coder.encode(value) for value in columns[-1]]
            return [*columns[:-1], ids, [coder.decode(value) for value in ids]]

        return work

    return arrow_map(rows, schema, factory)


def _encode_long(rows: DataFrame, kept: list[str], text: str | None, tokenizer_path: str, ranks_path: str, leaf: int) -> DataFrame:
    """Equal rows are encoded once and counted; the text is what their ids decode to, so it travels as leaves only."""
    side = [name for name in kept if name != text]
    fields = rows.select(*side).schema
    given = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
    held = f"__key binary, __leaf long, __part string{', ' if given else ''}{given}"

    def cut():
        def work(keys, values, *others):
            out = []
            for key, value, *own in zip(keys, values, *others, strict=True):
                for i, at in enumerate(range(0, len(value), leaf)):
                    out.append((key, i, value[at : at + leaf], *(own if i == 0 else [None] * len(own))))
            return list(zip(*out, strict=True)) if out else [[] for _ in range(3 + len(others))]

        return work

    def encode():
        coder = codec(tokenizer_path, ranks_path)
        return lambda keys, leaves, counts, parts, *others: (
            keys, leaves, counts, [np.array(coder.encode(part), coder.width).tobytes() for part in parts], *others
        )

    def tree():
        coder = codec(tokenizer_path, ranks_path)

        def work(counts, groups, *others):
            ids = [concatenate(coder, [np.frombuffer(part["ids"], coder.width).tolist() for part in group]) for group in groups]
            return counts, ids, [coder.decode(value) for value in ids], *others

        return work

    own = [F.to_json(F.struct(*side))] if side else []
    key = F.unhex(F.sha2(F.concat_ws("\n", F.sha2("__text", 256), *own), 256)).alias("__key")
    first = [F.first(name, ignorenulls=True).alias(name) for name in side]
    # equal leaves of equal rows meet in one aggregation, which also deals the leaves to tasks
    leaves = arrow_map(rows.select(key, "__text", *side), held, cut, rows=16)
    leaves = leaves.groupBy("__key", "__leaf").agg(F.count("*").alias("__n"), F.first("__part").alias("__part"), *first)
    coded = arrow_map(leaves, held.replace("__part string", "__n long, __ids binary"), encode, rows=64)
    parts = F.sort_array(F.collect_list(F.struct(F.col("__leaf").alias("leaf"), F.col("__ids").alias("ids"))))
    whole = coded.groupBy("__key").agg(F.first("__n").alias("__n"), parts.alias("__parts"), *first).drop("__key")
    done = arrow_map(whole, f"__n long, ids array<int>, decoded string{', ' if given else ''}{given}", tree, rows=16)
    done = done.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    return done.select(*(F.col("decoded").alias(name) if name == text else name for name in kept), "ids", "decoded")
