"""Secret scans: fixed patterns, and a battery of randomness tests for other long tokens.

A token is a candidate when its characters fit an encoding that secrets come in. The battery
asks whether it looks drawn evenly from the alphabet of that encoding: a chi-squared test of
the symbol counts, a runs test about the middle of the alphabet, and a test of the serial
correlation of neighbours. The three p-values are combined by Bonferroni's bound.

Short prose passes such tests by chance, and the shorter the more often. So each candidate is
also held against prose: a model of which character follows which, counted over all prose of
the table on top of a fixed sample. Under that model the token's probability divided by its
probability as even draws is a p-value, whatever its length and encoding (Markov's bound, with
a share for each alphabet). Benjamini-Hochberg over all long tokens of the table then keeps the
false discoveries at ``FDR``; a single strong token needs no others beside it. The counts and a
small histogram are all that is gathered from the table.
"""

import math
import re
from collections.abc import Iterable, Iterator
from importlib import resources

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map

FDR = 0.05
MIN_LENGTH = 20
#: Draws that are even pass the battery but for this share.
EVEN = 0.001
#: The histogram of strengths, -log p: number and width of its bins.
BINS, STEP = 400, 0.25
#: Spans at the same start are listed in this order.
KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_LENGTH)
HINTS = ("passw", "secret", "token", "api")

HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
BASE62 = BASE64[:62]
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {"hex": HEX_DIGITS, "letters": LETTERS, "base32": BASE32, "base36": BASE36, "base62": BASE62, "base64": BASE64}
CODES = {name: {symbol: i for i, symbol in enumerate(alphabet)} for name, alphabet in ALPHABETS.items()}
CODES["base64"] |= {"-": 62, "_": 63}
#: Each alphabet as it may be written, in upper and lower case.
WRITTEN = len(ALPHABETS) + 3
#: Encodings of one case, whose tokens may be cut into groups by dashes or underscores.
ONE_CASE = frozenset(("hex", "letters", "base32", "base36"))
#: States of the prose model: the characters of tokens, and last what stands between them.
SYMBOLS = BASE64 + "-_"
OUTSIDE = len(SYMBOLS)
PLACE = {symbol: i for i, symbol in enumerate(SYMBOLS)}
PLACES = np.full(256, OUTSIDE, np.int64)
PLACES[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(OUTSIDE)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, kind as a place in ``KINDS``."""
    found = []
    low = text.lower()
    if any(hint in low for hint in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def ungrouped(token: str) -> str:
    """A token without padding, dashes and underscores."""
    return token.rstrip("=").replace("-", "").replace("_", "")


def encoding_of(token: str) -> str | None:
    """The encoding whose alphabet the token fits, or None for plain numbers and signs.

    In the alphabets of one case dashes and underscores only group, as in a UUID.
    """
    core = set(ungrouped(token))
    letters = {c for c in core if c.isalpha()}
    digits = any(c.isdigit() for c in core)
    if letters and core <= set(BASE36) or core <= set(BASE36.upper()) and letters:
        if not digits:
            return "letters"
        if core <= set(HEX_DIGITS) or core <= set(HEX_DIGITS.upper()):
            return "hex"
        return "base32" if core <= set(BASE32) else "base36"
    if any(c.islower() for c in letters) and any(c.isupper() for c in letters):
        return "base62" if set(token.rstrip("=")) <= set(BASE62) else "base64"
    return None


def _upper_tail(statistic: float, freedom: int) -> float:
    """P(chi-squared >= statistic) by the cube-root normal approximation."""
    spread = 2 / (9 * freedom)
    return 0.5 * math.erfc(((statistic / freedom) ** (1 / 3) - 1 + spread) / math.sqrt(2 * spread))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(values: list[int], size: int) -> float:
    """Combined p-value of ``values`` as even draws from ``range(size)``."""
    n = len(values)
    cells = max(2, min(size, n // 5))
    counts = [0] * cells
    for value in values:
        counts[value * cells // size] += 1
    widths = [0] * cells
    for value in range(size):
        widths[value * cells // size] += 1
    chi = sum((count - n * width / size) ** 2 / (n * width / size) for count, width in zip(counts, widths, strict=True))
    uniform = _upper_tail(chi, cells - 1)

    high = [2 * value >= size for value in values]
    up = sum(high)
    down = n - up
    if up and down:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:]))  # noqa: B905
        mean = 1 + 2 * up * down / n
        variance = (mean - 1) * (mean - 2) / (n - 1)
        even = _two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    else:
        even = 2.0 ** (1 - n)

    middle = sum(values) / n
    around = [value - middle for value in values]
    total = sum(x * x for x in around)
    if total:
        r = sum(a * b for a, b in zip(around, around[1:])) / total  # noqa: B905
        serial = _two_sided((r + 1 / n) * math.sqrt(n))
    else:
        serial = 0.0
    return min(1.0, 3 * min(uniform, even, serial))


def read_as(token: str, encoding: str) -> list[int]:
    """Places in the alphabet; a character outside it counts by its code."""
    code, size = CODES[encoding], len(ALPHABETS[encoding])
    token = ungrouped(token) if encoding in ONE_CASE else token.rstrip("=")
    if encoding in ("hex", "letters", "base36"):
        token = token.lower()
    return [code.get(symbol, ord(symbol) % size) for symbol in token]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """``(start, end, encoding)`` of tokens that fit an encoding and touch no base span."""
    out, i = [], 0
    for match in CANDIDATE.finditer(text):
        encoding = encoding_of(match.group())
        if encoding:
            while i < len(base) and base[i][2] <= match.start():
                i += 1
            # the first span that ends later also begins first of all that do
            if i == len(base) or base[i][0] >= match.end():
                out.append((match.start(), match.end(), encoding))
    return out


def prose_pairs(text: str, spans: Iterable[tuple[int, int]] = ()) -> np.ndarray:
    """How often each state follows each, as a flat square, in ``text`` without ``spans``."""
    parts, last = [], 0
    for start, end in sorted(spans):
        parts.append(text[last:max(last, start)])
        last = max(last, end)
    text = " ".join([*parts, text[last:]])
    states = PLACES[np.frombuffer(f" {text} ".encode("latin-1", "replace"), np.uint8)]
    return np.bincount(states[:-1] * (OUTSIDE + 1) + states[1:], minlength=(OUTSIDE + 1) ** 2)


def prose_logs(counts: np.ndarray) -> list[list[float]]:
    """log P(character | the one before) inside tokens, from ``counts`` on top of the fixed sample."""
    folder = resources.files("tidemark.llm").joinpath("license_texts")
    sample = " ".join(file.read_text(encoding="utf-8") for file in sorted(folder.iterdir(), key=lambda file: file.name))
    pairs = (counts + prose_pairs(sample)).reshape(OUTSIDE + 1, OUTSIDE + 1)[:, :OUTSIDE] + 0.0
    at = np.arange(OUTSIDE + 1)
    folded = np.where(at < 26, at + 26, at)  # upper case comes first in SYMBOLS
    either = np.zeros_like(pairs)
    np.add.at(either, (folded[:, None], folded[None, :OUTSIDE]), pairs)
    single = pairs.sum(axis=0) + 1.0
    seen = pairs + 5.0 * single / single.sum()  # rare pairs follow the single characters
    either += 5.0 * either.sum(axis=0) / either.sum()
    # a name runs on in one case as words do, or begins a new word in either case, a number or a sign
    kind = np.where(at < 26, 0, np.where(at < 52, 1, 2))
    same = (kind[:, None] == kind[None, :OUTSIDE]) | (kind[:, None] == 2) | (kind[None, :OUTSIDE] == 2)
    run = (either / either.sum(axis=1, keepdims=True))[folded][:, folded[:OUTSIDE]] * same
    first = either[OUTSIDE] / either[OUTSIDE, 26:52].sum()
    begin = np.concatenate([0.425 * first[26:52], 0.425 * first[26:52], np.full(10, 0.01), np.full(4, 0.0125)])
    return np.log(0.5 * seen / seen.sum(axis=1, keepdims=True) + 0.4 * run + 0.1 * begin).tolist()


def strength(token: str, encoding: str, logs: list[list[float]]) -> float:
    """-log p of ``token`` as prose, or 0 for one that is not even in its alphabet."""
    values, size = read_as(token, encoding), len(ALPHABETS[encoding])
    last, prose = OUTSIDE, 0.0
    for symbol in ungrouped(token) if encoding in ONE_CASE else token.rstrip("="):
        prose += logs[last][last := PLACE[symbol]]
    found = -len(values) * math.log(size) - prose - math.log(WRITTEN)
    return found if found > 0 and battery(values, size) >= EVEN else 0.0


def _bin(strength: float) -> int:
    return min(BINS - 1, int(strength / STEP))


def _all_counts(docs: DataFrame, text: str) -> np.ndarray:
    def factory():
        def work(texts):
            total = np.zeros((OUTSIDE + 1) ** 2, np.int64)
            for value in texts:
                if value:
                    base = base_spans(value)
                    spans = [(start, end) for start, _, end in base] + [(start, end) for start, end, _ in candidates(value, base)]
                    total += prose_pairs(value, spans)
            at = np.nonzero(total)[0]
            return [at, total[at]]

        return work

    rows = arrow_map(docs.select(text), "pair int, n long", factory).groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((OUTSIDE + 1) ** 2, np.int64)
    for row in rows:
        counts[row["pair"]] = row["n"]
    return counts


def strength_histogram(docs: DataFrame, logs: list[list[float]], text: str = "text") -> DataFrame:
    """``(bin, n)`` over every long token of the table; those that fit no encoding are in bin 0."""

    def factory():
        def work(texts):
            counts = [0] * BINS
            for value in texts:
                value = value or ""
                base = base_spans(value)
                found = candidates(value, base)
                counts[0] += max(0, sum(1 for _ in CANDIDATE.finditer(value)) - len(found))
                for start, end, encoding in found:
                    counts[_bin(strength(value[start:end], encoding, logs))] += 1
            held = [(number, n) for number, n in enumerate(counts) if n]
            return list(zip(*held, strict=True)) if held else [[], []]

        return work

    return arrow_map(docs.select(text), "bin int, n long", factory).groupBy("bin").agg(F.sum("n").alias("n"))


def least_bin(counts: dict[int, int], fdr: float = FDR) -> int:
    """The lowest bin that Benjamini-Hochberg accepts, ``BINS`` for none."""
    total, passed, limit = sum(counts.values()), 0, BINS
    for number in range(BINS - 1, 0, -1):
        passed += counts.get(number, 0)
        if passed and math.exp(-number * STEP) * total <= fdr * passed:
            limit = number
    return limit


def learn(docs: DataFrame, text: str = "text", fdr: float = FDR) -> tuple[list[list[float]], int]:
    """The prose model of the table and the lowest bin of strengths that is accepted."""
    logs = prose_logs(_all_counts(docs, text))
    counts = {row["bin"]: row["n"] for row in strength_histogram(docs, logs, text).collect()}
    return logs, least_bin(counts, fdr)


def find_spans(text: str | None, rule: tuple[list[list[float]], int]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of base spans and of accepted candidates, in order."""
    text = text or ""
    base = base_spans(text)
    added = []
    logs, limit = rule
    for start, end, encoding in candidates(text, base):
        if _bin(strength(text[start:end], encoding, logs)) >= limit:
            added.append((start, 3, end))
    return sorted(base + added)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """``(doc_id, spans)``: the secrets of every text, by start and then kind.

    Offsets count code points, the end is exclusive. Null text has no spans; repeated rows
    are scanned one by one; an empty table gives no row. A random token is found however few others there are.
    """
    rule = learn(docs, text, fdr)
    id_type = docs.schema[doc_id].dataType.simpleString()

    def factory():
        def work(ids, texts):
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find_spans(v, rule)] for v in texts]
            return ids, spans

        return work

    return arrow_map(docs.select(doc_id, text), f"doc_id {id_type}, spans {SPANS}", factory)


def redact(text: str | None, rule: tuple[list[list[float]], int], mark: str) -> str | None:
    """``text`` with every secret replaced by ``mark``; overlapping spans become one."""
    out, last = [], 0
    for start, _, end in find_spans(text, rule):
        if start >= last:
            out += [text[last:start], mark]
        last = max(last, end)
    return text if not out else "".join([*out, text[last:]])


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]", fdr: float = FDR) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced; null stays null, other columns stay as they are."""
    rule = learn(docs, text, fdr)

    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda value: redact(value, rule, mark))

    return docs.withColumn(text, F.pandas_udf(clean, "string")(F.col(text)))
