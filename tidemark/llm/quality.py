"""Quality rules as a short-circuit cascade.

A document is kept when no rule rejects it, so the order of the rules never changes the
verdict, only the work. The order is estimated: on a bounded sample of rows every rule is
run alone and timed, and rules are then sorted by share of rejected rows per second. On the
whole table each document stops at the first rule that rejects it.
"""

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map

SAMPLE_ROWS = 2000
SYMBOLS = "#*$%&|<>"
PROFILE = pa.schema([("rule", pa.int32()), ("seconds", pa.float64()), ("rejected", pa.int64()), ("rows", pa.int64())])
WHITE = " \t\n\r\x0b\x0c"


class Features:
    """Measures of one text, each computed when a rule first asks for it.

    Words are the runs between ASCII white space; null text has none.
    """

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, WHITE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(WHITE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))  # noqa: B905
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        covered, upto = 0, 0
        for at, window in enumerate(windows):
            if counts[window] > 1:
                covered += at + 3 - max(at, upto)
                upto = at + 3
        return covered


@dataclass(frozen=True)
class Rule:
    """``rejects(features)`` is true for a text that the rule throws out."""

    name: str
    rejects: Callable[[Features], bool]


#: Limits are whole-number comparisons, so that SQL gives the same verdict.
TOO_SHORT = Rule("too_short", lambda f: f.n_words < 50)
REPEATED_WORDS = Rule("repeated_words", lambda f: 100 * f.n_repeat_words > 50 * f.n_words)
SYMBOL_HEAVY = Rule("symbol_heavy", lambda f: 10 * f.n_symbols > f.n_words)
REPEATED_LINES = Rule("repeated_lines", lambda f: 100 * f.n_dup_lines > 50 * len(f.lines))
SHORT_WORDS = Rule("short_words", lambda f: f.word_chars < 2 * f.n_words)
LONG_WORDS = Rule("long_words", lambda f: f.word_chars > 20 * f.n_words)

BASE = (TOO_SHORT, REPEATED_WORDS)
RULES = (*BASE, SYMBOL_HEAVY, REPEATED_LINES, SHORT_WORDS, LONG_WORDS)


def rule_profile(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(rule, seconds, rejected, rows)`` of each rule alone on about ``sample_rows`` rows.

    Every partition gives its share of the sample and reads no further.
    """
    share = -(-sample_rows // max(1, docs.rdd.getNumPartitions()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, texts = share, []
        for batch in batches:
            texts += batch.column(0).slice(0, wanted - len(texts)).to_pylist()
            if len(texts) >= wanted:
                break
        rows = []
        for number, rule in enumerate(rules):
            start = time.thread_time()
            rejected = sum(rule.rejects(Features(value)) for value in texts)
            rows.append({"rule": number, "seconds": time.thread_time() - start, "rejected": rejected, "rows": len(texts)})
        yield pa.RecordBatch.from_pylist(rows, schema=PROFILE)

    parts = docs.select(text).mapInArrow(measure, "rule int, seconds double, rejected long, rows long")
    return parts.groupBy("rule").agg(*(F.sum(name).alias(name) for name in ("seconds", "rejected", "rows")))


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejected rows per second on the sample, best first; ties keep their order."""
    found = {row["rule"]: row for row in rule_profile(docs, rules, text, sample_rows).collect()}
    gain = {n: row["rejected"] / max(row["seconds"], 1e-9) for n, row in found.items()}
    return [rules[n] for n in sorted(range(len(rules)), key=lambda n: -gain.get(n, 0.0))]


def quality_verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = SAMPLE_ROWS,
    measures: bool = True,
) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)``.

    With ``measures`` off only ``doc_id`` and ``kept`` are returned and nothing is computed
    past the first rule that rejects a text. Null and empty texts have no words and fail. An
    empty table gives no rows; repeated rows are judged one by one.
    """
    order = cascade_order(docs, rules, text, sample_rows)
    id_type = docs.schema[doc_id].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def factory():
        def verdict(features):
            return not any(rule.rejects(features) for rule in order)

        def work(ids, texts):
            every = [Features(value) for value in texts]
            kept = [verdict(features) for features in every]
            if not measures:
                return ids, kept
            base = [any(rule.rejects(features) for rule in BASE) for features in every]
            columns = [[getattr(features, name) for features in every] for name in names]
            return ids, *columns, base, kept

        return work

    measured = ", ".join(f"{name} long" for name in names) + ", base_failed boolean, " if measures else ""
    return arrow_map(docs.select(doc_id, text), f"doc_id {id_type}, {measured}kept boolean", factory, rows=128)


def keep_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns unchanged."""
    order = cascade_order(docs, rules, text, sample_rows)

    def passes(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(lambda value: not any(rule.rejects(Features(value)) for rule in order)).astype(bool)

    return docs.filter(F.pandas_udf(passes, "boolean")(F.col(text)))
