"""Toxicity by logistic regression over hashed word n-grams and skip-grams (FTRL-proximal).

Every coordinate has its own learning rate, and the L1 term keeps coordinates at zero until
their gradients add up, so few of the hashed weights are set. They are sent to the tasks as
two short arrays. Training reads at most ``TRAIN_ROWS`` labelled rows, the ones whose ids
hash lowest, and runs in one task; features are made in parallel, and scoring covers every
document.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROWS, arrow_map

BITS = 20
TRAIN_ROWS = 12_000
EPOCHS = 4
ALPHA = 0.5
BETA = 1.0
L1 = 5.0
L2 = 1.0
GAPS = (1, 2, 3)
STEM = 4
STEM_KEY = "stem-hash-key-16"
STRIP = b".,;:!?\"'()[]{}<>#*$%&|-_/\\"

ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def occurrences(texts: list[str | None], bits: int = BITS) -> list[np.ndarray]:
    """Hashed features of each text, as often as they occur: words, their stems, neighbours and pairs up to two words apart.

    Words are lower-cased and lose punctuation at their ends; a stem is the first letters. Null and empty texts have none.
    """
    split = [(value or "").lower().encode().split() for value in texts]
    ends = np.cumsum([len(words) for words in split])
    words = np.array([word for part in split for word in part], dtype=object)
    if not len(words):
        return [np.zeros(0, np.int32) for _ in texts]
    codes, names = pd.factorize(words)
    stripped = np.array([name.strip(STRIP).decode("utf-8", "replace") for name in names], dtype=object)
    hashes = pd.util.hash_array(stripped, categorize=False)[codes]
    stems = pd.util.hash_array(np.array([name[:STEM] for name in stripped], dtype=object), hash_key=STEM_KEY, categorize=False)[codes]
    shift = np.uint64(64 - bits)
    out = []
    for end, part in zip(ends, split, strict=True):
        own = hashes[end - len(part) : end]
        found = [_mix(own), _mix(stems[end - len(part) : end])]
        found += [_mix(own[:-gap] * ODD + own[gap:] * np.uint64(2 * gap + 1)) for gap in GAPS if len(own) > gap]
        out.append((np.concatenate(found) >> shift).astype(np.int32))
    return out


def features(texts: list[str | None], bits: int = BITS) -> list[np.ndarray]:
    """The distinct features of each text, ascending."""
    return [np.unique(found) for found in occurrences(texts, bits)]


def ftrl(rows: list[np.ndarray], labels: list[int], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Indexes and values of the weights that are not zero, and the bias.

    Rows are visited in the given order, ``epochs`` times.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias = bias_n = 0.0

    def weights(at):
        part = z[at]
        return np.where(np.abs(part) <= L1, 0.0, (np.sign(part) * L1 - part) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for at, label in zip(rows, labels, strict=True):
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
            bias_n += g * g
            bias -= ALPHA / (BETA + np.sqrt(bias_n)) * g
    at = np.nonzero(np.abs(z) > L1)[0]
    return at.astype(np.int32), weights(at), float(bias)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """The model fitted on at most ``rows`` of the labelled rows, those whose ids hash lowest.

    Rows without id, label or text are left out; without any row every weight is zero. Of several
    rows with one id the text that sorts first is taken, so the sample has at most ``rows`` rows
    and no id counts more than once.
    """
    known = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("__label"))
    chosen = known.withColumn("__order", F.xxhash64("__id")).orderBy("__order", "__id").limit(rows)
    texts = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    # the sample never has more than ``rows`` ids, so it may be sent to every task
    picked = texts.join(F.broadcast(chosen), "__id")
    picked = picked.groupBy("__order", "__id", "__label").agg(F.min("__text").alias("__text")).select("__order", "__label", "__text")

    def factory():
        return lambda order, marks, values: (order, marks, [found.tobytes() for found in features(values)])

    made = arrow_map(picked, "place long, label int, found binary", factory, rows=128)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["place", "label"])
        at, values, bias = ftrl([np.frombuffer(x, np.int32) for x in part["found"]], part["label"].tolist())
        return pd.DataFrame({"at": [at.tobytes()], "weights": [values.tobytes()], "bias": [bias]})

    model = made.withColumn("model", F.lit(0)).groupBy("model").applyInPandas(fit, "at binary, weights binary, bias double").collect()
    if not model:
        return np.zeros(0, np.int32), np.zeros(0), 0.0
    return np.frombuffer(model[0]["at"], np.int32), np.frombuffer(model[0]["weights"]), model[0]["bias"]


def scores(texts: list[str | None], dense: np.ndarray, bias: float, bits: int = BITS) -> list[float]:
    """The probability of label 1; only features with a weight need to be made distinct."""
    total = []
    for found in occurrences(texts, bits):
        weighted = np.unique(found[dense[found] != 0])
        total.append(dense[weighted].sum() + bias)
    return (1 / (1 + np.exp(-np.clip(total, -35, 35)))).tolist()


def score_documents(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the column ``score``; null and empty texts get the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, values, bias = shared.value
        dense = np.zeros(1 << BITS)
        dense[at] = values
        for batch in batches:
            parts = [scores(batch.iloc[i : i + ROWS].tolist(), dense, bias) for i in range(0, len(batch), ROWS)]
            yield pd.Series([x for part in parts for x in part], dtype=float)

    return docs.withColumn(score, F.pandas_udf(run, "double")(F.col(text)))


def learnable(labels: DataFrame, doc_id: str = "doc_id", folds: int = 5) -> DataFrame:
    """The label rows that are not held out for measuring."""
    return labels.filter(~held_out(F.col(doc_id), folds))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of the id as text is a multiple of ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == 0
