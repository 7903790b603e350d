"""A training corpus in stages; each works on all that the stage before it kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import near_dup, packing, quality, secrets, toxicity
from tidemark.sources.scratch import materialize, release


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_quality(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the labels of ``sf_dir`` teach the score."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, toxicity.learnable(labels))
    score = "score"
    while score in docs.columns:
        score += "_"
    return toxicity.score_documents(docs, model, score=score).filter(F.col(score) < 0.5).drop(score)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id.

    Rows that repeat an id are one document and stay or go together.
    """
    gone = near_dup.near_duplicates(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced and the lengths, if there, counted anew."""
    clean = secrets.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", length)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and the sequences they are packed in."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("minhash_dedup", minhash_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: The batteries, models and searches of the stages have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole ``documents`` table of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        staged = stage(spark, docs, sf_dir)
        docs = materialize(staged, name)
        release(staged)  # the table of the stage before and those that this stage wrote
    return STAGES[-1][1](spark, docs, sf_dir)
