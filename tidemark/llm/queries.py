"""The registered queries of this subpackage, with production parameters over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    contamination,
    embedding_dup,
    html_text,
    licenses,
    lm,
    near_dup,
    packing,
    prefix_trie,
    quality,
    secrets,
    spelling,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of every document under a model of all documents."""
    return lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and repetition measures of every document, and the verdict of the rule cascade."""
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


def op4_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document as spans, with a digest of those the fixed patterns found."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    text = lambda span: F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))
    base = F.filter("spans", lambda span: span["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        count("random"),
    )


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document: number and digest of its ids, digest of the text decoded from them."""
    coded = bpe.bpe_encode(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, by bin completion."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return embedding_dup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxicity.learnable(table(spark, sf_dir, "labels")))
    held = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences and notices of every document, by digest lookup."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, rebuilt with shared openings."""
    return prefix_trie.shared_opening_trie(table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words and usual forms of the vocabulary of all documents."""
    forms = spelling.spelling_forms(table(spark, sf_dir, "documents"))
    return forms.select("word", "form", "root", "n", "n_near", "form_n")


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a passage of the benchmark, and the items found."""
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


QUERIES = {
    "op1_pseudo_likelihood": op1_pseudo_likelihood,
    "op2_quality_cascade": op2_quality_cascade,
    "op3_html_main_text": op3_html_main_text,
    "op4_secret_spans": op4_secret_spans,
    "op5_bpe_roundtrip": op5_bpe_roundtrip,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_pack_sequences": op7_pack_sequences,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_license_digests": op10_license_digests,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_decontamination": op13_decontamination,
}
