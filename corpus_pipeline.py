"""From documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import decontaminate, jaccard, packing, quality, substrings
from pairloom.llm.queries import fit_quality, table
from pairloom.session import stage

#: A document goes if its quality score is below this.
LEAST_QUALITY = 0.7

#: No SQL can express the votes, the tokenizer or the components; the tests hold run() against brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled documents do not vote down. Null and empty texts score the overall share."""
    name = "_quality"
    while name in docs.columns:
        name += "_"
    scored = quality.score(docs, fit_quality(spark, sf_dir), name=name)
    return scored.filter(F.col(name) >= LEAST_QUALITY).drop(name)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each similarity component: five-word shingles, 0.8; the smallest id stays."""
    return jaccard.one_of_each(docs, jaccard.similarity_classes(docs, k=5, percent=80))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that a smaller id holds; where nothing goes, the text is untouched."""
    cut = substrings.remove_repeats(docs, keep_unchanged=True)
    gone = F.col("n_removed") > 0
    text = F.when(gone, F.col("kept")).otherwise(F.col("text"))
    size = F.when(gone, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumns({"text": text, "n_chars": size}).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    rows = docs.select(F.struct("*").alias("doc"))
    found = decontaminate.find_contamination(
        rows.select("doc", F.col("doc.text").alias("text")), table(spark, sf_dir, "benchmark"), id_col="doc")
    return found.filter(F.size("hits") == 0).select("doc.*")


def power_of_two_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, one to a sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier), ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup), ("benchmark_decontamination", benchmark_decontamination),
    ("power_of_two_packing", power_of_two_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
