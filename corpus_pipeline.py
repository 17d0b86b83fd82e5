"""A corpus pipeline of five stages: good documents, one of each group of near copies, none with benchmark passages, no
personal data, packed into windows. Each stage works on what the one before kept.

In every stage: a null or empty text is a document without words, that is scored like any other, is nobody's copy, holds no
passage and no personal data, and packs to its end id alone. A text of any length is read whole. Ties and repeated rows are
settled as the operators say: equal rows get equal scores, one of equal rows with words stays, and each row is packed. An empty
table gives an empty result. Filtering stages return all columns of their input, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.decontamination import keep_clean
from lexalign.llm.ngram_jaccard import deduplicate
from lexalign.llm.packing import pack_documents
from lexalign.llm.pii import mask_pii
from lexalign.llm.quality import keep_good
from lexalign.llm.storage import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more on shingles of five words."""
    return deduplicate(spark, docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item."""
    return keep_clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and their new lengths."""
    masked = mask_pii(spark, docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens, with their ids."""
    return pack_documents(spark, docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]
#: The classifier, the tokenizer and the random field have no SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if i == len(STAGES) - 1 else scratch.cut(out)
    return docs
