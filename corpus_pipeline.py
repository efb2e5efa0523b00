"""The corpus pipeline: documents -> quality rules -> near duplicates ->
benchmark decontamination -> personal data -> BPE.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  Each result is written as Parquet and reread as the next
stage's documents.  All but the last stage return the columns of documents;
the last adds the encoding.  ``sf_dir`` serves the stages that read a table
beside the documents (the benchmark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.llm import bpe, decontaminate, jaccard_join, pii, quality_rules
from tsforge.llm.common import table, written
from tsforge.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or similar texts stays."""
    ship_package(spark)
    return jaccard_join.distinct(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; n_chars follows the text."""
    ship_package(spark)
    out = pii.find(docs, pii.fit(docs), redact=True).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds n_tokens and the digests of ids and decoded text."""
    import public_tokenizers

    ship_package(spark)
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), ids=False)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("personal data", personal_data),
    ("BPE encoding and decoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


#: MinHash joins, EM and BPE are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None
