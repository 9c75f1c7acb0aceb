"""From raw documents to packed training sequences: five stages, each a written table.

quality rules -> one document of each near-duplicate class -> benchmark
passages cut out -> personal data pseudonymised -> packed sequences. Every
stage reads what its predecessor wrote; all but the last return the columns of
``documents``. ``n_chars``, where present, follows the text.

Defined cases are those of the operators called; an empty table passes through
all stages, a document whose whole text is cut stays with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.llm import common, decontaminate, nearjoin, packing, pii, quality
from histmart.llm.common import prepare, scratch, table

ORACLE_SQL = None  # hashing, tokenising and ciphers are not SQL; tests compare with brute force


def _sized(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each class stays."""
    return nearjoin.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: passages of the benchmark are cut out of the texts."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _sized(decontaminate.remove_spans(found))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: personal data becomes pseudonyms of the same format."""
    return _sized(pii.pseudonymise(docs).drop("pii"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of token sequences."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_passages), ("pii", personal_data), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    *first, (name, last) = STAGES
    with scratch(spark):  # tables go with their block: what a stage staged when it is written, the stages with the last one
        for before, stage in first:
            with scratch(spark):
                docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{before}", keep=True)
        return common.stage(last(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
