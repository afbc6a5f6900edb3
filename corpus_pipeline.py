"""The training-data pipeline: documents -> packed sequences.

Each stage works on all that its predecessor kept, is written as Parquet into the
shared folder and read again as the next one's input, so a lost executor never
costs more than the current stage.  A clean document stays until it is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import decontam, exact, jaccard, packing
from vitrine.llm import toxicity as toxic
from vitrine.session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that are predicted toxic go."""
    return toxic.keep_clean(docs, _table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of documents with equal text that of the largest doc_id stays."""
    return exact.keep_exact(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of near copies (five-word shingles, 0.75) that of the smallest doc_id stays."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a benchmark item go."""
    return decontam.keep_uncontaminated(docs, _table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: every document that is left, packed."""
    return packing.best_fit_packing(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("ngram_jaccard", ngram_jaccard),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

#: A trained tagger, BM25 retrieval and best-fit search are no SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
