"""A corpus in five stages: toxicity, quality, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. ``run`` writes what a stage returns as Parquet in the shared folder, and
the next stage reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import packing, pfair, quality, simhash, toxicity
from millrace.llm.common import free_name, read, written
from millrace.llm.queries import TOKENIZER
from millrace.plans.registry import query


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; learns from the labels of ``docs``."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    score = free_name(docs, "toxicity")
    return (
        toxicity.scored(docs, model, score)
        .where(F.col(score) < toxicity.THRESHOLD)
        .select(*docs.columns)
    )


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the quality rules."""
    return quality.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group."""
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the Pfair schedule of their sources."""
    return pfair.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 1024 ids."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("simhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained network, a chain of links and a tokenizer decide, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
