"""A corpus in five stages: toxic documents go, one of each near-duplicate group stays, contaminated documents go, secrets are
masked, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents. An empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthclose.llm import decontam, neardup, packing, secrets, toxicity
from monthclose.llm.common import stored
from monthclose.llm.queries import tokenizer, toxic_lexicon


def drop_toxic(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents scored 0.5 or more go; the lexicon is learned from the labelled rows."""
    return toxicity.without_toxic(docs, toxic_lexicon(spark, sf, docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 or more, that with the smallest id stays."""
    return neardup.without_duplicates(docs, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """All documents stay; secrets in them become a mark, and n_chars follows."""
    return secrets.without_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicate removal", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

#: Learned scores, compression and tokenization have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf: str) -> DataFrame:
    """All stages over documents; what one kept is written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf)
