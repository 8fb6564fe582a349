"""A corpus pipeline of five operators over `documents`; each stage works on all that the one before kept.

Every stage but the last gives back the columns of its input, whatever further ones there are and whatever their
names. A document is known by id and text: null ids are one id, a null text is an empty one, repeated rows are
decided together. Texts of any length are read whole. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from floortally.llm import decontamination, mixing, near_dedup, sharding, toxicity
from floortally.llm.queries import MIX_EPOCHS, MIX_PART, MIX_SEED, MIX_WEIGHTS, mix_levels
from floortally.llm.storage import stored
from floortally.llm.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; empty texts are scored like any other."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near class stays: that of least id, a null id last, then of least text key. All empty texts are one class."""
    return near_dedup.without_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more, in any order, go; empty texts leak nothing."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf of the source tree fills its budget from seeded epochs; a document taken twice is two rows."""
    return mixing.mixture(docs, mix_levels(), MIX_WEIGHTS, MIX_PART, MIX_EPOCHS, MIX_SEED)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row, repeated rows and empty texts included."""
    return sharding.assign_shards(docs, 16)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

#: The network of the first stage has no SQL form; tests/llm/test_pipeline.py holds every stage against a plain form of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of what every stage keeps; each stage's documents are written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
