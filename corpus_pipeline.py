"""Corpus pipeline over ``documents``: language ID, exact and near
deduplication, mixing, packing.

Each stage calls one operator of ``recolake.llm`` on everything its
predecessor kept, is written as Parquet under the shared checkpoint folder and
reread.  All but the last return the columns they were given, with their types
and values, whatever other columns are called.  Every stage takes null ids,
repeated rows and empty tables (which give empty results).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recolake.llm import language_id
from recolake.llm.common import crc_of_id
from recolake.llm.exact_dedup import without_copies
from recolake.llm.mixing import mixed
from recolake.llm.packing import pack
from recolake.llm.simhash import representatives
from recolake.plans.registry import Query
from recolake.session import materialize, ship_package

MAX_PASSES = 2.0  # no source is read more often
SEQUENCE, END_ID = 4096, 1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: those without a letter go (null
    and empty texts too), and those under the calibrated threshold.  Without a
    labelled text to learn from none is recognised.  Repeated rows are judged
    alike."""
    ship_package(spark)
    model = language_id.fit(docs, crc_of_id() % 4 != 2)
    return language_id.recognised(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the longest one stays, then the
    smallest id (null ids last); one row of each group.  Null and empty texts
    are one group."""
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked over 3 or fewer fingerprint bits, one row stays: that
    of the smallest id, null ids last.  Null and empty texts have fingerprint
    zero."""
    ship_package(spark)
    return representatives(docs, shingle=3, bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at the flattest temperature that repeats none more than
    MAX_PASSES times; every document is read at least once.  A null source is
    the empty name; null and empty texts are read with their source's passes,
    and count no token; rows that repeat an id are read each."""
    return mixed(docs, max_passes=MAX_PASSES)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of SEQUENCE tokens.  A null text is
    the end token alone; rows that repeat an id are packed each."""
    ship_package(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=SEQUENCE, end_id=END_ID)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # models and fingerprints: tests/llm compares the stages with brute force
QUERIES = {"pipeline": Query("pipeline", run, ORACLE_SQL)}
