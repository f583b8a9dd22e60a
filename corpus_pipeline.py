"""The corpus pipeline: each stage works on all rows that its predecessor kept, as written Parquet.

quality classifier -> language identification -> SimHash near-dedup checked on word shingles -> pseudonyms -> packing
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilesieve.llm import langid, packing, pii, quality, shingles
from tilesieve.llm.common import is_held_out, table
from tilesieve.llm.queries import PSEUDONYM_KEY, WORDS
from tilesieve.session import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.fit(docs.filter(~is_held_out()), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not accepted go."""
    return langid.keep_known(docs, langid.fit(docs.filter(~is_held_out())))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash, then five-word shingles of similarity 0.8) stays."""
    return shingles.keep_first(docs)


def pseudonym_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and credentials are replaced by pseudonyms of their format."""
    return pii.pseudonymise(docs, PSEUDONYM_KEY)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids in full sequences, one row per piece."""
    return packing.pack(docs, WORDS)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("pseudonyms", pseudonym_stage),
    ("packing", packing_stage),
]

# Classifiers, fingerprints' components, keyed hashes and BPE are beyond SQL; tests check them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
