"""A corpus pipeline over the documents table: five stages, each an operator at work.

Every stage takes all that the one before it kept, with the columns of ``documents``; the last
one adds ids and the text decoded from them. Rows are written and read again between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import read, stored
from starloom.llm.decontaminate import drop_leaks
from starloom.llm.exact_dedup import keep_one_copy
from starloom.llm.pieces import encode_pieces
from starloom.llm.quality import drop_low_quality
from starloom.llm.queries import tokenizer_file
from starloom.llm.simhash import keep_one_of_component


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return drop_low_quality(docs, read(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id stays."""
    return keep_one_copy(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near fingerprints, the document with the smallest id stays.

    The settings are those of ``op10``: shingles of three words, at most two differing bits.
    """
    return keep_one_of_component(docs, words=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    items = read(spark, sf_dir, "benchmark")
    return drop_leaks(docs, items)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``ids``, and ``decoded``, what these stand for."""
    model = tokenizer_file("piece_bpe_32k.model")
    return encode_pieces(docs, model, decoded_column="decoded")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: A fitted classifier and transitive closure have no plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
