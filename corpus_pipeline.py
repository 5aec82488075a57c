"""The corpus pipeline: toxicity, quality rules, near duplicates, mixing, packing.

Each stage takes all that the one before it kept, and its decisions take effect. All but
the last return the columns of ``documents``; the last returns the packed pieces. An empty
table gives an empty one at every stage, and columns of any name keep their values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import fertility, mixture, ngram_join, packing, toxicity
from siltstone.llm.queries import table, tokenizer_path
from siltstone.llm.scratch import Scratch, ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, trained on the labelled ones among them, rejects go.

    A null or empty text scores as clean and stays; repeated rows are judged alike; nulls in other
    columns do not matter; without labels of both classes all rows stay.
    """
    ship(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_unfit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base counts or their language's fertility bands reject go.

    A null, empty or short text has too few words and goes; a null lang is a language of
    its own; repeated rows are judged alike.
    """
    ship(spark)
    return fertility.kept_documents(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id.

    A null doc_id comes last; rows of one doc_id are told apart by all their columns, and of
    equal rows one stays. Rows whose text has no words are like no other: all stay.
    """
    ship(spark)
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one where a source's budget ends is cut there.

    A null source is a source of its own, the last; rows without words are in no mix;
    repeated rows are taken each for itself.
    """
    return mixture.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens.

    A null or empty text is its end token alone; repeated rows and null ids are packed each.
    """
    ship(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_unfit),
    ("ngram_join", drop_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classifier, tokenisers and differencing are beyond SQL: tests/llm/test_stages.py has each stage in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
