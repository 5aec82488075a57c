"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.adaptive_scan import nearest_neighbours
from siltstone.llm.alignment import alignment
from siltstone.llm.chat_windows import CHAT_SQL, chat_digests
from siltstone.llm.collocations import COLLOCATIONS_SQL, collocations
from siltstone.llm.fertility import fertility_rules
from siltstone.llm.html_text import extracted
from siltstone.llm.mixture import MIXTURE_SQL, mixture
from siltstone.llm.ngram_join import JOIN_SQL, ngram_components
from siltstone.llm.packing import pack
from siltstone.llm.personal_data import personal_data
from siltstone.llm.quality_votes import quality_votes
from siltstone.llm.scratch import ship
from siltstone.llm.toxicity import toxicity
from siltstone.llm.wavelet import token_index

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the public tokenizers' package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function name; it sends this subpackage to the workers first."""

    def add(query: Query) -> Query:
        @functools.wraps(query)
        def run(spark: SparkSession, directory: str) -> DataFrame:
            ship(spark)
            return query(spark, directory)

        QUERIES[query.__name__] = run
        if sql is not None:
            ORACLES[query.__name__] = sql
        return run

    return add


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@register(JOIN_SQL)
def op1_ngram_join(spark: SparkSession, directory: str) -> DataFrame:
    return ngram_components(table(spark, directory, "documents"))


@register()
def op4_packing(spark: SparkSession, directory: str) -> DataFrame:
    return pack(table(spark, directory, "documents"), tokenizer_path("byte_bpe_50k.json"))


@register()
def op5_wavelet(spark: SparkSession, directory: str) -> DataFrame:
    return token_index(table(spark, directory, "documents"), tokenizer_path("byte_bpe_50k.json"))


@register(CHAT_SQL)
def op7_chat_windows(spark: SparkSession, directory: str) -> DataFrame:
    turns = table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat_digests(turns.unionByName(probe))


@register(MIXTURE_SQL)
def op8_mixture(spark: SparkSession, directory: str) -> DataFrame:
    return mixture(table(spark, directory, "documents"), ["doc_id"])


@register()
def op2_fertility(spark: SparkSession, directory: str) -> DataFrame:
    return fertility_rules(
        table(spark, directory, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    )


@register()
def op3_quality_votes(spark: SparkSession, directory: str) -> DataFrame:
    return quality_votes(table(spark, directory, "documents"), table(spark, directory, "labels"))


@register()
def op6_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity(table(spark, directory, "documents"), table(spark, directory, "labels"))


@register()
def op9_html_text(spark: SparkSession, directory: str) -> DataFrame:
    return extracted(table(spark, directory, "pages"))


@register()
def op10_adaptive_scan(spark: SparkSession, directory: str) -> DataFrame:
    return nearest_neighbours(table(spark, directory, "embeddings"))


@register()
def op11_personal_data(spark: SparkSession, directory: str) -> DataFrame:
    return personal_data(table(spark, directory, "documents"))


@register()
def op12_alignment(spark: SparkSession, directory: str) -> DataFrame:
    return alignment(
        table(spark, directory, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    )


@register(COLLOCATIONS_SQL)
def op13_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return collocations(table(spark, directory, "documents"))
