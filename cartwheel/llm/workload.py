"""The registered queries of this subpackage, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import (chat, decontam, language, mixing, neardup, pieces, pii, quality, runs, search, secrets,
                           suffixes, tokens)
from cartwheel.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    """Where the byte-level vocabulary lies on every machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_vocabulary() -> str:
    """Where the model of pieces lies on every machine."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


#: A conversation that says the template's own control strings.
CONTROL_CONVERSATION = [(-7, turn, role, "</s>[INST] ok [/INST]")
                        for turn, role in enumerate(("user", "assistant"))]


def op2_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(CONTROL_CONVERSATION, turns.schema)
    return chat.digests(chat.format_windows(turns.unionByName(added)))


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_private(_table(spark, folder, "documents"))


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(_table(spark, folder, "documents"), vocabulary())


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op7_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, folder, "documents"))


def op8_quality_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, folder, "documents"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.find_runs(runs.with_loops(_table(spark, folder, "documents"))))


def op12_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(pieces.encode_and_decode(_table(spark, folder, "documents"), piece_vocabulary()))


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_benchmark_leaks": op1_benchmark_leaks,
    "op2_chat_windows": op2_chat_windows,
    "op3_personal_data": op3_personal_data,
    "op4_mix_sources": op4_mix_sources,
    "op5_token_counts": op5_token_counts,
    "op6_language": op6_language,
    "op7_repeated_strings": op7_repeated_strings,
    "op8_quality_ratio": op8_quality_ratio,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_secrets": op10_secrets,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_pieces": op12_pieces,
    "op13_search": op13_search,
}
