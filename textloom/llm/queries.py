"""Registered queries of the subpackage: thin bindings of each operator to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import chat, decontam, groupjoin, langid, mixing, neardup, pii, prefixtrie, quality, toxicity, warc, wavelet, wordruns
from textloom.llm.common import read


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read(spark, sf_dir, "documents"))


def op2_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(read(spark, sf_dir, "conversations"))


def op3_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.neardup_digest(read(spark, sf_dir, "documents"))


def op5_script_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_digest(read(spark, sf_dir, "documents"))


def op6_pattern_grammar_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(read(spark, sf_dir, "documents"))


def op8_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisit_digest(read(spark, sf_dir, "pages"))


def op9_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(read(spark, sf_dir, "documents"))


def tokenizer_file() -> str:
    """The contract's tokenizer; a parameter of the operator."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op10_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_digest(read(spark, sf_dir, "documents"), tokenizer_file())


def op11_burst_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie_digest(read(spark, sf_dir, "conversations"))


def op12_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groupjoin.join_digest(read(spark, sf_dir, "documents"))


def op13_dyadic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordruns.runs_digest(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_role_repair": op2_role_repair,
    "op3_latent_decontamination": op3_latent_decontamination,
    "op4_lsh_forest": op4_lsh_forest,
    "op5_script_viterbi_language": op5_script_viterbi_language,
    "op6_pattern_grammar_toxicity": op6_pattern_grammar_toxicity,
    "op7_line_quality": op7_line_quality,
    "op8_revisit_resolution": op8_revisit_resolution,
    "op9_sainte_lague_mix": op9_sainte_lague_mix,
    "op10_wavelet_tokens": op10_wavelet_tokens,
    "op11_burst_prefix_trie": op11_burst_prefix_trie,
    "op12_grouped_prefix_join": op12_grouped_prefix_join,
    "op13_dyadic_runs": op13_dyadic_runs,
}
ORACLES: dict[str, str] = {
    "op7_line_quality": quality.ORACLE,
    "op8_revisit_resolution": warc.ORACLE,
    "op9_sainte_lague_mix": mixing.ORACLE,
    "op11_burst_prefix_trie": prefixtrie.ORACLE,
    "op12_grouped_prefix_join": groupjoin.ORACLE,
}
