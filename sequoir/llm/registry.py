"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sequoir.llm.common import table


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.quality import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.langid import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.tokencount import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.htmltext import extract

    return extract(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.lm import score

    return score(table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.urls import RULES, filter_urls, rule_table

    return filter_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.alignment import align_corpus

    return align_corpus(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.quantise import quantise

    return quantise(table(spark, sf_dir, "embeddings"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sequoir.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_langid": op1_langid,
        "op2_tokens": op2_tokens,
        "op3_warc": op3_warc,
        "op4_bpe": op4_bpe,
        "op5_html": op5_html,
        "op6_decontaminate": op6_decontaminate,
        "op7_lm": op7_lm,
        "op8_urls": op8_urls,
        "op9_quality": op9_quality,
        "op10_simhash": op10_simhash,
        "op11_alignment": op11_alignment,
        "op12_codes": op12_codes,
        "op13_secrets": op13_secrets,
    }


def oracle_sql() -> dict[str, str]:
    from sequoir.llm.quantise import quantise_sql
    from sequoir.llm.secrets import scan_sql
    from sequoir.llm.urls import rules_sql
    from sequoir.llm.warc import round_trip_sql

    return {"op3_warc": round_trip_sql(), "op8_urls": rules_sql(), "op12_codes": quantise_sql(), "op13_secrets": scan_sql()}
