"""The registered queries of the thirteen operators and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracles import ORACLE as ORACLE


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontaminate(spark, sf_dir):
    from .decontaminate import decontaminate

    found = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_quality_rules(spark, sf_dir):
    from .quality_rules import quality_rules

    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )


def op3_lm_scoring(spark, sf_dir):
    from .lm_scoring import hpy_scores, last_word

    return hpy_scores(documents(spark, sf_dir), last_word)


def op4_bpe(spark, sf_dir):
    import public_tokenizers

    from .bpe import bpe_encode

    return bpe_encode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_minhash_dedup(spark, sf_dir):
    from .minhash import near_duplicates

    return near_duplicates(documents(spark, sf_dir), size=2)


def op6_substring_dedup(spark, sf_dir):
    from .unit_dedup import repeated_runs

    return repeated_runs(documents(spark, sf_dir))


def op7_quality_classifier(spark, sf_dir):
    from .kn_quality import classify

    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), whole=True)


def op8_warc(spark, sf_dir):
    from .warc import derivatives, response_records

    return derivatives(response_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op9_sharding(spark, sf_dir):
    from .sharding import kd_shards

    return kd_shards(documents(spark, sf_dir), 24, ["lang", "source", "size", "doc_id"])


def op10_secret_scans(spark, sf_dir):
    from .secret_scan import secret_scan

    return secret_scan(documents(spark, sf_dir))


def op11_pii(spark, sf_dir):
    from .pii import find_pii

    return find_pii(documents(spark, sf_dir))


def op12_spelling_variants(spark, sf_dir):
    from .spelling import spelling_variants

    return spelling_variants(documents(spark, sf_dir))


def op13_filter_audit(spark, sf_dir):
    from .filter_audit import filter_audit

    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality_rules": op2_quality_rules,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_bpe": op4_bpe,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_warc": op8_warc,
    "op9_sharding": op9_sharding,
    "op10_secret_scans": op10_secret_scans,
    "op11_pii": op11_pii,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_filter_audit": op13_filter_audit,
}
