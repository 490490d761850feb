"""The subpackage's queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import alignment, ann, html_main, language_id, licenses, manifest, mixing, near_dedup, quality, secrets, substring_dedup, tokens, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.op1_language_id,
    "op2_revisits": warc.op2_revisits,
    "op3_sentencepiece": tokens.op3_sentencepiece,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_source_mix": mixing.op6_source_mix,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_html_main": html_main.op8_html_main,
    "op9_ann": ann.op9_ann,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_merkle_manifest": manifest.op11_merkle_manifest,
    "op12_license_scan": licenses.op12_license_scan,
    "op13_token_alignment": alignment.op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op2_revisits": warc.ORACLE,
    "op4_quality_rules": quality.ORACLE,
    "op7_near_dedup": near_dedup.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_merkle_manifest": manifest.ORACLE,
}
