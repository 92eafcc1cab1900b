"""The queries of this subpackage and the SQL that some of them can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, fingerprint, jaccard_join, kneser_ney, langid, lexical, licenses, merkle, mixing, sentencepieces, substring_dedup, suffix_dedup, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": sentencepieces.op1_sentencepiece,
        "op2_mix_sources": mixing.op2_mix_sources,
        "op3_language_id": langid.op3_language_id,
        "op4_substring_dedup": substring_dedup.op4_substring_dedup,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_document_fingerprints": fingerprint.op6_document_fingerprints,
        "op10_ngram_jaccard": jaccard_join.op10_ngram_jaccard,
        "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
        "op9_license_scan": licenses.op9_license_scan,
        "op8_exact_dedup": exact_dedup.op8_exact_dedup,
        "op11_merkle_manifest": merkle.op11_merkle_manifest,
        "op12_lm_scoring": kneser_ney.op12_lm_scoring,
        "op13_lexical_search": lexical.op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_dedup": exact_dedup.OP8_SQL, "op11_merkle_manifest": merkle.OP11_SQL, "op13_lexical_search": lexical.OP13_SQL}
