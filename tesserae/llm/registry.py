"""The queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from tesserae.llm import decontamination, html_extract, idfiles, packing, quality, sharding, simhash, substring_dedup, suffix_dedup, toxicity


def queries():
    return {
        "op1_packing": packing.query,
        "op2_decontamination": decontamination.query,
        "op3_sharding": sharding.query,
        "op4_quality": quality.query,
        "op5_simhash": simhash.query,
        "op6_suffix_array": suffix_dedup.query,
        "op7_html_extraction": html_extract.query,
        "op8_toxicity": toxicity.query,
        "op9_token_files": idfiles.query,
        "op10_substring_dedup": substring_dedup.query,
    }


def oracle_sql():
    return {
        "op2_decontamination": decontamination.ORACLE,
        "op4_quality": quality.ORACLE,
        "op6_suffix_array": suffix_dedup.ORACLE,
        "op10_substring_dedup": substring_dedup.ORACLE,
    }
