"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from llm import (
    bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    license_scan,
    minhash_dedup,
    ngram_join,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
    vector_codes,
)

_MODULES = {
    "op1_decontaminate": decontaminate,
    "op2_substring_dedup": substring_dedup,
    "op3_exact_dedup": exact_dedup,
    "op4_chat_format": chat_format,
    "op5_minhash_dedup": minhash_dedup,
    "op6_bpe": bpe,
    "op7_suffix_dedup": suffix_dedup,
    "op8_license_scan": license_scan,
    "op9_toxicity": toxicity,
    "op10_token_counts": token_counts,
    "op11_ngram_join": ngram_join,
    "op12_spelling": spelling,
    "op13_vector_codes": vector_codes,
}


def queries():
    """name -> (spark, sf_dir) -> DataFrame, each over its whole tables."""
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    """The same results as DuckDB SQL."""
    return {
        name: module.ORACLE_SQL
        for name, module in _MODULES.items()
        if getattr(module, "ORACLE_SQL", None)
    }
