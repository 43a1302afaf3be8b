"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

#: module: names of its queries
_MODULES = {
    "op1_lm": ["op1_lm_scoring"],
    "op2_ngram_join": ["op2_ngram_jaccard"],
    "op3_bpe": ["op3_byte_bpe"],
    "op4_decontam": ["op4_decontamination"],
    "op5_sharding": ["op5_hash_tree"],
    "op6_quality": ["op6_ordinal_quality"],
    "op7_token_counts": ["op7_token_counts"],
    "op8_rules": ["op8_rule_ledger"],
    "op9_html": ["op9_host_paths"],
    "op10_secrets": ["op10_secret_crf"],
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f".{module}", __package__), name) for module, names in _MODULES.items() for name in names}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in _MODULES:
        out |= getattr(importlib.import_module(f".{module}", __package__), "ORACLE_SQL", {})
    return out
