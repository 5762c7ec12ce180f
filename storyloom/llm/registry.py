"""The queries of this subpackage, by name, with the SQL that gives the same rows where there is any."""

from __future__ import annotations

from . import byte_bpe, exact_dedup, katz, langid, minhash, mixing, page_text, pivot_topk, quotes, spellings, sstable, token_alignment, toxicity

_MODULES = {
    "op1_quote_linking": quotes,
    "op2_source_mixing": mixing,
    "op3_toxicity": toxicity,
    "op4_exact_dedup": exact_dedup,
    "op5_sstable": sstable,
    "op6_byte_bpe": byte_bpe,
    "op7_language_id": langid,
    "op8_pivot_topk": pivot_topk,
    "op9_minhash": minhash,
    "op10_katz": katz,
    "op11_page_text": page_text,
    "op12_spellings": spellings,
    "op13_token_alignment": token_alignment,
}


def queries() -> dict:
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql() -> dict:
    return {name: module.ORACLE for name, module in _MODULES.items() if getattr(module, "ORACLE", None)}
