"""Operators for building language-model corpora. Nothing else in the library imports this subpackage."""

from . import chat_format, decontaminate, imatch, language_id, line_dedup, merkle, mixing, near_dedup, page_text, pii, token_scan, token_store
from .common import Query

QUERIES: dict[str, Query] = {
    "op1_imatch": imatch.op1_imatch,
    "op2_separator_scan": token_scan.op2_separator_scan,
    "op3_reply_trees": chat_format.op3_reply_trees,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_mix_to_weights": mixing.op5_mix_to_weights,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_language_id": language_id.op7_language_id,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_page_differencing": page_text.op9_page_differencing,
    "op10_weak_supervision": pii.op10_weak_supervision,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_token_store": token_store.op12_token_store,
}
ORACLES: dict[str, str] = {"op3_reply_trees": chat_format.ORACLE, "op11_merkle_manifest": merkle.ORACLE}
