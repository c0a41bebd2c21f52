"""Queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from . import (chat, decontam, html_text, licenses, line_dedup, near_dup, negatives, packing, pieces, quality_crf,
               sharding, topk, whitening)


def queries():
    return {
        "op1_license_sentences": licenses.license_query,
        "op2_html_main_text": html_text.html_query,
        "op3_interleaved_shards": sharding.shard_query,
        "op4_exact_topk": topk.topk_query,
        "op5_quality_crf": quality_crf.quality_query,
        "op6_winnowed_lines": line_dedup.line_dedup_query,
        "op7_lsi_decontamination": decontam.decontam_query,
        "op8_chat_format": chat.chat_query,
        "op9_sentencepiece": pieces.encode_query,
        "op10_minhash_odd_sketch": near_dup.near_dup_query,
        "op11_bounded_packing": packing.packing_query,
        "op12_jacobi_whitening": whitening.whitening_query,
        "op13_hard_negatives": negatives.negatives_query,
    }


def oracle_sql():
    return {
        "op1_license_sentences": licenses.license_sql(),
        "op4_exact_topk": topk.TOPK_SQL,
        "op6_winnowed_lines": line_dedup.LINE_SQL,
        "op8_chat_format": chat.CHAT_SQL,
        "op13_hard_negatives": negatives.NEGATIVES_SQL,
    }
