"""Queries and SQL of this subpackage, by name."""

from __future__ import annotations

from prismset.llm import chat, embeddings, exactdedup, langid, linededup, mixing, packing, ppm, quality, simhash

QUERIES = {
    "op1_near_embeddings": embeddings.op1_near_embeddings,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_language_id": langid.op3_language_id,
    "op4_chat_perspectives": chat.op4_chat_perspectives,
    "op5_packing": packing.op5_packing,
    "op6_quality": quality.op6_quality,
    "op7_line_dedup": linededup.op7_line_dedup,
    "op8_simhash_near_dedup": simhash.op8_simhash_near_dedup,
    "op9_exact_dedup": exactdedup.op9_exact_dedup,
    "op10_lm_scores": ppm.op10_lm_scores,
}
ORACLES = {
    "op2_mix_sources": mixing.OP2_SQL,
    "op4_chat_perspectives": chat.OP4_SQL,
    "op9_exact_dedup": exactdedup.OP9_SQL,
}
