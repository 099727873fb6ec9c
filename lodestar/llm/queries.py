"""Queries of the training-data operators, for registration, with DuckDB SQL where it can express them."""

from __future__ import annotations

from lodestar.llm import (conversations, embeddings, kneser_ney, lm, merkle, minhash, mixing, neighbours, packing, rules,
                          substring, toxicity, warc)

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_lm_score": lm.op2_lm_score,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_kneser_ney": kneser_ney.op4_kneser_ney,
    "op5_packing": packing.op5_packing,
    "op6_embedding_dedup": embeddings.op6_embedding_dedup,
    "op7_quality_rules": rules.op7_quality_rules,
    "op8_minhash": minhash.op8_minhash,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_substring": substring.op10_substring,
    "op11_neighbours": neighbours.op11_neighbours,
    "op12_conversations": conversations.op12_conversations,
    "op13_merkle": merkle.op13_merkle,
}

ORACLES = {
    "op1_warc": warc.OP1_SQL,
    "op3_mix_sources": mixing.OP3_SQL,
    "op6_embedding_dedup": embeddings.OP6_SQL,
    "op8_minhash": minhash.OP8_SQL,
    "op10_substring": substring.OP10_SQL,
    "op11_neighbours": neighbours.OP11_SQL,
    "op12_conversations": conversations.OP12_SQL,
    "op13_merkle": merkle.OP13_SQL,
}
