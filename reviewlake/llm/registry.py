"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from reviewlake.llm import (
    bpe,
    conversations,
    embedding_dedup,
    hard_negatives,
    langid,
    line_dedup,
    mixing,
    ngram_join,
    pieces,
    quality,
    secrets,
    toxicity,
    vector_search,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality": quality.op2_quality,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_mixing": mixing.op4_mixing,
    "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
    "op6_vector_search": vector_search.op6_vector_search,
    "op7_langid": langid.op7_langid,
    "op8_secrets": secrets.op8_secrets,
    "op9_bpe": bpe.op9_bpe,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_conversation_repair": conversations.op11_conversation_repair,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_sentencepiece": pieces.op13_sentencepiece,
}

ORACLE = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op4_mixing": mixing.ORACLE_SQL,
    "op5_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op6_vector_search": vector_search.ORACLE_SQL,
    "op10_ngram_join": ngram_join.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
}
