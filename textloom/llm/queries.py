"""The corpus operators' queries and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from . import bpe, chat, clustering, decontaminate, neardup, neighbours, pii, quality, rangejoin, repeats, tokencount
from .sharding import op9_sharding

QUERIES = {
    "op1_near_duplicates": neardup.op1_near_duplicates,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_quality": quality.op3_quality,
    "op4_token_counts": tokencount.op4_token_counts,
    "op5_nearest_neighbours": neighbours.op5_nearest_neighbours,
    "op6_pii": pii.op6_pii,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_sharding": op9_sharding,
    "op10_repeats": repeats.op10_repeats,
    "op11_near_vectors": rangejoin.op11_near_vectors,
    "op12_clustering": clustering.op12_clustering,
}

ORACLE_SQL: dict[str, str] = {
    "op1_near_duplicates": neardup.ORACLE_OP1,
    "op5_nearest_neighbours": neighbours.ORACLE_OP5,
    "op7_chat_formatting": chat.oracle_sql(),
    "op10_repeats": repeats.ORACLE_OP10,
    "op11_near_vectors": rangejoin.ORACLE_OP11,
    "op12_clustering": clustering.ORACLE_OP12,
}
