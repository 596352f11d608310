"""The operators as named queries, and their SQL where SQL can say the same."""

from __future__ import annotations

from tallyline.llm import (
    conversation_repair,
    decontamination,
    forced_boundaries,
    hard_negatives,
    mixing,
    neighbours,
    sentence_spans,
    simhash_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    url_filters,
)


def queries() -> dict:
    return {
        "op1_simhash_dedup": simhash_dedup.query,
        "op2_toxicity": toxicity.query,
        "op3_decontamination": decontamination.query,
        "op4_suffix_dedup": suffix_dedup.query,
        "op5_token_files": token_files.query,
        "op6_sentence_spans": sentence_spans.query,
        "op7_url_filters": url_filters.query,
        "op8_neighbours": neighbours.query,
        "op9_token_counts": token_counts.query,
        "op10_mixing": mixing.query,
        "op11_forced_boundaries": forced_boundaries.query,
        "op12_conversation_repair": conversation_repair.query,
        "op13_hard_negatives": hard_negatives.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_neighbours": neighbours.SQL, "op10_mixing": mixing.SQL, "op13_hard_negatives": hard_negatives.SQL}
