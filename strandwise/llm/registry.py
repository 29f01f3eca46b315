"""Queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import binary_output, centroids, chat, collocations, languages, line_dedup, mixing, near_dedup, neighbours, packing, quality, sharding, token_counts

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_nearest_neighbours": neighbours.op5_nearest_neighbours,
    "op6_mixing": mixing.op6_mixing,
    "op7_token_id_output": binary_output.op7_token_id_output,
    "op8_chat_formatting": chat.op8_chat_formatting,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_sharding": sharding.op10_sharding,
    "op11_collocations": collocations.op11_collocations,
    "op12_centroids": centroids.op12_centroids,
    "op13_languages": languages.op13_languages,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.op1_sql(),
        "op2_near_dedup": near_dedup.op2_sql(),
        "op6_mixing": mixing.op6_sql(),
        "op8_chat_formatting": chat.op8_sql(),
        "op9_quality_rules": quality.op9_sql(),
        "op11_collocations": collocations.op11_sql(),
        "op12_centroids": centroids.op12_sql(),
    }
