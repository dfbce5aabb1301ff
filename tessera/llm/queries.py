"""The corpus operators' registered queries and their DuckDB oracles."""

from __future__ import annotations

from tessera.llm import (ann, bpe, fim, hard_negatives, line_dedup, mixing, packing, quality, secret_scan, simhash, token_file,
                         toxicity, winnow)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_source_mixing": mixing.query,
    "op3_token_file": token_file.query,
    "op4_winnowing": winnow.query,
    "op5_quality_nbsvm": quality.query,
    "op6_nearest_neighbours": ann.query,
    "op7_secret_scan": secret_scan.query,
    "op8_bpe_round_trip": bpe.query,
    "op9_toxicity_chain": toxicity.query,
    "op10_simhash_near_dedup": simhash.query,
    "op11_fill_in_middle": fim.query,
    "op12_packing": packing.query,
    "op13_hard_negatives": hard_negatives.query,
}
ORACLES = {
    "op1_line_dedup": line_dedup.SQL.strip(),
    "op2_source_mixing": mixing.SQL.strip(),
    "op6_nearest_neighbours": ann.SQL.strip(),
    "op11_fill_in_middle": fim.SQL.strip(),
    "op13_hard_negatives": hard_negatives.SQL.strip(),
}
