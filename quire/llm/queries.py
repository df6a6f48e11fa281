"""The training-data queries: one opN_<name> per operator, with its SQL where SQL can express it."""

from __future__ import annotations

from quire.llm import containment, packing, quality, secrets, simhash, tokens, topk, toxicity, urls, warc

QUERIES = {
    "op1_topk_nra": topk.query,
    "op2_secret_scan": secrets.query,
    "op3_url_rules": urls.query,
    "op4_toxicity": toxicity.query,
    "op5_sum_of_squares_packing": packing.query,
    "op6_simhash_neardup": simhash.query,
    "op7_quality_neighbours": quality.query,
    "op8_benchmark_decontamination": containment.query,
    "op9_warc_roundtrip": warc.query,
    "op10_token_counts": tokens.query,
}

#: DuckDB SQL of the queries that SQL can express over whole tables.
SQL: dict[str, str] = {
    "op1_topk_nra": topk.SQL,
    "op8_benchmark_decontamination": containment.SQL,
    "op9_warc_roundtrip": warc.SQL,
}
