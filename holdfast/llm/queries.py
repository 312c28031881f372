"""One query per operator, over its whole table, and the SQL some of them must agree with."""

from __future__ import annotations

from holdfast.llm import (
    ann,
    exact_dedup,
    html_text,
    merkle,
    packing,
    personal_data,
    piece_codec,
    quality,
    simhash_dedup,
    token_counts,
    toxicity,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_site_quality": quality.query,
    "op2_consensus_text": html_text.query,
    "op3_url_vocabulary": url_filter.query,
    "op4_content_sort": exact_dedup.query,
    "op5_length_buckets": packing.query,
    "op6_learned_partitions": ann.query,
    "op7_prefix_counts": token_counts.query,
    "op8_suffix_pieces": piece_codec.query,
    "op9_nnpu_toxicity": toxicity.query,
    "op10_simhash": simhash_dedup.query,
    "op11_refined_whitening": whitening.query,
    "op12_bootstrapped_contexts": personal_data.query,
    "op13_merkle_witnesses": merkle.query,
}

# The others train a model or follow a procedure that SQL cannot express; their tests compare them with
# brute force, with the public libraries or with labels kept out.
ORACLE = {
    "op3_url_vocabulary": url_filter.SQL,
    "op4_content_sort": exact_dedup.SQL,
    "op13_merkle_witnesses": merkle.SQL,
}
