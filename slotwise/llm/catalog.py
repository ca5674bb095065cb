"""Queries of the text operators and their DuckDB equivalents, by name."""

from __future__ import annotations

from slotwise.llm import alignment, byte_bpe, embeddings, mixing, neardup, packing, pieces, prefix_tokens, quality, secrets, toxicity, urls, variants

QUERIES = {
    "op1_line_quality": quality.op1_line_quality,
    "op2_toxic_spans": toxicity.op2_toxic_spans,
    "op3_order_minhash": neardup.op3_order_minhash,
    "op4_collision_projections": embeddings.op4_collision_projections,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_prefix_token_counts": prefix_tokens.op6_prefix_token_counts,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_pack_token_rows": packing.op8_pack_token_rows,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_path_templates": urls.op10_path_templates,
    "op11_byte_bpe": byte_bpe.op11_byte_bpe,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_spelling_variants": variants.op13_spelling_variants,
}

ORACLE = {
    "op1_line_quality": quality.OP1_SQL,
    "op7_mix_sources": mixing.OP7_SQL,
}
