"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import annsearch, bpe, deobfuscate, fixity, mixing, neardup, oracles, packing, phrases, quality, substringdedup, suffixdedup, tokencount, variants

QUERIES = {
    "op1_stable_projections": annsearch.op1_stable_projections,
    "op2_pareto_mix": mixing.op2_pareto_mix,
    "op3_mcd_quality": quality.op3_mcd_quality,
    "op4_circulant_minhash": neardup.op4_circulant_minhash,
    "op5_unigram_viterbi": tokencount.op5_unigram_viterbi,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_run_length_suffix": suffixdedup.op7_run_length_suffix,
    "op8_relative_lempel_ziv": substringdedup.op8_relative_lempel_ziv,
    "op9_merkle_fixity": fixity.op9_merkle_fixity,
    "op10_noisy_channel_toxicity": deobfuscate.op10_noisy_channel_toxicity,
    "op11_fm_collocations": phrases.op11_fm_collocations,
    "op12_concatenate_and_cut": packing.op12_concatenate_and_cut,
    "op13_spelling_variants": variants.op13_spelling_variants,
}

#: Where SQL can express a query; the others are tested against brute force (tests/llm).
SQL = {
    "op4_circulant_minhash": oracles.NEAR_DUPLICATES,
    "op7_run_length_suffix": oracles.REPEATED_BYTES,
    "op8_relative_lempel_ziv": oracles.REPEATED_WORDS,
    "op9_merkle_fixity": fixity.ORACLE_SQL,
    "op11_fm_collocations": phrases.ORACLE_SQL,
    "op13_spelling_variants": variants.ORACLE_SQL,
}
