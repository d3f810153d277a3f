"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from tidewater.llm import (collocations, decontaminate, exact_dedup, hard_negatives, language_model, ngram_join, odd_sketches,
                           packing, passages, pii, repeats, toxicity, warc)

QUERIES = {
    "op1_ngram_jaccard": ngram_join.op1_ngram_jaccard,
    "op2_warc": warc.op2_warc,
    "op3_suffix_dedup": repeats.op3_suffix_dedup,
    "op4_substring_dedup": passages.op4_substring_dedup,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_packing": packing.op6_packing,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_pii": pii.op8_pii,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_context_tree": language_model.op10_context_tree,
    "op11_odd_sketches": odd_sketches.op11_odd_sketches,
    "op12_collocations": collocations.op12_collocations,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLES = {
    "op2_warc": warc.OP2_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op11_odd_sketches": odd_sketches.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
