"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from transitlake.llm import ann, decontamination, html_text, licenses, line_dedup, minhash, mixing, negatives, pii, runs, sharding, simhash, toxicity

QUERIES = {
    "op1_license_join": licenses.query,
    "op2_weak_supervision": toxicity.query,
    "op3_histogram_shards": sharding.query,
    "op4_winnowed_lines": line_dedup.query,
    "op5_learned_partitions": ann.query,
    "op6_boosted_pii": pii.query,
    "op7_simhash_blocks": simhash.query,
    "op8_boosted_dom": html_text.query,
    "op9_systematic_mix": mixing.query,
    "op10_suffix_automaton": decontamination.query,
    "op11_coordinate_pruning": negatives.query,
    "op12_descending_lcp": runs.query,
    "op13_bottom_k": minhash.query,
}

ORACLES: dict[str, str] = {
    "op11_coordinate_pruning": negatives.ORACLE,
    "op12_descending_lcp": runs.ORACLE,
    "op13_bottom_k": minhash.ORACLE,
}
