"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from . import (codebooks, decontamination, divergence, lm, minhash, packing,
               perspective, quality, secrets, sharding, suffixes, tokencount,
               winnowing)

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_deleted_interpolation": lm.op2_deleted_interpolation,
    "op3_minhash_near_duplicates": minhash.op3_minhash_near_duplicates,
    "op4_hierarchical_quality": quality.op4_hierarchical_quality,
    "op5_deep_shallow_dedup": suffixes.op5_deep_shallow_dedup,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_greedy_tiling": decontamination.op7_greedy_tiling,
    "op8_winnowing": winnowing.op8_winnowing,
    "op9_balanced_shards": sharding.op9_balanced_shards,
    "op10_perspective_rotation": perspective.op10_perspective_rotation,
    "op11_token_counts": tokencount.op11_token_counts,
    "op12_orchard_codes": codebooks.op12_orchard_codes,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLE = {
    "op3_minhash_near_duplicates": minhash.OP3_SQL,
    "op5_deep_shallow_dedup": suffixes.OP5_SQL,
    "op10_perspective_rotation": perspective.OP10_SQL,
    "op12_orchard_codes": codebooks.OP12_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
