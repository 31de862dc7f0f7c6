"""The subpackage's queries for the driver's registry, and their SQL."""

from __future__ import annotations

from . import capture_index, classifier, cpsjoin, digest_index, lm, mixing, packing, pii, rules, token_orc

QUERIES = {
    "op1_sum_of_squares_packing": packing.packing_query,
    "op2_recurrent_lm_scoring": lm.lm_query,
    "op3_token_orc": token_orc.token_query,
    "op4_chosen_path_near_dedup": cpsjoin.near_query,
    "op5_quality_decision_list": rules.quality_query,
    "op6_capture_index_merge": capture_index.capture_query,
    "op7_pii_candidate_boosting": pii.pii_query,
    "op8_systematic_mixing": mixing.mixing_query,
    "op9_digest_index_dedup": digest_index.exact_query,
    "op10_quality_boosted_trees": classifier.classifier_query,
}

ORACLES = {
    "op6_capture_index_merge": capture_index.CAPTURE_SQL,
    "op8_systematic_mixing": mixing.MIXING_SQL,
    "op9_digest_index_dedup": digest_index.EXACT_SQL,
}
