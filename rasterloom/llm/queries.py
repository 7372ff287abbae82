"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from rasterloom.llm import decontaminate, hmm, langid, naming, packing, pii, quality, repair, simhash, toxicity


def queries() -> dict:
    return {
        "op1_repair_tokens": repair.op1_repair_tokens,
        "op2_hidden_markov_lm": hmm.op2_hidden_markov_lm,
        "op3_template_decontamination": decontaminate.op3_template_decontamination,
        "op4_simhash_bktree": simhash.op4_simhash_bktree,
        "op5_boosted_pii": pii.op5_boosted_pii,
        "op6_zstd_toxicity": toxicity.op6_zstd_toxicity,
        "op7_language_bitmask": langid.op7_language_bitmask,
        "op8_vector_packing": packing.op8_vector_packing,
        "op9_subword_quality": quality.op9_subword_quality,
        "op10_block_naming": naming.op10_block_naming,
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_block_naming": naming.OP10_SQL}
