"""The named queries of this subpackage and their SQL."""

from __future__ import annotations

from touchline.llm import (
    decontam, dialogue, fingerprint, language, lm, mixing, neardup, negatives, pii, quality, repeats, secrets, sentencepieces,
)

QUERIES = {
    "op1_language": language.op1_language,
    "op2_pii": pii.op2_pii,
    "op3_repeats": repeats.op3_repeats,
    "op4_mixing": mixing.op4_mixing,
    "op5_fingerprints": fingerprint.op5_fingerprints,
    "op6_lm_score": lm.op6_lm_score,
    "op7_secrets": secrets.op7_secrets,
    "op8_near_duplicates": neardup.op8_near_duplicates,
    "op9_quality": quality.op9_quality,
    "op10_decontamination": decontam.op10_decontamination,
    "op11_negatives": negatives.op11_negatives,
    "op12_sentencepiece": sentencepieces.op12_sentencepiece,
    "op13_conversations": dialogue.op13_conversations,
}
ORACLES = {
    "op4_mixing": mixing.OP4_SQL,
    "op11_negatives": negatives.OP11_SQL,
}
