"""The registered queries of this subpackage: one per operator, over its whole table."""

from . import ann, bpe, decontaminate, html_text, jaccard, language, licences, merkle, packed, pii, runs, sharding, toxicity

QUERIES = {
    "op1_nearest_neighbours": ann.op1,
    "op2_toxicity": toxicity.op2,
    "op3_byte_level_bpe": bpe.op3,
    "op4_language_id": language.op4,
    "op5_personal_data": pii.op5,
    "op6_benchmark_decontamination": decontaminate.op6,
    "op7_html_extraction": html_text.op7,
    "op8_ngram_jaccard_join": jaccard.op8,
    "op9_licence_scan": licences.op9,
    "op10_sharding": sharding.op10,
    "op11_packed_tokens": packed.op11,
    "op12_periodic_runs": runs.op12,
    "op13_merkle_manifest": merkle.op13,
}
#: SQL counterparts; the operators without one are tested against a brute-force version.
ORACLES: dict[str, str] = {
    "op6_benchmark_decontamination": decontaminate.SQL,
    "op8_ngram_jaccard_join": jaccard.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
