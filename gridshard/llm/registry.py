"""The queries of the operators on documents, and the SQL of those that SQL can express."""

from gridshard.llm import (
    decontamination,
    divergence,
    jaccard_join,
    language,
    mixing,
    pseudo_likelihood,
    pseudonyms,
    quality,
    repair,
    repetition,
    sharding,
    speculative_bpe,
    spelling,
)

QUERIES = {
    "op1_mix_sources": mixing.op1,
    "op2_repetition_rules": repetition.op2,
    "op3_pseudonyms": pseudonyms.op3,
    "op4_pseudo_likelihood": pseudo_likelihood.op4,
    "op5_quality_votes": quality.op5,
    "op6_token_files": repair.op6,
    "op7_language_id": language.op7,
    "op8_extendible_shards": sharding.op8,
    "op9_decontaminate": decontamination.op9,
    "op10_jaccard_join": jaccard_join.op10,
    "op11_spelling_groups": spelling.op11,
    "op12_speculative_bpe": speculative_bpe.op12,
    "op13_source_divergence": divergence.op13,
}
ORACLE = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op2_repetition_rules": repetition.OP2_SQL,
    "op8_extendible_shards": sharding.OP8_SQL,
    "op9_decontaminate": decontamination.OP9_SQL,
    "op10_jaccard_join": jaccard_join.OP10_SQL,
    "op11_spelling_groups": spelling.OP11_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
