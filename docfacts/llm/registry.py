"""Queries and oracle SQL of this subpackage."""

from docfacts.llm import audio, decontaminate, html_template, jaccard, language, language_model, merkle, packing, quality, sharding, simhash, url_filter, vector_codes

QUERIES = {
    "op1_html_template": html_template.op1_html_template,
    "op2_quality": quality.op2_quality,
    "op3_language": language.op3_language,
    "op4_hilbert_shards": sharding.op4_hilbert_shards,
    "op5_language_model": language_model.op5_language_model,
    "op6_simhash": simhash.op6_simhash,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_audio": audio.op8_audio,
    "op9_pattern_packing": packing.op9_pattern_packing,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_ngram_jaccard": jaccard.op13_ngram_jaccard,
}
ORACLES = {"op10_url_filter": url_filter.ORACLE, "op11_vector_codes": vector_codes.ORACLE, "op12_merkle_manifest": merkle.ORACLE}
