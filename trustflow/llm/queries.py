"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from trustflow.llm import collocations, decontaminate, langid, mixing, oracles, pii, quality, secrets, simhash, spelling, tokens, toxicity, urls, warc

QUERIES = {
    "op1_warc": warc.op1,
    "op2_quality_rules": quality.op2,
    "op3_url_filters": urls.op3,
    "op4_token_counts": tokens.op4,
    "op5_simhash": simhash.op5,
    "op6_mixing": mixing.op6,
    "op7_secrets": secrets.op7,
    "op8_pii": pii.op8,
    "op9_toxicity": toxicity.op9,
    "op10_decontamination": decontaminate.op10,
    "op11_spelling_variants": spelling.op11,
    "op12_collocations": collocations.op12,
    "op13_language_id": langid.op13,
}

ORACLES = {
    "op1_warc": oracles.WARC,
    "op2_quality_rules": oracles.QUALITY,
    "op7_secrets": oracles.SECRETS,
    "op10_decontamination": oracles.DECONTAMINATION,
    "op12_collocations": oracles.COLLOCATIONS,
}
