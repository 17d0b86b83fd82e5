"""Queries of this subpackage by name, and the SQL that must give the same rows."""

from __future__ import annotations

from lexalign.llm import decontamination, embeddings, language, licenses, ngram_jaccard, packing, pii, quality, sharding, substrings

QUERIES = {
    "op1_ngram_jaccard": ngram_jaccard.op1_ngram_jaccard,
    "op2_licenses": licenses.op2_licenses,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_packing": packing.op4_packing,
    "op5_quality": quality.op5_quality,
    "op6_language": language.op6_language,
    "op7_embeddings": embeddings.op7_embeddings,
    "op8_pii": pii.op8_pii,
    "op9_sharding": sharding.op9_sharding,
    "op10_substrings": substrings.op10_substrings,
}
SQL = {
    "op1_ngram_jaccard": ngram_jaccard.SQL,
    "op2_licenses": licenses.sql(),
    "op3_decontamination": decontamination.SQL,
    "op7_embeddings": embeddings.SQL,
    "op9_sharding": sharding.sql(),
    "op10_substrings": substrings.SQL,
}
