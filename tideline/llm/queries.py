"""The operators of this folder as registered queries, each over its whole table."""

from __future__ import annotations

from tideline.llm.bilinear_lm import scores_of_documents
from tideline.llm.decontaminate import contaminated_documents
from tideline.llm.fingerprints import fingerprints_of_documents
from tideline.llm.html_text import text_of_pages
from tideline.llm.language_id import language_of_documents
from tideline.llm.lexicon_bpe import encoded_documents
from tideline.llm.near_duplicates import near_duplicates_of_documents
from tideline.llm.periodic_runs import runs_of_documents
from tideline.llm.quality import quality_of_documents
from tideline.llm.secret_scan import secrets_of_documents
from tideline.llm.shards import sharded_documents
from tideline.llm.spelling import variants_of_documents
from tideline.llm.token_files import ids_of_documents

QUERIES = {
    "op1_lexicon_bpe": encoded_documents,
    "op2_html_text": text_of_pages,
    "op3_shards": sharded_documents,
    "op4_token_files": ids_of_documents,
    "op5_secret_scan": secrets_of_documents,
    "op6_bilinear_lm": scores_of_documents,
    "op7_near_duplicates": near_duplicates_of_documents,
    "op8_decontaminate": contaminated_documents,
    "op9_language_id": language_of_documents,
    "op10_fingerprints": fingerprints_of_documents,
    "op11_spelling_variants": variants_of_documents,
    "op12_quality": quality_of_documents,
    "op13_periodic_runs": runs_of_documents,
}

ORACLES: dict[str, str] = {}
