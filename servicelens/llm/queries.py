"""Registered queries of the subpackage: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from servicelens.llm.bpe import op4_query
from servicelens.llm.chat import op10_query
from servicelens.llm.decontaminate import op9_query
from servicelens.llm.embedding_dedup import op12_query
from servicelens.llm.html_text import op1_query
from servicelens.llm.license_scan import op3_query
from servicelens.llm.merkle import op13_query
from servicelens.llm.near_dedup import op6_query
from servicelens.llm.periodic import op11_query
from servicelens.llm.quality import op7_query
from servicelens.llm.records import op5_query
from servicelens.llm.token_count import op8_query
from servicelens.llm.warc import op2_query

QUERIES = {
    "op1_html_text": op1_query,
    "op2_warc_revisits": op2_query,
    "op3_license_scan": op3_query,
    "op4_bpe": op4_query,
    "op5_token_records": op5_query,
    "op6_near_duplicates": op6_query,
    "op7_quality_rules": op7_query,
    "op8_token_counts": op8_query,
    "op9_decontamination": op9_query,
    "op10_chat_format": op10_query,
    "op11_periodic_runs": op11_query,
    "op12_embedding_duplicates": op12_query,
    "op13_merkle_manifest": op13_query,
}
