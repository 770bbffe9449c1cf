"""The package's registered queries and their SQL twins."""
from __future__ import annotations

from marginlens.llm import (
    bpe, chat, decontaminate, exact_dedup, host_reputation, html_extract, jaccard_join, lexical_search, quality,
    substring_dedup, token_files, warc, whitening,
)

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_chat_formatting": chat.op2_chat_formatting,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_token_files": token_files.op5_token_files,
    "op6_html": html_extract.op6_html,
    "op7_bpe": bpe.op7_bpe,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_quality": quality.op10_quality,
    "op11_whitening": whitening.op11_whitening,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_host_reputation": host_reputation.op13_host_reputation,
}
ORACLE = {
    "op1_warc": warc.SQL,
    "op2_chat_formatting": chat.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op8_decontamination": decontaminate.SQL,
    "op12_lexical_search": lexical_search.SQL,
    "op13_host_reputation": host_reputation.SQL,
}
