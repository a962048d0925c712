"""Registered queries of the training-data operators, and SQL where SQL can say the same."""

from __future__ import annotations

from offhours.llm.curve_search import op2_curve_search
from offhours.llm.exact_topk import OP9_SQL, op9_exact_topk
from offhours.llm.filter_audit import OP13_SQL, op13_filter_audit
from offhours.llm.katz import op3_katz_scoring
from offhours.llm.line_dedup import op5_line_dedup
from offhours.llm.mixing import op1_mix_sources
from offhours.llm.pieces import op10_sentencepiece
from offhours.llm.quality import op6_quality_classifier
from offhours.llm.secret_scan import op8_secret_scan
from offhours.llm.set_join import OP4_SQL, op4_ngram_jaccard
from offhours.llm.substring_dedup import OP12_SQL, op12_substring_dedup
from offhours.llm.token_counts import op7_token_counts
from offhours.llm.whitening import op11_embedding_whitening

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_curve_search": op2_curve_search,
    "op3_katz_scoring": op3_katz_scoring,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_token_counts": op7_token_counts,
    "op8_secret_scan": op8_secret_scan,
    "op9_exact_topk": op9_exact_topk,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_filter_audit": op13_filter_audit,
}

SQL: dict[str, str] = {
    "op4_ngram_jaccard": OP4_SQL,
    "op9_exact_topk": OP9_SQL,
    "op12_substring_dedup": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
