"""The registered queries of this package and their SQL."""

from __future__ import annotations

from vitals.llm.chat_format import CHAT_FORMAT_SQL, op3_chat_format
from vitals.llm.fill_middle import FILL_MIDDLE_SQL, op11_fill_middle
from vitals.llm.html_text import op8_html_extraction
from vitals.llm.line_dedup import LINE_DEDUP_SQL, op5_line_dedup
from vitals.llm.near_dedup import op9_near_dedup
from vitals.llm.neighbours import op10_nearest_neighbours
from vitals.llm.packing import op6_packing
from vitals.llm.quality_rules import QUALITY_SQL, op4_quality_rules
from vitals.llm.secret_scan import SECRET_SCAN_SQL, op13_secret_scan
from vitals.llm.segmentation import op1_sentencepiece
from vitals.llm.token_counts import op7_token_counts
from vitals.llm.toxicity import op2_toxicity
from vitals.llm.whitening import op12_embedding_whitening

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_toxicity": op2_toxicity,
    "op3_chat_format": op3_chat_format,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_token_counts": op7_token_counts,
    "op8_html_extraction": op8_html_extraction,
    "op9_near_dedup": op9_near_dedup,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_fill_middle": op11_fill_middle,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE = {
    "op3_chat_format": CHAT_FORMAT_SQL,
    "op4_quality_rules": QUALITY_SQL,
    "op5_line_dedup": LINE_DEDUP_SQL,
    "op11_fill_middle": FILL_MIDDLE_SQL,
    "op13_secret_scan": SECRET_SCAN_SQL,
}
