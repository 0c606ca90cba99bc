"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from markforge.llm import op4, op10, op11
from markforge.llm.op1 import op1_language_id
from markforge.llm.op2 import op2_line_dedup
from markforge.llm.op3 import op3_near_dedup
from markforge.llm.op4 import op4_chat_formatting
from markforge.llm.op5 import op5_benchmark_decontamination
from markforge.llm.op6 import op6_quality_rules
from markforge.llm.op7 import op7_mixing
from markforge.llm.op8 import op8_license_scan
from markforge.llm.op9 import op9_substring_dedup
from markforge.llm.op10 import op10_warc_derivatives
from markforge.llm.op11 import op11_hard_negatives
from markforge.llm.op12 import op12_sentencepiece
from markforge.llm.op13 import op13_token_alignment

QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_line_dedup, op3_near_dedup, op4_chat_formatting, op5_benchmark_decontamination, op6_quality_rules, op7_mixing,
    op8_license_scan, op9_substring_dedup, op10_warc_derivatives, op11_hard_negatives, op12_sentencepiece, op13_token_alignment)}
ORACLES = {"op4_chat_formatting": op4.ORACLE, "op10_warc_derivatives": op10.ORACLE,
           "op11_hard_negatives": op11.ORACLE}
