"""The registered queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from oncolake.llm.byte_bpe import op4_byte_bpe
from oncolake.llm.chat import OP1_SQL, op1_chat_format
from oncolake.llm.decontaminate import op2_decontaminate
from oncolake.llm.minhash import op10_minhash
from oncolake.llm.pages import op9_html_extract
from oncolake.llm.passages import OP13_SQL, op13_repeated_passages
from oncolake.llm.pii import op5_pii
from oncolake.llm.quality import op6_quality_classifier
from oncolake.llm.spelling import op11_spelling_variants
from oncolake.llm.suffixes import op8_suffix_dedup
from oncolake.llm.topk import OP3_SQL, op3_exact_top_k
from oncolake.llm.turns import op12_conversation_repair
from oncolake.llm.viterbi import op7_token_counts

QUERIES = {
    function.__name__: function
    for function in (
        op1_chat_format, op2_decontaminate, op3_exact_top_k, op4_byte_bpe, op5_pii,
        op6_quality_classifier, op7_token_counts, op8_suffix_dedup, op9_html_extract,
        op10_minhash, op11_spelling_variants, op12_conversation_repair, op13_repeated_passages,
    )
}
ORACLE = {"op1_chat_format": OP1_SQL, "op3_exact_top_k": OP3_SQL, "op13_repeated_passages": OP13_SQL}
