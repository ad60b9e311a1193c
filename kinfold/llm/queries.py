"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from kinfold.llm import bpe, decontam, hilbert, html, quality, rules, simhash, substring, tokencount, toxicity

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_decontaminate": decontam.op2_decontaminate,
    "op3_rules": rules.op3_rules,
    "op4_html": html.op4_html,
    "op5_token_counts": tokencount.op5_token_counts,
    "op6_substring": substring.op6_substring,
    "op7_simhash": simhash.op7_simhash,
    "op8_bpe": bpe.op8_bpe,
    "op9_hilbert": hilbert.op9_hilbert,
    "op10_toxicity": toxicity.op10_toxicity,
}
SQL = {
    "op2_decontaminate": decontam.SQL,
    "op3_rules": rules.SQL,
    "op6_substring": substring.SQL,
}
