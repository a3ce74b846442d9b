"""Registered queries of the text operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from roadpulse.llm.bpe import op5_bpe_encode_decode
from roadpulse.llm.decontaminate import op4_decontaminate_bm25
from roadpulse.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from roadpulse.llm.html_text import op1_html_main_text
from roadpulse.llm.lexical_rank import OP11_SQL, op11_lexical_search
from roadpulse.llm.lines import OP8_SQL, op8_line_dedup
from roadpulse.llm.pii import op10_pii_bootstrap
from roadpulse.llm.quality import op9_quality_repetition
from roadpulse.llm.secret_scan import op2_secret_scan
from roadpulse.llm.simhash import op3_simhash_near_dedup
from roadpulse.llm.token_counts import op13_token_counts
from roadpulse.llm.toxicity import op6_toxicity_chain
from roadpulse.llm.warc import op7_warc_round_trip

QUERIES = {
    f.__name__: f
    for f in (
        op1_html_main_text,
        op2_secret_scan,
        op3_simhash_near_dedup,
        op4_decontaminate_bm25,
        op5_bpe_encode_decode,
        op6_toxicity_chain,
        op7_warc_round_trip,
        op8_line_dedup,
        op9_quality_repetition,
        op10_pii_bootstrap,
        op11_lexical_search,
        op12_hard_negatives,
        op13_token_counts,
    )
}
ORACLE: dict[str, str] = {"op8_line_dedup": OP8_SQL, "op11_lexical_search": OP11_SQL, "op12_hard_negatives": OP12_SQL}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
