"""The numbered operators as queries over the test tables."""

from __future__ import annotations

from tidemark.llm.archive import op4_content_archive
from tidemark.llm.decontaminate import op1_benchmark_decontamination
from tidemark.llm.fingerprints import op8_fingerprints
from tidemark.llm.html import op5_html_main_text
from tidemark.llm.jaccard import op2_ngram_jaccard
from tidemark.llm.mixing import op13_mixture
from tidemark.llm.oracle import ORACLE
from tidemark.llm.prefixes import op12_conversation_trie
from tidemark.llm.repeats import op10_suffix_array_dedup
from tidemark.llm.runs import op11_periodic_runs
from tidemark.llm.secrets import op7_secret_scan
from tidemark.llm.sentencepieces import op6_sentencepieces
from tidemark.llm.tokens import op3_token_files
from tidemark.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_token_files": op3_token_files,
    "op4_content_archive": op4_content_archive,
    "op5_html_main_text": op5_html_main_text,
    "op6_sentencepieces": op6_sentencepieces,
    "op7_secret_scan": op7_secret_scan,
    "op8_fingerprints": op8_fingerprints,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_mixture": op13_mixture,
}

__all__ = ["ORACLE", "QUERIES"]
